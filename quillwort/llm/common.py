"""Helpers shared by the training-data operators.

Two ideas recur here.  *Chunks* are ranges of document ids holding about the same number of rows, so that "an
earlier document" is "an earlier chunk, or an earlier row of this chunk".  *Packed exchange*: a chunk sends distinct
64-bit keys as packed binary rows, one for each bucket of the key space, and gets back the subset that matters.
A key that half of the corpus contains is then sent once by each chunk, never once by each occurrence.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_CLASS = r"[^\x20\x09-\x0D]+"
#: Top-level id ranges; the bounds travel as a literal, so their number is fixed.
MAX_RANGES = 256
#: Null ids sort after all others.
NULL_CHUNK = 1 << 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.  Without one, local mode gets its own; a cluster raises an error, since no other folder is known to be shared."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = base or tempfile.mkdtemp(prefix="spark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, prefix: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{shared_base(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder, so that a lost executor costs a re-read, not a rerun."""
    shared_base(df.sparkSession)
    return df.checkpoint()


def sized(df: DataFrame, rows: int, n: int | None = None) -> DataFrame:
    """A checkpointed table of narrow rows in partitions of about ``rows`` rows, by its row count ``n`` (counted here if not
    given): every shuffle of a table writes files for each of its partitions, however few rows it has."""
    return df.coalesce(max(1, math.ceil((df.count() if n is None else n) / rows)))


def buckets_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_chunk(docs: DataFrame, id_col: str, rows_per_chunk: int) -> Column:
    """A column that numbers ranges of ``id_col`` in ascending order, each of about ``rows_per_chunk`` rows.

    Reads the id column only.  Up to MAX_RANGES quantile ranges come first; each is then cut evenly by its own row
    count, so the number of chunks has no bound.  The driver sees MAX_RANGES numbers.  Equal ids share a chunk;
    null ids form the last one.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("i")).where("i is not null")
    n = ids.count()
    parts = max(1, math.ceil(n / rows_per_chunk))
    top = min(MAX_RANGES, parts)
    bounds: list[int] = []
    if top > 1:
        cuts = ids.select(F.percentile_approx("i", [k / top for k in range(1, top)], 100_000)).first()[0]
        bounds = sorted(set(cuts))
    i = F.col(id_col).cast("long")
    if not bounds:
        return F.when(i.isNull(), F.lit(NULL_CHUNK)).otherwise(F.lit(0).cast("long"))
    # F.filter over the literal bounds: how many are below the id.
    rank = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < i)).cast("long")
    if parts <= MAX_RANGES:
        return F.when(i.isNull(), F.lit(NULL_CHUNK)).otherwise(rank)
    spans = {
        r["r"]: (r["lo"], r["hi"], max(1, math.ceil(r["n"] / rows_per_chunk)))
        for r in ids.withColumnRenamed("i", id_col).select(rank.alias("r"), F.col(id_col).alias("i")).groupBy("r").agg(F.min("i").alias("lo"), F.max("i").alias("hi"), F.count("*").alias("n")).collect()
    }
    lit = lambda k, d: F.element_at(F.array(*[F.lit(spans[r][k] if r in spans else d).cast("double") for r in range(len(bounds) + 1)]), (rank + 1).cast("int"))
    sub = F.floor((i - lit(0, 0)) / (lit(1, 0) - lit(0, 0) + 1) * lit(2, 1)).cast("long")
    return F.when(i.isNull(), F.lit(NULL_CHUNK)).otherwise(rank * F.lit(1 << 24) + sub)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, so that a task holds the Python objects of few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class Names(dict):
    """bytes to a 64-bit name, remembered up to a bound."""

    LIMIT = 60_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = name = xxhash.xxh64_intdigest(word, 0x5EED)
        return name

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


NAMES = Names()
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser; wraps modulo 2**64."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def in_sorted(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def sliding(v: np.ndarray, width: int, op) -> np.ndarray:
    """op over v[i : i + width] for each i, in log2(width) passes; len(v) - width + 1 values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        v = op(v[: len(v) - step], v[step:])
        have += step
    return v


def minimal_places(v: np.ndarray, width: int) -> np.ndarray:
    """True where v[p] is the least of some ``width`` places in a row that hold p.  The type's largest value is never chosen."""
    n, none = len(v), np.iinfo(v.dtype).max
    if n < width:
        return np.zeros(n, bool)
    least = np.zeros(n + width - 1, v.dtype)
    least[width - 1 : n] = sliding(v, width, np.minimum)
    return (sliding(least, width, np.maximum)[:n] == v) & (v != none)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """True for each of n places inside [s, s + width) of some start."""
    if not len(starts):
        return np.zeros(n, bool)
    opened = np.bincount(starts, minlength=n + 1)[: n + 1]
    closed = np.bincount(np.minimum(starts + width, n), minlength=n + 1)[: n + 1]
    return np.cumsum(opened - closed)[:n] > 0


def ordered_docs(t: pa.Table, id_col: str = "doc_id", text_col: str = "text") -> tuple[list, list[bytes]]:
    """Ids and UTF-8 texts of a chunk in document order: by id, nulls last, rows of equal id by text.  Null texts are empty."""
    ids, texts, _ = ordered_rows(t, id_col, text_col)
    return ids, texts


def ordered_rows(t: pa.Table, id_col: str = "doc_id", text_col: str = "text") -> tuple[list, list[bytes], list[int]]:
    """As ordered_docs, and each one's row in ``t``."""
    ids = t.column(id_col).to_pylist()
    texts = [b"" if x is None else x for x in t.column(text_col).cast(pa.binary()).to_pylist()]
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, texts[k]))
    return [ids[k] for k in order], [texts[k] for k in order], order


#: What a grouped Arrow function gets as its key.
Key = tuple[pa.Scalar, ...]
PACKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary())])
PACKED_DDL = "bucket int, chunk long, blob binary"


def by_bucket(key: np.ndarray, n_buckets: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, places) of the keys of each bucket that has any; the bucket is a slice of the key space."""
    b = ((key >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    order = np.argsort(b, kind="stable")
    cuts = np.searchsorted(b[order], np.arange(n_buckets + 1, dtype=np.uint64))
    return [(k, order[cuts[k] : cuts[k + 1]]) for k in range(n_buckets) if cuts[k + 1] > cuts[k]]


def packed(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"bucket": [r[0] for r in rows], "chunk": [r[1] for r in rows], "blob": [r[2] for r in rows]}, schema=PACKED)


def unpacked(t: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All items of a group of packed rows, and the chunk of each."""
    parts = [np.frombuffer(b, dtype) for b in t.column("blob").to_pylist()]
    chunks = np.repeat(np.asarray(t.column("chunk").to_pylist(), np.int64), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), chunks


def to_chunks(bucket: int, chunks: np.ndarray, items: np.ndarray, to_bytes: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> pa.Table:
    """Packs items into one row for each chunk."""
    order = np.argsort(chunks, kind="stable")
    chunks, items = chunks[order], items[order]
    heads = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]) if len(chunks) else np.zeros(0, int)
    ends = np.r_[heads[1:], len(chunks)] if len(heads) else heads
    return packed([(bucket, int(chunks[a]), to_bytes(items[a:b])) for a, b in zip(heads, ends)])


def coarse(key: np.ndarray) -> np.ndarray:
    """The upper 48 bits: enough for candidate keys, where a false match costs work but decides nothing."""
    return key & ~np.uint64(0xFFFF)


def key_bytes(key: np.ndarray) -> bytes:
    """Coarse keys in six bytes each, all lowest bytes first: of sorted keys the upper bytes repeat and compress well."""
    return np.ascontiguousarray(key).view(np.uint8).reshape(-1, 8)[:, 2:].T.tobytes()


def keys_of(blob: bytes) -> np.ndarray:
    k = np.zeros((len(blob) // 6, 8), np.uint8)
    k[:, 2:] = np.frombuffer(blob, np.uint8).reshape(6, -1).T
    return k.view(np.uint64).ravel()


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers, all lowest bytes first: small numbers leave long runs of zeros, which compress."""
    return np.ascontiguousarray(x, np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()


def numbers(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, len(blob) // 4).T).view(np.int32).ravel()


def send_keys(chunk: int, key: np.ndarray, n_buckets: int) -> pa.Table:
    """The distinct coarse keys of a chunk, a row for each bucket."""
    k = np.unique(coarse(key))
    return packed([(b, chunk, key_bytes(k[at])) for b, at in by_bucket(k, n_buckets)])


def received_keys(t: pa.Table) -> np.ndarray:
    """All keys of a group of rows, sorted."""
    return np.sort(np.concatenate([keys_of(b) for b in t.column("blob").to_pylist()] or [np.zeros(0, np.uint64)]))


def shared_keys(key: Key, t: pa.Table) -> pa.Table:
    """Reducer: of the distinct keys each chunk sent, those that two or more chunks sent go back to each of them."""
    parts = [keys_of(b) for b in t.column("blob").to_pylist()]
    chunk = np.repeat(np.asarray(t.column("chunk").to_pylist(), np.int64), [len(p) for p in parts])
    k = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    order = np.argsort(k, kind="stable")
    k, chunk = k[order], chunk[order]
    same = np.r_[False, k[1:] == k[:-1]] if len(k) else np.zeros(0, bool)
    hit = same | np.r_[same[1:], False] if len(k) else same
    return to_chunks(key[0].as_py(), chunk[hit], k[hit], key_bytes)
