"""SimHash near-dedup with pivot distance tables (operator 8).

Contract: A-Z lower-cased; words are runs of ``[^\\x20\\x09-\\x0D]``; the 3-word shingles, repeats included, joined by
spaces (fewer words: the whole sequence; none: fingerprint zero); h is a shingle's XXH64 with seed 42; a fingerprint bit
is 1 if it is set in over half of the h; fingerprints link at ``RADIUS`` = 2 or fewer differing bits; a component's id is
the smallest doc_id that can be reached.

Pivot table.  Fingerprints are reduced to distinct ones, so copies of a text cost nothing further.  Each gets a row of Hamming
distances to the 65 fixed reference fingerprints of ``PIVOTS``, made once and kept in the shared folder.  The references are
zero and, for each of 8 bands of 8 bits, the 7 Walsh words and the full word of that band alone: the distances of a band, less
the distance to zero, tell the band's bits exactly.  Two bits lie in at most two bands, so a pair within the radius has
equal coordinates in some 6 of the 8 bands: the table is joined with itself on the 28 sets of 6 bands (by a hash of their
coordinates).  Of the pairs that meet, those with any coordinate that differs by more than RADIUS are discarded (Hamming
distance is a metric), and survivors are verified by counting bits.  Nothing is missed, at any size of a group.

A group shares 48 bits, so it has at most 2**16 fingerprints however many documents there are, and a member at most 136
partners in it.  Groups are compared in blocks along the coordinate that spreads most.

Components: least labels spread by star contraction, a checkpoint in the shared folder each round.  The links go in
partitions of ``LINKS``, so few of them take few files.

Null text: as empty.  Null doc_id: a row of its own, never the least.  Repeated rows: a result row each.  Empty tables
give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import checkpointed, sized, table

SHINGLE = 3
SEED = 42
RADIUS = 2
BANDS = 8
#: Rows compared at a time within a group.
BLOCK = 256
#: Links in a partition while components are sought.
LINKS = 250_000


def _references() -> list[int]:
    """Zero, and eight words inside each band: byte k of a Walsh word has bit i set if k and i share an odd number of bits."""
    walsh = [sum((bin(k & i).count("1") & 1) << i for i in range(8)) for k in range(1, 8)]
    return [0, *(w << (8 * band) for band in range(BANDS) for w in [*walsh, 255])]


PIVOTS = _references()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    if len(words) <= shingle:
        h = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        h = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip([0, *end[: -shingle].tolist()], (end[shingle - 1 :] - 1).tolist())]
    return majority(np.array(h, np.uint64))


def majority(h: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_536):
        total += np.unpackbits(h[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table(distinct: DataFrame) -> DataFrame:
    """Adds ``d``, the Hamming distances to the references, to distinct fingerprints ``fp``."""
    return distinct.withColumn("d", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("byte") for p in PIVOTS]))


def _band_sets(d: Column) -> tuple[Column, Column]:
    """A hash of each band's coordinates; and, from these (as column _band), a hash of each 6 of the 8 bands."""
    band = [F.xxhash64(*[F.get(d, F.lit(1 + 8 * k + j)) - F.get(d, F.lit(0)) for j in range(8)]) for k in range(BANDS)]
    named = lambda i, j: F.xxhash64(F.lit(8 * i + j), *[F.get(F.col("_band"), F.lit(k)) for k in range(BANDS) if k not in (i, j)])
    return F.array(*band), F.array(*[named(i, j) for i in range(BANDS) for j in range(i)])


def close_pairs(fps: np.ndarray, d: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius: discarded by pivot coordinates, verified by bits."""
    lead = int(np.argmax(d.std(0)))
    order = np.argsort(d[:, lead], kind="stable")
    fps, d = fps[order], d[order].astype(np.int16)
    first, second = [], []
    for lo in range(0, len(fps), BLOCK):
        hi = min(len(fps), lo + BLOCK)
        until = int(np.searchsorted(d[:, lead], d[hi - 1, lead] + radius, side="right"))
        a, b = np.nonzero(np.abs(d[lo:hi, lead, None] - d[None, lo:until, lead]) <= radius)
        a, b = (a + lo)[a < b], (b + lo)[a < b]
        for j in range(d.shape[1]):
            near = np.abs(d[a, j] - d[b, j]) <= radius
            a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        first.append(fps[a[near]])
        second.append(fps[b[near]])
    return np.concatenate(first), np.concatenate(second)


def links(pivoted: DataFrame) -> DataFrame:
    """All pairs (a, b) within RADIUS of the fingerprints of a pivot table (fp, d), each once."""
    sets = _band_sets(F.col("d"))
    keyed = pivoted.withColumn("_band", sets[0]).select("fp", F.explode(sets[1]).alias("k"))
    # Most keys have one fingerprint: distances join those that meet only.
    busy = keyed.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    groups = keyed.join(busy, "k").join(pivoted.select("fp", "d"), "fp").groupBy("k").agg(F.collect_list("fp").alias("fps"), F.collect_list("d").alias("ds"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Each collect_list goes in the rows' order, so the two lists run side by side.
            out = [close_pairs(np.array(x, np.int64).view(np.uint64), np.array(y, np.int8)) for x, y in zip(b.column("fps").to_pylist(), b.column("ds").to_pylist())]
            ends = [np.concatenate([o[k] for o in out]).view(np.int64) if out else np.zeros(0, np.int64) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends))], names=["a", "b"])

    return groups.select("fps", "ds").mapInArrow(pairs, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """fp and root (the least fingerprint that can be reached) of every fingerprint on an edge.

    Large star and small star in turn: each joins a node's neighbours to its least one, so paths shorten by doubling.
    """
    cur = checkpointed(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct())
    ways = F.explode(F.array(F.struct("lo", "hi"), F.struct(F.col("hi").alias("lo"), F.col("lo").alias("hi")))).alias("way")
    while True:
        n, done = _stars(cur)
        cur = sized(cur, LINKS, n)
        if done:
            return cur.select(F.col("hi").alias("fp"), F.col("lo").alias("root")).unionByName(cur.select(F.col("lo").alias("fp"), F.col("lo").alias("root")).distinct())
        both = cur.select(ways).select("way.lo", "way.hi")
        least = both.groupBy("lo").agg(F.least(F.min("hi"), F.first("lo")).alias("m"))
        large = both.join(least, "lo").where(F.col("hi") > F.col("lo")).select(F.col("m").alias("lo"), "hi").where("lo < hi").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select("m", F.explode(F.array("hi", "lo")).alias("hi")).select(F.col("m").alias("lo"), "hi").where("lo < hi").distinct()
        cur = checkpointed(small)


def _stars(edges: DataFrame) -> tuple[int, bool]:
    """How many edges (lo, hi) there are, and whether each node has one edge, to its root, and no root has one."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("lo").alias("x"), F.lit(0).alias("up")), F.struct(F.col("hi").alias("x"), F.lit(1).alias("up")))).alias("e")).select("e.x", "e.up")
    nodes = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
    wrong = (F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("n") > 1))
    state = nodes.agg(F.coalesce(F.sum("ups"), F.lit(0)).alias("n"), F.count_if(wrong).alias("wrong")).first()
    return state["n"], not state["wrong"]


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs``(doc_id, text)."""
    fps = checkpointed(fingerprints(docs, shingle))
    distinct = checkpointed(pivot_table(fps.groupBy("fp").agg(F.min("doc_id").alias("first"))))
    roots = checkpointed(components(links(distinct)))
    labelled = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    # Joins of distinct fingerprints; only the last one meets all rows, and a join's skewed side is split at run time.
    return fps.join(labelled.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash_groups(table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
