"""Target-distribution importance resampling over word tries (operator 12).

A-Z lower-cased; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; features are all runs of 1 to ``longest`` words, joined by one
space, repeats counted; a feature's bucket is the crc32 of its UTF-8 bytes modulo ``buckets``.

* A task walks its texts into a *trie* of its own: a node is a run of words, an edge a further word.  A node holds its count
  and the CRC state of its bytes, so a child's bucket costs the bytes of one more word.  A trie past ``NODES`` nodes is folded
  into its task's bucket totals and begun anew.  A task sends at most ``buckets`` sums; Spark merges them by bucket.
* A bucket's gain is floor(1000 * ln((t+1)(S+buckets) / ((s+1)(T+buckets)))), of s in the bucket and S in all for the corpus, t
  and T for the target.  The driver sees two numbers a bucket, ``buckets`` rows at most.
* The second pass walks the texts through tries whose nodes have gains attached, and adds up.  The weight is the floored mean,
  0 without features; the score adds Gumbel noise from sha256 of ``<seed>:<doc_id>``.
* Of N documents with ``least_words`` words or more, floor(percent * N / 100) are drawn.  A histogram of scores in two steps (coarse
  blocks, then one block: a few hundred numbers each) gives the score of the last one drawn; rows of at least that score are
  range-partitioned and numbered, all others pass by unshuffled.

Null text: no features.  Null doc_id: noise of ``<seed>:``, last among ties.  Repeated rows are rows of their own; rows equal in
score and doc_id are drawn by n_features, then weight.  An empty target or corpus gives sums of 0; empty tables give empty
results.  Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quillwort.llm.common import checkpointed, slices, table

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Nodes of a trie before it is folded.
NODES = 200_000
#: Scores in a block of the coarse histogram.
BLOCK = 512
_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_LOWER = bytes(range(256)).lower()
_TO_WORDS = bytes(c if c in _KEPT else 0x20 for c in _LOWER)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class _First(dict):
    def __init__(self, trie: Trie):
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        self[word] = node = self.trie.add(zlib.crc32(word), word)
        return node


class Trie:
    """Runs of up to ``longest`` words.  Nodes are numbers; ``crc[node]`` is the CRC state of the run's bytes, ``word[node]`` a
    first-level node's word.  First-level nodes double as the numbers of words."""

    def __init__(self, longest: int):
        self.longest = longest
        self.crc: list[int] = []
        self.word: dict[int, bytes] = {}
        self.first = _First(self)
        self.deeper: dict[tuple[int, int], int] = {}

    def __len__(self) -> int:
        return len(self.crc)

    def add(self, crc: int, word: bytes | None = None) -> int:
        self.crc.append(crc)
        if word is not None:
            self.word[len(self.crc) - 1] = word
        return len(self.crc) - 1

    def child(self, parent: int, word: int) -> int:
        node = self.deeper.get((parent, word))
        if node is None:
            node = self.deeper[parent, word] = self.add(zlib.crc32(b" " + self.word[word], self.crc[parent]))
        return node

    def walk(self, words: list[bytes]) -> np.ndarray:
        """The node at the end of each run of the text, runs of one word first."""
        at = first = np.fromiter(map(self.first.__getitem__, words), np.int64, len(words))
        paths = [first]
        for k in range(1, min(self.longest, len(words))):
            step, of = np.unique(np.stack([at[:-1], first[k:]], 1), axis=0, return_inverse=True)
            at = np.fromiter((self.child(p, w) for p, w in step.tolist()), np.int64, len(step))[of.ravel()]
            paths.append(at)
        return np.concatenate(paths)


def bucket_totals(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of docs(text) fall in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, trie, counts = np.zeros(buckets, np.int64), Trie(longest), np.zeros(0, np.int64)

        def fold() -> None:
            np.add.at(totals, np.array(trie.crc[: len(counts)], np.int64) % buckets, counts)

        for b in slices(batches, 200):
            for text in b.column(0).cast(pa.binary()).to_pylist():
                seen = np.bincount(trie.walk(words_of(text or b"")), minlength=len(counts))
                seen[: len(counts)] += counts
                counts = seen
                if len(trie) > NODES:
                    fold()
                    trie, counts = Trie(longest), np.zeros(0, np.int64)
        fold()
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(totals[at])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    size, of, to = float(len(corpus)), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (of + size) / ((s + 1.0) * (to + size)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, at_node = Trie(longest), np.zeros(0, np.int64)
        for b in slices(batches, 200):
            rows = []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                words = words_of(text or b"")
                path = trie.walk(words)
                if len(trie) > len(at_node):
                    at_node = np.r_[at_node, gain[np.array(trie.crc[len(at_node) :], np.int64) % len(gain)]]
                rows.append((len(words), len(path), int(at_node[path].sum()) // len(path) if len(path) else 0))
                if len(trie) > NODES:
                    trie, at_node = Trie(longest), np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def last_score(scores: DataFrame, draw: int) -> int | None:
    """The ``draw``-th highest of scores(score); None if nothing is drawn."""
    if draw < 1:
        return None
    left = draw
    for key in (F.floor(F.col("score") / BLOCK), F.col("score")):
        for r in sorted(scores.groupBy(key.alias("key")).count().collect(), reverse=True):
            if left <= r["count"]:
                at = r["key"]
                break
            left -= r["count"]
        scores = scores.where(F.floor(F.col("score") / BLOCK) == at)
    return at


def numbered(df: DataFrame, *order) -> DataFrame:
    """Adds ``rank``, 1, 2, 3... in the given order, by ranges: only a count for each range meets in one place."""
    at = F.monotonically_increasing_id()
    ranged = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at))
    part = F.shiftright("_at", 33).alias("_part")
    before = ranged.groupBy(part).agg(F.count("*").alias("_n")).select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return ranged.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_before")


def resample(docs: DataFrame, target: DataFrame, *, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every row of docs(doc_id, text)."""
    gain = gains(bucket_totals(docs, longest, buckets), bucket_totals(target, longest, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = checkpointed(weighed(docs, gain, longest).withColumn("score", (F.col("weight") + noise).cast("long")))
    able = scored.where(F.col("n_words") >= least_words)
    draw = percent * able.count() // 100
    last = last_score(able.select("score"), draw)
    drawn = (F.col("n_words") >= least_words) & (F.col("score") >= F.lit(last).cast("long")) if last is not None else F.lit(False)
    ranked = numbered(scored.where(drawn), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"))
    rank = F.when(F.col("rank") <= draw, F.col("rank")).cast("long").alias("rank")
    columns = ("doc_id", "n_features", "weight", "score")
    return ranked.select(*columns, rank).unionByName(scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 by its table, which the rule of the polynomial 0xEDB88320 gives; words are counted first, so each is hashed once.
OP12_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n::BIGINT)) AS tab),
dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM dw) GROUP BY ALL),
occ_t AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY 1),
b AS (SELECT word, xor(list_reduce(list_transform(range(1, octet_length(encode(word)) + 1), lambda i: ('0x' || substr(hex(encode(word)), (2 * i - 1)::BIGINT, 2))::BIGINT),
  lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket FROM (SELECT word FROM occ UNION SELECT word FROM occ_t), crc),
s AS (SELECT bucket, sum(n) AS s FROM occ JOIN b USING (word) GROUP BY 1), t AS (SELECT bucket, sum(n) AS t FROM occ_t JOIN b USING (word) GROUP BY 1),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1e0) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000e0) / ((coalesce(s, 0) + 1e0) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000e0))))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM b) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
wt AS (SELECT r, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM occ JOIN b USING (word) JOIN g USING (bucket) GROUP BY r),
sc AS (SELECT dw.r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5e0) / 4294967296e0))))::BIGINT AS score FROM dw LEFT JOIN wt USING (r)),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM k) * 10 // 100 THEN rank END::BIGINT AS rank FROM sc LEFT JOIN k USING (r)"""
