"""Document fingerprints: a homomorphic multiset hash (operator 9), with DataFrame functions only.

A text is the multiset of its paragraphs (lines).  A paragraph has a wide vector: ``EQUAL`` = 8 lanes of 32 bits hashed from
the whole paragraph, and ``ALIKE`` = 128 lanes that count, for each bit of two hashes, the paragraph's word triples which
have it set (a paragraph of one or two words is one unit).  A fingerprint is the sum of the vectors, lane by lane, modulo
2**32; likeness is right for texts of up to 2**31 - 1 units.  Sums do not depend on order; ``inserted`` and ``deleted`` add
and subtract a paragraph's vector without reading the rest.

Likeness: a bit count c of n units gives 2c - n, a sum of random signs, so the mean square of a lane difference
estimates the squared distance of the two multisets, and 1 - distance / (sum of squared norms) is 1 for equal multisets
and about 0 for disjoint ones.  It needs the fingerprints only.
With 128 lanes its error is about 0.04 in the mean and up to 0.2 for near texts; far texts may get up to 0.3 instead of 0.

Contract query: the edited text replaces the last floor(n/3) code points by the first as many (or all) of the next
document in descending doc_id (after the last: the first).

The neighbour comes without a global sort in one task: chunks are ranges of doc_id, a window orders within a chunk, and
the chunk's last row takes the first text of the next lower chunk by a join on the chunk.  All further steps (units,
sums, likeness) keep the partitioning by chunk, so texts are shuffled once.

Null text: empty.  Null doc_id: before all others in the descending order.  Rows of equal doc_id: ordered by text.  A
single document is its own next one.  Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quillwort.llm.common import WORD_CLASS, id_chunk, table

EQUAL = 8
ALIKE = 128
ROWS_PER_CHUNK = 2000
#: Chunk tops (two numbers each) are broadcast up to so many; beyond, they are joined by shuffling.
BROADCAST_CHUNKS = 200_000
_M32 = (1 << 32) - 1
_PAIR = (1 << 32) + 1


def equal_lanes(text: Column) -> Column:
    """Sum over the paragraphs of EQUAL hashed 32-bit lanes, modulo 2**32."""
    lanes = lambda p: F.flatten(F.array(*[F.array(F.xxhash64(F.lit(k), p).bitwiseAND(F.lit(_M32)), F.shiftrightunsigned(F.xxhash64(F.lit(k), p), 32)) for k in range(EQUAL // 2)]))
    zero = F.array(*[F.lit(0).cast("long")] * EQUAL)
    return F.aggregate(F.split(text, "\n"), zero, lambda acc, p: F.zip_with(acc, lanes(p), lambda a, b: (a + b).bitwiseAND(F.lit(_M32))))


def units(text: Column) -> Column:
    """Hashes of the word triples of every paragraph."""
    words = F.filter(F.transform(F.split(text, "\n"), lambda p: F.regexp_extract_all(p, F.lit(WORD_CLASS), F.lit(0))), lambda ws: F.size(ws) > 0)
    return F.flatten(F.transform(words, lambda ws: F.transform(F.sequence(F.lit(0), F.greatest(F.size(ws) - 3, F.lit(0))), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))))


def fingerprinted(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys and v: struct(eq, n, lanes) of each row's text.  The keys must tell the rows apart."""
    # The lanes of paragraphs are made before the units are dealt out: once a text, not once a unit.
    whole = texts.select(*keys, equal_lanes(F.col(text)).alias("eq"), units(F.col(text)).alias("u"))
    unit = whole.select(*keys, "eq", F.explode_outer("u").alias("a"))
    unit = unit.withColumn("b", F.xxhash64(F.lit("second"), "a"))
    # Two bit counts a sum: bits s and s + 32, 32 binary digits apart.
    sums = [F.sum(F.shiftrightunsigned(c, s).bitwiseAND(F.lit(_PAIR))).alias(f"{c}{s}") for c in "ab" for s in range(32)]
    got = unit.groupBy(*keys, "eq").agg(F.count("a").alias("n"), *sums)
    lane = lambda c, s, hi: F.coalesce(F.shiftrightunsigned(f"{c}{s}", 32) if hi else F.col(f"{c}{s}").bitwiseAND(F.lit(_M32)), F.lit(0)).bitwiseAND(F.lit(_M32))
    lanes = F.array(*[lane(c, s, hi) for c in "ab" for hi in (0, 1) for s in range(32)])
    return got.select(*keys, F.struct("eq", F.col("n").bitwiseAND(F.lit(_M32)).alias("n"), lanes.alias("lanes")).alias("v"))


def written(v: str) -> Column:
    """A fingerprint as hexadecimal digits."""
    digits = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    return F.concat(F.array_join(F.transform(F.col(f"{v}.eq"), lambda x: digits(x, 8)), ""), digits(F.col(f"{v}.n"), 8), F.array_join(F.transform(F.col(f"{v}.lanes"), lambda x: digits(x, 8)), ""))


def likeness(u: str, v: str) -> Column:
    """1 for equal fingerprints, about 0 for disjoint ones."""
    centred = lambda x: F.pmod(x + (1 << 31), F.lit(1 << 32)) - (1 << 31)
    sign = lambda c: F.transform(F.col(f"{c}.lanes"), lambda x: centred(2 * x - F.col(f"{c}.n")).cast("double"))
    square = lambda arr: F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x)
    d = F.zip_with(F.transform(F.col(f"{u}.lanes"), lambda x: 2 * x - F.col(f"{u}.n")), F.transform(F.col(f"{v}.lanes"), lambda x: 2 * x - F.col(f"{v}.n")), lambda a, b: centred(a - b).cast("double"))
    both = square(sign(u)) + square(sign(v))
    near = F.when(both > 0, F.greatest(F.lit(0.0), F.lit(1.0) - square(d) / both)).otherwise(F.lit(0.0))
    return F.when(F.col(u) == F.col(v), F.lit(1.0)).otherwise(near)


def _combined(v: str, w: str, sign: int) -> Column:
    mod = lambda a, b, m: F.pmod(a + sign * b, F.lit(m))
    return F.struct(
        F.zip_with(F.col(f"{v}.eq"), F.col(f"{w}.eq"), lambda a, b: mod(a, b, 1 << 32)).alias("eq"), mod(F.col(f"{v}.n"), F.col(f"{w}.n"), 1 << 32).alias("n"),
        F.zip_with(F.col(f"{v}.lanes"), F.col(f"{w}.lanes"), lambda a, b: mod(a, b, 1 << 32)).alias("lanes"),
    )


def inserted(v: str, w: str) -> Column:
    """The fingerprint column v with the paragraphs of fingerprint column w added."""
    return _combined(v, w, 1)


def deleted(v: str, w: str) -> Column:
    return _combined(v, w, -1)


def with_next(docs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> tuple[DataFrame, DataFrame]:
    """pid, rn, doc_id, text and next_text (the text that follows in descending doc_id, after the last the first); and,
    for each pid, the text that follows its last row."""
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), id_chunk(docs, "doc_id", rows_per_chunk).alias("pid"))
    w = W.partitionBy("pid").orderBy(F.desc_nulls_first("doc_id"), "text")
    rows = base.select("pid", "doc_id", "text", F.row_number().over(w).alias("rn"), F.lead("text").over(w).alias("after"))
    # First texts: the largest id of each chunk from an id-only pass, then those rows.
    tops = base.groupBy("pid").agg(F.max("doc_id").alias("top"))
    few = tops.count() <= BROADCAST_CHUNKS
    first = base.withColumnRenamed("pid", "p").join(F.broadcast(tops) if few else tops, (F.col("p") == F.col("pid")) & F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("pid").agg(F.min("text").alias("head"))
    every = tops.select("pid")
    follow = every.select("pid", F.coalesce(F.lead("pid").over(W.orderBy(F.desc("pid"))), F.max("pid").over(W.partitionBy(F.lit(0)))).alias("to"))
    heads = follow.join(first.withColumnRenamed("pid", "to"), "to").select("pid", "head")
    return rows.join(heads, "pid").select("pid", "rn", "doc_id", "text", F.coalesce("after", "head").alias("next_text")), heads


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def edited_fingerprints(docs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    n = F.length("text")
    rows, heads = with_next(docs, rows_per_chunk)
    rows = rows.withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))"), F.expr("left(next_text, cast(floor(length(text) / 3) as int))")))
    kept = rows.select("pid", "rn", "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("s"))
    flat = kept.select("pid", "rn", "doc_id", "n_chars", "edited_sha256", F.col("s.which").alias("which"), F.col("s.t").alias("t"))
    keys = ["pid", "rn", "doc_id", "n_chars", "edited_sha256"]
    fps = fingerprinted(flat, [*keys, "which"], "t").groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("v"))).alias("own"), F.max(F.when(F.col("which") == 1, F.col("v"))).alias("edited"))
    first = fingerprinted(heads.select("pid", "head"), ["pid"], "head").select("pid", F.col("v").alias("head"))
    done = fps.withColumn("next", F.lead("own").over(W.partitionBy("pid").orderBy("rn"))).join(first, "pid").withColumn("next", F.coalesce("next", "head"))
    return done.select("doc_id", "n_chars", "edited_sha256", written("own").alias("fingerprint"), written("edited").alias("edited_fingerprint"), likeness("own", "edited").alias("near_edited"), likeness("own", "next").alias("near_next"))
