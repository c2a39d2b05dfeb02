"""Mixing sources to target weights by a low-discrepancy schedule (operator 4).

Contract: a document's size is its number of ``[^\\x20\\x09-\\x0D]+``.  Sources in code-point order (null last) weigh 3, 1, 2,
repeating, and share ``BUDGET`` = 150% of all sizes; a target stops at ``REPEATS`` = 2 times its source's size and the excess
is shared again by weight until none is above.

Schedule: slot k is the golden-ratio point (k + 1) / phi modulo 1, in integer arithmetic modulo 2**48, mapped through the
cumulative quotas of the sources, so every stretch of the mix holds each source in near its share.  Slots are ranked
within their source.  ``mixture`` is the mix itself, a row for each piece of a document in a slot; ``mix`` sums it up by
document, with the first and last slot that the document fills.  A source's
documents stand in a shuffled order (by hash of doc_id and seed), end to end, twice; the stream is cut into blocks of
``BLOCK`` words, and the slot of rank r takes block r.  The block that holds the target's last word is cut there, so a
source's taken words are its target rounded down.  Two passes over a source bound a document by twice its size.

Ranks and running sums are two-level (totals of buckets first, then within a bucket), so no source is ever sorted by one
task.  The three-gap theorem bounds the gaps of n golden points by 2.62 / n, so 3 points for each slot wanted are enough
for every source whatever its share.

Null text: size 0.  Repeated rows and equal or null doc_ids: rows of their own (ties ordered by size, then text hash;
identical rows are interchangeable).  A source of size 0 has target 0.  Empty tables give empty results; other columns
are ignored.  Reruns agree: nothing depends on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quillwort.llm.common import WORD_CLASS, checkpointed, table

BUDGET = 1.5
REPEATS = 2
BLOCK = 1000
SEED = "mix"
ROWS_PER_BUCKET = 2000
#: 2**48 over the golden ratio, and its two halves.
GOLDEN = 0x9E3779B97F4B
_HIGH, _LOW, _MASK = GOLDEN >> 24, GOLDEN & 0xFFFFFF, (1 << 48) - 1
WEIGHTS = (3.0, 1.0, 2.0)  # fixed values
#: Cells of [0, 1) by which points meet the sources' intervals.
CELLS = 4096


def running(df: DataFrame, group: str, bucket: str, order: list[Column], value: Column) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the earlier rows of the group, by bucket and then by ``order``.

    The bucket totals alone are summed by group; rows are ordered within (group, bucket) only.
    """
    v = df.withColumn("_v", value)
    totals = v.groupBy(group, bucket).agg(F.sum("_v").alias("_t"))
    base = totals.withColumn("_base", F.coalesce(F.sum("_t").over(W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    inner = F.coalesce(F.sum("_v").over(W.partitionBy(group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return v.withColumn("_in", inner).join(base, [group, bucket]).withColumn("before", F.col("_base") + F.col("_in")).drop("_v", "_in", "_base")


def source_targets(sized: DataFrame) -> DataFrame:
    """sid (place in code-point order), source, source_size, target of each source.

    Only three sums reach the driver in each step of the sharing, whatever the number of sources.
    """
    totals = checkpointed(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    # A global order without one task sorting all rows: ranges, then places within a range.
    ranged = checkpointed(totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("b", F.spark_partition_id()).withColumn("g", F.lit(0)))
    s = running(ranged, "g", "b", [F.col("source").asc_nulls_last()], F.lit(1)).withColumnRenamed("before", "sid").drop("g", "b")
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % 3 + 1).cast("int"))).withColumn("cap", REPEATS * F.col("source_size").cast("double"))
    s = checkpointed(s)
    total = float(s.agg(F.sum("source_size")).first()[0] or 0) * BUDGET
    share = 0.0
    while True:
        capped = F.col("cap") <= share * F.col("w")
        r = s.agg(F.sum(F.when(capped, F.col("cap"))).alias("c"), F.sum(F.when(~capped, F.col("w"))).alias("w")).first()
        nxt = (total - float(r["c"] or 0)) / float(r["w"]) if r["w"] else share
        if nxt <= share:
            break
        share = nxt
    return s.withColumn("target", F.least(F.lit(share) * F.col("w"), F.col("cap"))).drop("cap", "w")


def golden(k: Column) -> Column:
    """k * GOLDEN modulo 2**48, without overflow for k up to 2**38."""
    return (F.shiftleft((k * F.lit(_HIGH)).bitwiseAND(F.lit(0xFFFFFF)), 24) + k * F.lit(_LOW)).bitwiseAND(F.lit(_MASK))


def schedule(spark: SparkSession, quotas: DataFrame) -> DataFrame:
    """sid, rank and slot of quotas(sid, quota): the first ``quota`` slots of each source."""
    q = checkpointed(running(quotas.withColumn("g", F.lit(0)).withColumn("b", F.floor(F.col("sid") / ROWS_PER_BUCKET)), "g", "b", [F.col("sid")], F.col("quota")).select("sid", "quota", "before"))
    slots = int(q.agg(F.sum("quota")).first()[0] or 0)
    edge = lambda c: F.floor(c / F.lit(float(max(slots, 1))) * F.lit(float(1 << 48))).cast("long")
    spans = q.where("quota > 0").select("sid", "quota", edge(F.col("before")).alias("lo"), edge(F.col("before") + F.col("quota")).alias("hi"))
    width = (1 << 48) // CELLS
    spans = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))))
    points = spark.range(3 * slots).withColumn("u", golden(F.col("id") + 1)).withColumn("cell", F.floor(F.col("u") / width))
    drawn = points.join(spans, "cell").where("lo <= u and u < hi").select("sid", "quota", "id", F.floor(F.col("id") / F.lit(ROWS_PER_BUCKET)).alias("bucket"))
    return running(drawn, "sid", "bucket", [F.col("id")], F.lit(1)).where("before < quota").select("sid", F.col("before").alias("rank"), F.col("id").alias("slot"))


def placed_documents(docs: DataFrame) -> DataFrame:
    """Every row with its size, its source's size and target, and the place where its words start in the source's stream."""
    sized = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD_CLASS)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("tie"))
    sized = checkpointed(sized.withColumn("key", F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))))
    targets = checkpointed(source_targets(sized))
    deep = max(1, sized.count() // ROWS_PER_BUCKET)
    # Shuffled order: the key's first digits make the bucket.
    keyed = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    keyed = keyed.withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * F.lit(deep)).cast("long"))
    placed = running(keyed, "sid", "bucket", [F.col("key"), F.col("doc_id"), F.col("size"), F.col("tie")], F.col("size")).withColumn("row", F.monotonically_increasing_id())
    return checkpointed(placed)  # the row numbers must not change


def mixture(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: slot, sid, row, doc_id, start (the piece's first word in its document) and words, of placed_documents."""
    last = F.floor("target").cast("long")
    quotas = placed.groupBy("sid").agg(F.first(F.ceil(last / F.lit(float(block)))).cast("long").alias("quota"))
    # Blocks: the pieces of each document, in both passes, that lie before the target.
    passes = placed.where("size > 0").select("row", "sid", "doc_id", "size", last.alias("last"), F.explode(F.array(*[F.col("before") + k * F.col("source_size") for k in range(REPEATS)])).alias("a"))
    passes = passes.withColumn("z", F.least(F.col("a") + F.col("size"), F.col("last"))).where("a < z")
    pieces = passes.select("row", "sid", "doc_id", "a", "z", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("z") - 1) / block))).alias("rank"))
    from_ = F.greatest(F.col("a"), F.col("rank") * block)
    pieces = pieces.select("row", "sid", "doc_id", "rank", (from_ - F.col("a")).alias("start"), (F.least(F.col("z"), (F.col("rank") + 1) * block) - from_).alias("words"))
    return pieces.join(schedule(placed.sparkSession, quotas), ["sid", "rank"]).select("slot", "sid", "row", "doc_id", "start", "words")


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_slot and last_slot of every row of ``docs``(doc_id, text, source)."""
    placed = placed_documents(docs)
    taken = mixture(placed, block).groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    return placed.join(taken, "row", "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "last_slot")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
c AS (SELECT *, [3.0, 1.0, 2.0][sid % 3 + 1]::DOUBLE AS w, 2 * source_size::DOUBLE AS cap FROM s),
step(n, share) AS (
  SELECT 0, (SELECT sum(source_size)::DOUBLE * 1.5 / sum(w) FROM c)
  UNION ALL
  SELECT n + 1, (SELECT ((SELECT sum(source_size)::DOUBLE * 1.5 FROM c) - coalesce(sum(cap) FILTER (cap <= share * w), 0)) / sum(w) FILTER (cap > share * w) FROM c) FROM step WHERE n < 50),
t AS (SELECT sid, source, source_size, least((SELECT max(share) FROM step) * w, cap) AS target FROM c),
p AS (
  SELECT row_number() OVER () AS r, d.*, t.sid, t.source_size, t.target, floor(target)::BIGINT AS z,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix' || doc_id::VARCHAR), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT sid, ceil(floor(target) / 1e3)::BIGINT AS quota FROM t),
qs AS (SELECT *, coalesce(sum(quota) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS lo, (SELECT sum(quota) FROM q)::DOUBLE AS n FROM q),
spans AS (SELECT sid, quota, floor(lo / n * 281474976710656e0)::BIGINT AS lo, floor((lo + quota) / n * 281474976710656e0)::BIGINT AS hi FROM qs WHERE quota > 0),
points AS (SELECT k, (((k + 1)::HUGEINT * 173961102589771) % 281474976710656)::BIGINT AS u FROM (SELECT unnest(range(0, 3 * (SELECT sum(quota) FROM q)::BIGINT)) AS k)),
slots AS (SELECT * FROM (SELECT sid, quota, k AS slot, row_number() OVER (PARTITION BY sid ORDER BY k) - 1 AS rank FROM points JOIN spans ON lo <= u AND u < hi) WHERE rank < quota),
two AS (SELECT r, sid, size, z, a FROM p WHERE size > 0 UNION ALL SELECT r, sid, size, z, a + source_size FROM p WHERE size > 0),
cut AS (SELECT r, sid, a, least(a + size, z) AS z FROM two WHERE a < z),
pieces AS (SELECT r, sid, a, z, unnest(range(a // 1000, (z - 1) // 1000 + 1)) AS rank FROM cut),
got AS (SELECT r, sum(least(z, (rank + 1) * 1000) - greatest(a, rank * 1000))::BIGINT AS taken, min(slot) AS first_slot, max(slot) AS last_slot FROM pieces JOIN slots USING (sid, rank) GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot, last_slot FROM p LEFT JOIN got USING (r)
"""
