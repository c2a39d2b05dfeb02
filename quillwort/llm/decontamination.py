r"""Benchmark decontamination by spaced-seed hashing (operator 3), with DataFrame functions only.

Texts and benchmark items are lower-cased and cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.  A document holds an item if
on one alignment (word i of the item against word i + d of the text) some ``WINDOW`` = 13 words in a row have at least
``NEED`` = 11 equal ones (0.8 or more); an item of fewer words must stand there whole.

Each of the fixed ``MASKS`` looks at 6 of 7 or 9 word places and ignores the others.  Whatever 2 words of 13 are replaced, one
of the two masks fits between them somewhere, so no such overlap is missed (tests/llm proves it by trying all).  The
hashes under the masks are made for every word place of both sides and joined; at each hit the item is laid over the
text on the hit's alignment and verified word by word.

The benchmark side is broadcast if its seeds number at most ``BROADCAST_SEEDS`` (counted first) and joined by shuffling
otherwise.  A word place carries its key and its document's id, never the text; hits are reduced to distinct alignments,
and only texts with hits are met again, by a join on document, to be verified.  Items of equal text are one item (the smallest id).

Null text or item: no words, never found.  Null doc_id is kept.  Rows equal in doc_id and text give one result row.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import checkpointed, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
NEED = 11
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8))
BROADCAST_SEEDS = 1_000_000


def hashed_words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _keys(h: str, salt: int, mask: tuple[int, ...]) -> Column:
    return F.transform(F.col(h), lambda w, i: F.when(i + mask[-1] < F.size(h), F.xxhash64(F.lit(salt), w, *[F.get(F.col(h), i + o) for o in mask[1:]])))


def with_seeds(words: DataFrame, h: str, at: str, short: list[int], keep: list[str]) -> DataFrame:
    """A row for each word place and mask: ``at`` and ``key``, the hash under the mask; ``short`` adds masks of so many
    words in a row.  Only the ``keep`` columns are carried along: a row must not hold its text's words.
    """
    masks = [*enumerate(MASKS), *((-n, tuple(range(n))) for n in short)]
    arrays = words.select(*keep, F.size(h).alias("_n"), F.concat(*[_keys(h, salt, mask) for salt, mask in masks]).alias("_k"))
    # The outer form: from the inner one the optimizer infers a filter on the array's size, and pushing that below the
    # projections writes out the whole word-splitting expression at each use of h.
    rows = arrays.select(*keep, "_n", F.posexplode_outer("_k").alias("_p", "key")).where("key is not null")
    return rows.select(*keep, "key", F.pmod("_p", "_n").alias(at))


def overlap(h: str, bh: str, d: Column) -> Column:
    """The largest share of equal words in a window of the item on alignment d; 0 if it is not enough."""
    n = F.size(bh)
    width = F.least(n, F.lit(WINDOW))
    equal = F.transform(F.col(bh), lambda w, t: F.when((t + d >= 0) & (t + d < F.size(h)) & (F.get(F.col(h), F.greatest(t + d, F.lit(0))) == w), 1).otherwise(0))
    best = F.array_max(F.transform(F.sequence(F.lit(0), n - width), lambda s: F.aggregate(F.slice(equal, s + 1, width), F.lit(0), lambda a, x: a + x)))
    return F.when(best >= F.when(n >= WINDOW, F.lit(NEED)).otherwise(n), best / width).otherwise(F.lit(0.0))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, tie (hash of the text), item_id and score of every (document, item) found."""
    items = benchmark.groupBy("text").agg(F.min(F.col("item_id").cast("long")).alias("item_id"))
    items = items.select("item_id", hashed_words(F.col("text")).alias("bh")).where(F.size("bh") > 0)
    spans = max(m[-1] for m in MASKS) + 1
    short = [r[0] for r in items.where(F.size("bh") < spans).select(F.size("bh")).distinct().orderBy(F.size("bh")).collect()]  # at most 8 numbers
    wanted = with_seeds(items, "bh", "j", short, ["item_id"])
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    words = texts.select("doc_id", "tie", hashed_words(F.col("text")).alias("h"))
    few = wanted.count() <= BROADCAST_SEEDS
    met = with_seeds(words, "h", "i", short, ["doc_id", "tie"]).join(F.broadcast(wanted) if few else wanted, "key")
    found = checkpointed(met.select("doc_id", "tie", "item_id", (F.col("i") - F.col("j")).alias("d")).distinct())
    # Texts with hits only are cut into words again and verified.
    hit = found.select("doc_id", "tie").distinct()
    again = texts.join(hit, texts["doc_id"].eqNullSafe(hit["doc_id"]) & (texts["tie"] == hit["tie"]), "left_semi").dropDuplicates(["doc_id", "tie"]).select("doc_id", "tie", hashed_words(F.col("text")).alias("h"))
    hits = found.join(again, found["doc_id"].eqNullSafe(again["doc_id"]) & (found["tie"] == again["tie"])).drop(again["doc_id"], again["tie"]).join(items, "item_id")
    scored = hits.select("doc_id", "tie", "item_id", overlap("h", "bh", F.col("d")).alias("score")).where("score > 0")
    return scored.groupBy("doc_id", "tie", "item_id").agg(F.max("score").alias("score"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    found = contaminated(docs, benchmark).select("doc_id", "tie").distinct()
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["doc_id"]) & (F.xxhash64(docs["text"]) == found["tie"]), "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each contaminated document: the items it holds and the best overlap."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    per = found.groupBy("doc_id", "tie").agg(F.count("*").alias("n_items"), F.array_join(F.transform(F.sort_array(F.collect_list("item_id")), lambda x: x.cast("string")), ",").alias("items"), F.max("score").alias("score"))
    return per.drop("tie")


OP3_SQL = r"""
WITH b0 AS (SELECT min(item_id) AS item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark GROUP BY text),
b AS (SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS t FROM b0),
d0 AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
d1 AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d0),
d AS (SELECT doc_id, k, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d1),
m AS (SELECT d.doc_id, d.k, b.item_id, b.n, d.p - b.t AS diag, b.t FROM d JOIN b ON d.word = b.word),
g AS (SELECT doc_id, k, item_id, n, diag, list(t ORDER BY t) AS ts FROM m GROUP BY ALL HAVING count(*) >= least(n, 11)),
u AS (SELECT doc_id, k, item_id, n, diag, unnest(ts) AS t FROM g),
c AS (SELECT doc_id, k, item_id, n, count(*) OVER (PARTITION BY k, item_id, diag ORDER BY t RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c FROM u),
f AS (SELECT doc_id, k, item_id, max(c::DOUBLE / least(n, 13)) AS score FROM c WHERE c >= CASE WHEN n >= 13 THEN 11 ELSE n END GROUP BY ALL)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items, max(score) AS score FROM f GROUP BY k
"""
