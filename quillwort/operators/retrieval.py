"""Ranking, substring search, linking and budgeted bundles over cards and edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quillwort.functions.text import link_tokens, runs, search_tokens


#: Query terms and their counts are broadcast up to so many, counted first; df has a row a query term at most.
BROADCAST_TERMS = 200_000
#: Scores are rounded, and sums depend on their order: by so much a pair may fall short while it is only a candidate.
SLACK = 1e-5
#: Words up to which a card's title or an entry brings all of them along with each.
MOST_WORDS = 256


def in_client_scope(client: str | None) -> Column:
    """False for memory and issue cards of other clients."""
    return ~(F.col("type").isin("memory", "issue") & ~F.col("client").eqNullSafe(F.lit(client)))


def searchable(cards: DataFrame, client: str | None = None, product: str | None = None) -> DataFrame:
    """Concept cards, and memory cards of the asking client; the filter comes before document frequencies."""
    rows = cards.where((F.col("type") == "concept") | ((F.col("type") == "memory") & in_client_scope(client)))
    return rows.where(F.col("product") == product) if product else rows


def list_concepts(cards: DataFrame, client: str | None = None) -> DataFrame:
    return cards.where((F.col("type") != "correction") & in_client_scope(client)).select("card_id", "title", "product", "type", "regime", "client")


def rank_concepts(queries: DataFrame, cards: DataFrame, limit: int = 20) -> DataFrame:
    """Top cards of every query(qid, query): sum over its distinct terms of idf * (1 + ln tf), idf = ln((1 + N) / (1 + df)) + 1.

    One term table gives tf and, by a count over the same rows, df; queries join it by term, so a batch of queries
    costs one pass.  Only terms that some query has are kept before the shuffle.
    """
    n = cards.count()
    wanted = queries.select("qid", F.explode(F.array_distinct(search_tokens("query"))).alias("term"))
    terms = wanted.select("term").distinct()
    few = terms.count() <= BROADCAST_TERMS
    mark = F.broadcast if few else (lambda df: df)
    # Stop words are no query's terms, so the join takes them off the cards, too.
    tf = cards.select("card_id", F.explode(runs(F.concat_ws(" ", "title", "description", "card_id"))).alias("term")).join(mark(terms), "term", "left_semi").groupBy("term", "card_id").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weight = tf.join(mark(df), "term").select("term", "card_id", ((F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + 1.0) * (1.0 + F.log(F.col("tf").cast("double")))).alias("w"))
    scored = weight.join(wanted, "term").groupBy("qid", "card_id").agg(F.round(F.sum("w"), 6).alias("score")).where("score > 0")
    place = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("score"), "card_id"))
    return scored.withColumn("place", place).where(F.col("place") <= limit)


def search_objects(objects: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Objects by how many query tokens (repeats count) their title, description and id contain."""
    hay = F.lower(F.concat_ws(" ", "title", "description", "card_id"))
    score = sum((F.when(hay.contains(t), 1).otherwise(0) for t in query.lower().split()), F.lit(0))
    return objects.select("card_id", "title", score.alias("score")).where("score > 0").orderBy(F.desc("score"), "card_id").limit(limit)


def suggest_links(entries: DataFrame, cards: DataFrame, top: int = 3, least: float = 0.30, shared: int = 2, checkpoint: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Links of entries(entry_id, query) to concept cards: the share of the card's idf mass that the entry's words cover.

    An entry that has none of a card's rarest words, whose mass leaves less than ``least`` of it to the rest, cannot reach
    ``least``.  So entries meet cards by these words only, never by a card's common ones.  Both bring all their words along: a
    pair is scored in full where it first meets, and what is exchanged grows with the words and the links, not with the pairs
    that meet.  What has over ``MOST_WORDS`` words brings none; its pairs are gathered and counted afterwards.
    """
    target = cards.where("type = 'concept'").select("card_id", F.explode(link_tokens(F.concat_ws(" ", "title", F.replace("card_id", F.lit("/"), F.lit(" "))))).alias("t"))
    n = target.select("card_id").distinct().count()
    idf = target.groupBy("t").agg((F.log(F.lit(n + 1.0) / (F.count("*") + F.lit(1.0))) + 1.0).alias("idf"))
    held = target.join(idf, "t").groupBy("card_id").agg(F.sum("idf").alias("mass"), F.sort_array(F.collect_list(F.struct("idf", "t")), False).alias("w"))
    leaves = lambda s: F.col("mass") - s["before"] >= (least - SLACK) * F.col("mass")
    rarest = F.aggregate("w", F.struct(F.lit(0.0).alias("before"), F.lit(0).alias("n")), lambda s, x: F.struct((s["before"] + x["idf"]).alias("before"), (s["n"] + F.when(leaves(s), 1).otherwise(0)).alias("n")))
    held = checkpoint(held.withColumn("rarest", rarest["n"]))
    asked = checkpoint(entries.select("entry_id", link_tokens("query").alias("ws")))
    rare = held.withColumn("t", F.explode(F.transform(F.array_distinct(F.slice("w", 1, F.col("rarest"))), lambda x: x["t"])))
    words = asked.withColumn("t", F.explode("ws"))
    few, few_asked = F.size("w") <= MOST_WORDS, F.size("ws") <= MOST_WORDS
    common = F.filter("w", lambda x: F.array_contains("ws", x["t"]))
    hit = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x["idf"])
    tally = F.transform(F.array(common), lambda c: F.struct(F.get(c, 0)["t"].alias("first"), F.size(c).cast("long").alias("n_shared"), F.round(hit(c) / F.col("mass"), 6).alias("score")))
    # The words of w and those that meet go by the same order, so the first common one is one that meets.
    enough = F.filter(tally, lambda x: (x["first"] == F.col("t")) & (x["n_shared"] >= shared) & (x["score"] >= least))
    scored = words.where(few_asked).join(rare.where(few), "t").select("entry_id", "card_id", F.explode(enough).alias("x")).select("entry_id", "card_id", "x.n_shared", "x.score")
    many, many_asked = not held.where(~few).isEmpty(), not asked.where(~few_asked).isEmpty()
    if many or many_asked:
        word, own = words.select("entry_id", "t"), words.where(~few_asked).select("entry_id", "t")
        pairs = word.join(rare.where(~few).select("card_id", "t"), "t").unionByName(own.join(rare.where(few).select("card_id", "t"), "t")).select("entry_id", "card_id").distinct()
        met = pairs.join(held, "card_id").select("entry_id", "card_id", "mass", F.explode("w").alias("x")).select("entry_id", "card_id", "mass", "x.t", "x.idf").join(word, ["entry_id", "t"])
        got = met.groupBy("entry_id", "card_id").agg(F.count("*").alias("n_shared"), F.round(F.sum("idf") / F.first("mass"), 6).alias("score"))
        scored = scored.unionByName(got.where((F.col("n_shared") >= shared) & (F.col("score") >= least)))
    return scored.withColumn("place", F.row_number().over(W.partitionBy("entry_id").orderBy(F.desc("score"), "card_id"))).where(F.col("place") <= top).select("entry_id", "card_id", "n_shared", "score", "place")


def resolve_bundles(requests: DataFrame, cards: DataFrame, edges: DataFrame, depth: int = 1, max_cards: int = 8, client: str | None = None) -> DataFrame:
    """Breadth-first bundles of requests(request_id, seed, seed_pos): request_id, card_id, place; places over max_cards are dropped ones.

    A level is one join of the frontier with edges and cards.  A neighbour of another regime than its parent (both
    known) or out of client scope is refused for that edge only.  The first visit by (parent's place, edge position)
    counts; ``max_cards`` cuts seeds, too, and what it cuts is not expanded.  Repeated seeds count once.
    """
    info = cards.select("card_id", "regime", "type", "client").where(in_client_scope(client))
    seeds = requests.groupBy("request_id", F.col("seed").alias("card_id")).agg(F.min("seed_pos").alias("p")).join(info, "card_id")
    level = seeds.withColumn("place", F.row_number().over(W.partitionBy("request_id").orderBy("p"))).select("request_id", "card_id", "regime", "place")
    seen = level
    for _ in range(depth):
        nxt = level.where(F.col("place") <= max_cards).withColumnRenamed("card_id", "src").withColumnRenamed("regime", "from_regime").join(edges.select("src", "dst", "pos"), "src").join(info.withColumnRenamed("card_id", "dst"), "dst")
        nxt = nxt.where(F.col("from_regime").isNull() | F.col("regime").isNull() | (F.col("from_regime") == F.col("regime")))
        nxt = nxt.join(seen.select("request_id", F.col("card_id").alias("dst")), ["request_id", "dst"], "left_anti")
        first = nxt.groupBy("request_id", "dst").agg(F.min(F.struct("place", "pos")).alias("at"), F.first("regime").alias("regime"))
        have = seen.groupBy("request_id").agg(F.max("place").alias("have"))
        level = first.join(have, "request_id").withColumn("place", F.col("have") + F.row_number().over(W.partitionBy("request_id").orderBy("at"))).select("request_id", F.col("dst").alias("card_id"), "regime", "place")
        seen = seen.unionByName(level)
    return seen.select("request_id", "card_id", "place")


def budgeted_bundles(placed: DataFrame, cards: DataFrame, max_cards: int = 8, max_chars: int | None = None) -> DataFrame:
    """request_id, card_ids, corrections, dropped and chars of resolve_bundles' rows.

    In order of place, a card that would exceed ``max_chars`` is dropped (the first never is) and later ones may still
    fit.  Approved corrections of the kept cards follow, each once.  A bundle's kept cards are at most max_cards, so the
    fold over them is bounded.
    """
    size = cards.select("card_id", F.col("n_chars").cast("long").alias("chars"))
    rows = placed.join(size, "card_id")
    kept = F.sort_array(F.collect_list(F.when(F.col("place") <= max_cards, F.struct("place", "card_id", "chars"))))
    over = F.sort_array(F.collect_list(F.when(F.col("place") > max_cards, F.struct("place", "card_id"))))
    got = rows.groupBy("request_id").agg(kept.alias("kept"), F.transform(over, lambda x: x["card_id"]).alias("over"))
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("ids"), none.alias("out"), F.lit(0).cast("long").alias("used"))
    fits = lambda a, x: (F.size(a["ids"]) == 0) | (a["used"] + x["chars"] <= max_chars) if max_chars is not None else F.lit(True)
    step = lambda a, x: F.struct(
        F.when(fits(a, x), F.array_append(a["ids"], x["card_id"])).otherwise(a["ids"]).alias("ids"), F.when(fits(a, x), a["out"]).otherwise(F.array_append(a["out"], x["card_id"])).alias("out"),
        (a["used"] + F.when(fits(a, x), x["chars"]).otherwise(0)).alias("used"),
    )
    got = got.withColumn("b", F.aggregate("kept", start, step)).select("request_id", F.col("b.ids").alias("card_ids"), F.concat("over", "b.out").alias("dropped"), F.col("b.used").alias("chars"))
    fixes = cards.where("type = 'correction' and status = 'approved' and corrects is not null").select(F.col("corrects").alias("target"), F.col("card_id").alias("fix"), "ord")
    pulled = got.select("request_id", "card_ids", F.posexplode("card_ids").alias("pos", "target")).join(fixes, "target").where(~F.array_contains("card_ids", F.col("fix")))
    pulled = pulled.groupBy("request_id", "fix").agg(F.min(F.struct("pos", "ord")).alias("at")).groupBy("request_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "fix"))), lambda x: x["fix"]).alias("corrections"))
    return got.join(pulled, "request_id", "left").select("request_id", "card_ids", F.coalesce("corrections", none).alias("corrections"), "dropped", "chars")
