"""Scores of an evaluation run and their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.functions.cards import client_of_id

ROLES = ("select", "answer", "judge")


def _crossing(expected: str, value: Column) -> Column:
    """How many values are known and differ from what is expected, where something is."""
    return F.coalesce(F.count_if(F.col(expected).isNotNull() & value.isNotNull() & (value != F.col(expected))), F.lit(0))


def scores(questions: DataFrame, answers: DataFrame, served: DataFrame, cards: DataFrame) -> DataFrame:
    """One row a question: hits, crossings and what is in order.

    questions(id, client, expected_regime, expected_product, expected_version, expects_correction, expects_memory),
    answers(id, expected: the cards that answer it), served(id, card_id, selected: also chosen, or expanded only),
    cards(card_id, regime, product, versions, client).  A null card facet crosses nothing; a null expectation is in order.
    """
    info = cards.select("card_id", "regime", "product", "versions", F.col("client").alias("card_client"))
    rows = questions.join(served, "id", "left").join(info, "card_id", "left")
    wanted = answers.select("id", F.col("expected").alias("card_id"), F.lit(True).alias("hit")).distinct()
    rows = rows.join(wanted, ["id", "card_id"], "left")
    chosen = lambda c: F.when(F.col("selected"), F.col(c))
    off = F.col("selected") & F.col("expected_version").isNotNull() & F.col("versions").isNotNull() & ~F.array_contains("versions", F.col("expected_version"))
    keys = ["id", "client", "expected_regime", "expected_product", "expected_version", "expects_correction", "expects_memory"]
    got = rows.groupBy(*keys).agg(
        F.coalesce(F.bool_or(F.col("hit") & F.col("selected")), F.lit(False)).alias("select_hit"), F.coalesce(F.bool_or("hit"), F.lit(False)).alias("bundle_hit"),
        _crossing("expected_regime", chosen("regime")).alias("cross_regime"), _crossing("expected_product", chosen("product")).alias("cross_product"), F.count_if(off).alias("off_version"),
        F.count_if(F.col("card_client").isNotNull() & ~F.col("card_client").eqNullSafe(F.col("client"))).alias("cross_client"),
        F.coalesce(F.bool_or(F.col("card_id") == F.col("expects_correction")), F.lit(False)).alias("_correction"), F.coalesce(F.bool_or(F.col("card_id") == F.col("expects_memory")), F.lit(False)).alias("_memory"),
    )
    return got.select(
        "id", "select_hit", "bundle_hit", "cross_regime", (F.col("cross_regime") == 0).alias("regime_ok"), "cross_product", (F.col("cross_product") == 0).alias("product_ok"), "off_version", (F.col("off_version") == 0).alias("version_ok"),
        (F.col("expects_correction").isNull() | F.col("_correction")).alias("correction_ok"), "cross_client", ((F.col("cross_client") == 0) & (F.col("expects_memory").isNull() | F.col("_memory"))).alias("memory_ok"),
    )


def totals(scored: DataFrame, replies: DataFrame) -> DataFrame:
    """One row: counts of a run; ``failed`` if any model role was silent.  replies(id, correct, grounded, note, select_empty, answer_empty, judge_empty)."""
    rows = scored.join(replies, "id")
    flags = ("select_hit", "bundle_hit", "regime_ok", "version_ok", "product_ok", "correction_ok", "memory_ok", "correct", "grounded", *(f"{r}_empty" for r in ROLES))
    got = rows.agg(F.count("*").alias("n"), *[F.count_if(F.col(c)).alias(c) for c in flags], F.count_if(F.col("note") == "unscored").alias("unscored"))
    return got.withColumn("failed", sum((F.col(f"{r}_empty") for r in ROLES), F.lit(0)) > 0)


def silent_roles(total: DataFrame) -> DataFrame:
    """role and n of the model roles that were silent at least once."""
    return total.select(F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"{r}_empty").alias("n")) for r in ROLES])).alias("x")).select("x.role", "x.n").where("n > 0")


def required_clients(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """(id, client): the clients whose cards a question needs, by the ids that it expects."""
    ids = answers.select("id", F.col("expected").alias("card_id")).unionByName(questions.select("id", F.col("expects_memory").alias("card_id")))
    return ids.select("id", client_of_id("card_id").alias("client")).where("client is not null").distinct()


def exposed_clients(questions: DataFrame, clients: DataFrame) -> DataFrame:
    """id and n: how many served clients(client) are out of a question's scope; all 0 means isolation is not exercised.

    Counts, not pairs: all served ones, less the asking one if it is served.
    """
    n = clients.select("client").distinct().count()
    own = clients.select("client").distinct().withColumn("own", F.lit(1))
    return questions.select("id", "client").join(own, "client", "left").select("id", (F.lit(n) - F.coalesce("own", F.lit(0))).cast("long").alias("n"))
