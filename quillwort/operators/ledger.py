"""The work ledger as append-only logs, folded by time: no updates in place, refused operations are simply not in force.

An operation counts only if its owner is the one who opened the row, as every read and write is owner scoped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What an objective's mode and status, an entry's kind and a memory's visibility may be.
MODES = ("investigate", "implement", "learn")
STATUSES = ("open", "active", "resolved", "done")
KINDS = ("plan", "step", "finding", "decision", "quiz_result", "note")
VISIBILITIES = ("private", "promotion_requested")


def refused(log: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose value is not one of the allowed ones: what an enum check refuses."""
    return log.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def refusals(log: DataFrame) -> DataFrame:
    """seq, field and value of the operations log(seq, op, value) whose value is not allowed: mode of an opening, status, kind of an entry, visibility."""
    rules = (("open", "mode", MODES), ("status", "status", STATUSES), ("entry", "kind", KINDS), ("visibility", "visibility", VISIBILITIES))
    field, ok = F.lit(None).cast("string"), F.lit(True)
    for op, name, allowed in rules:
        field = F.when(F.col("op") == op, name).otherwise(field)
        ok = F.when(F.col("op") == op, F.coalesce(F.col("value").isin(*allowed), F.lit(False))).otherwise(ok)
    return log.where(~ok).select("seq", field.alias("field"), "value")


def opened(log: DataFrame, key: str) -> DataFrame:
    """key, owner and opened_at of each row of the ledger: its first ``open`` operation in seq order."""
    first = log.where("op = 'open'").groupBy(key).agg(F.min(F.struct("seq", "owner")).alias("f"))
    return first.select(key, F.col("f.owner").alias("owner"), F.col("f.seq").alias("opened_at"))


def owned(log: DataFrame, key: str) -> DataFrame:
    """The operations in force: by the owner, from the opening on."""
    return log.join(opened(log, key), [key, "owner"]).where(F.col("seq") >= F.col("opened_at"))


def objectives(log: DataFrame) -> DataFrame:
    """log(seq, op, objective_id, owner, status): open, status and entry operations folded to (objective_id, owner, status, n_entries, updated_at)."""
    rows = owned(log, "objective_id")
    got = rows.groupBy("objective_id", "owner").agg(F.max_by("status", F.when(F.col("op") == "status", F.col("seq"))).alias("status"), F.count_if(F.col("op") == "entry").alias("n_entries"), F.max("seq").alias("updated_at"))
    return got.withColumn("status", F.coalesce("status", F.lit("open")))


def list_objectives(log: DataFrame, owner: int, status: str | None = None) -> DataFrame:
    rows = objectives(log).where(F.col("owner") == owner)
    return (rows.where(F.col("status") == status) if status else rows).orderBy(F.desc("updated_at"), "objective_id")


def entry_log(log: DataFrame) -> DataFrame:
    """objective_id, place, seq and kind of every entry in force, in order of seq."""
    from pyspark.sql import Window as W

    rows = owned(log, "objective_id").where("op = 'entry'")
    return rows.select("objective_id", F.row_number().over(W.partitionBy("objective_id").orderBy("seq")).alias("place"), "seq", "kind")


def memories(log: DataFrame) -> DataFrame:
    """log(seq, op, memory_id, owner, text, tags, card_ids, client, visibility) folded to the memories that are not forgotten.

    ``open`` writes a memory, ``forget`` deletes it for good, ``visibility`` changes who may see it.
    """
    rows = owned(log, "memory_id")
    at = lambda op: F.when(F.col("op") == op, F.col("seq"))
    got = rows.groupBy("memory_id", "owner").agg(
        *[F.min_by(c, at("open")).alias(c) for c in ("text", "tags", "card_ids", "client")], F.max_by("visibility", at("visibility")).alias("visibility"),
        F.max(F.when(F.col("op") != "forget", F.col("seq"))).alias("updated_at"), F.count_if(F.col("op") == "forget").alias("gone"),
    )
    return got.where("gone = 0").drop("gone").withColumn("visibility", F.coalesce("visibility", F.lit("private")))


def recall(held: DataFrame, owner: int, needle: str | None = None, tags: list[str] | None = None, card_id: str | None = None, client: str | None = None, limit: int = 20) -> DataFrame:
    """An owner's newest memories: of a client, on a card, with all tags, whose text or tags contain the needle."""
    rows = held.where(F.col("owner") == owner)
    if client is not None:
        rows = rows.where(F.col("client") == client)
    if card_id is not None:
        rows = rows.where(F.array_contains("card_ids", card_id))
    if tags:
        rows = rows.where(F.size(F.array_except(F.array(*map(F.lit, tags)), "tags")) == 0)
    if needle:
        has = lambda x: F.contains(F.lower(x), F.lit(needle.lower()))
        rows = rows.where(has(F.col("text")) | F.exists("tags", has))
    return rows.orderBy(F.desc("updated_at"), "memory_id").limit(limit)


def promotable(held: DataFrame) -> DataFrame:
    """The neutral record of every memory that may be promoted: it has a client, and promotion was not asked for yet."""
    ok = held.where("client is not null and client <> '' and visibility = 'private'")
    return ok.select("memory_id", "client", F.col("text").alias("memory"), F.col("card_ids").alias("related"), "tags", F.col("owner").alias("submitted_by"), F.lit("approved").alias("status"))
