"""A training-data pipeline over ``documents``: every stage takes all rows that the stage before it kept.

toxicity -> near-dedup -> substring dedup -> benchmark decontamination -> mixing.  All stages but the last return
the columns of documents.  A text that substring dedup empties stays as an empty text: no stage drops a clean document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import shared_dir, table
from quillwort.llm.decontamination import decontaminate
from quillwort.llm.mixing import mix
from quillwort.llm.near_dedup import near_dedup
from quillwort.llm.substring_dedup import substring_dedup
from quillwort.llm.toxicity import THRESHOLD, scored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; each row is judged by its own text."""
    return scored(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where(F.col("score") < THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (the least id, null last) of each component of near copies: operator 8 on 5-word shingles, verified at Jaccard 0.8."""
    return near_dedup(docs.select(*COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that start earlier in the corpus; n_chars follows the text."""
    cut = substring_dedup(docs, carry=("text", "lang", "source"))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mixed),
]

#: The toxicity model cannot be written in SQL; tests/llm runs the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet in the shared folder and read again."""
    docs, to = table(spark, sf_dir, "documents"), shared_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{to}/{k}")
        docs = spark.read.parquet(f"{to}/{k}")
    return docs
