"""Checks of plans, atomic documents and cards; every check gives rows (key, finding), so a clean input gives none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.functions.cards import strip_version


def _found(df: DataFrame, key: str, finding: str, where: Column | None = None) -> DataFrame:
    return (df if where is None else df.where(where)).select(F.col(key).cast("string").alias("key"), F.lit(finding).alias("finding"))


def _known(c: str, values: list[str]) -> Column:
    return F.coalesce(F.col(c).isin(values), F.lit(False))


def plan_findings(include: DataFrame, exclude: DataFrame, groups: DataFrame, files: DataFrame, platforms: list[str], products: list[str], doc_types: list[str]) -> DataFrame:
    """include(path, platform, product, doc_type), exclude(path), groups(keep, drop) a row each dropped file, files(path)."""
    there = files.select("path").distinct()
    blank = F.trim(F.coalesce("product", F.lit(""))) == ""
    parts = [
        _found(include.select("path").intersect(exclude.select("path")), "path", "included and excluded"),
        _found(include.join(there, "path", "left_anti"), "path", "include path missing"),
        _found(include, "path", "no product", blank),
        _found(include, "path", "invalid doc_type", ~_known("doc_type", doc_types)),
        _found(groups, "keep", "kept and dropped", F.col("keep") == F.col("drop")),
        _found(groups.select(F.col("keep").alias("path")).distinct().where("path <> ''").join(there, "path", "left_anti"), "path", "kept path missing"),
        _found(groups.select(F.col("drop").alias("path")).where("path <> ''").join(there, "path", "left_anti"), "path", "dropped path missing"),
    ]
    if platforms:
        parts.append(_found(include, "path", "invalid platform", ~_known("platform", platforms)))
    if products:
        parts.append(_found(include, "path", "invalid product", ~blank & ~F.trim("product").isin(products)))
    return reduce(DataFrame.unionByName, parts)


def first_of_slug(docs: DataFrame) -> DataFrame:
    """The documents that keep their slug: the least name of each."""
    first = docs.where("slug is not null and slug <> ''").groupBy("slug").agg(F.min("name").alias("name"))
    return docs.join(first, ["slug", "name"], "left_semi")


def atomic_findings(docs: DataFrame, related: DataFrame, doc_types: list[str], statuses: list[str], required: tuple[str, ...] = ("platform", "product", "version")) -> DataFrame:
    """docs(name, slug, doc_type, status, ...required), related(slug, target).  Of documents with one slug the first by name is judged further."""
    no_slug = F.coalesce("slug", F.lit("")) == ""
    kept = first_of_slug(docs)
    parts = [
        _found(docs, "name", "missing slug", no_slug),
        _found(docs.where(~no_slug).join(kept.select("name"), "name", "left_anti"), "name", "duplicate slug"),
        _found(kept, "name", "invalid doc_type", ~_known("doc_type", doc_types)),
        _found(kept, "name", "invalid status", ~F.coalesce("status", F.lit("active")).isin(statuses)),
        *[_found(kept, "name", f"missing {c}", F.coalesce(F.col(c).cast("string"), F.lit("")) == "") for c in required],
        _found(related.join(kept.select("slug"), "slug", "left_semi").withColumn("bare", strip_version("target")).join(kept.select(F.col("slug").alias("bare")), "bare", "left_anti"), "slug", "dangling related"),
    ]
    return reduce(DataFrame.unionByName, parts)


def relations(docs: DataFrame, related: DataFrame, supersedes: DataFrame) -> DataFrame:
    """(src, dst, kind): related edges between known documents, and all supersedes edges."""
    kept = first_of_slug(docs).select("slug")
    known = related.join(kept, "slug", "left_semi").withColumn("bare", strip_version("target")).join(kept.withColumnRenamed("slug", "bare"), "bare", "left_semi")
    old = supersedes.join(kept, "slug", "left_semi")
    row = lambda df, kind: df.select(F.col("slug").alias("src"), F.col("target").alias("dst"), F.lit(kind).alias("kind"))
    return row(known, "related").unionByName(row(old, "supersedes"))


def promotions(drafts: DataFrame, known: DataFrame, related: DataFrame, required: list[str]) -> DataFrame:
    """drafts(card_id, status, keys): promoted, skipped (not approved, or there already) or invalid, with what is missing.

    A draft is invalid without a required key or with a related(card_id, dst) that is neither known nor a draft.
    """
    ids = known.select("card_id").unionByName(drafts.select("card_id")).distinct()
    bad = related.join(ids.select(F.col("card_id").alias("dst")), "dst", "left_anti").groupBy("card_id").agg(F.count("*").alias("n_unknown"))
    there = known.select("card_id").distinct().withColumn("there", F.lit(True))
    rows = drafts.join(bad, "card_id", "left").join(there, "card_id", "left").withColumn("missing", F.array_except(F.array(*map(F.lit, required)), "keys"))
    outcome = F.when(~F.col("status").eqNullSafe(F.lit("approved")) | F.col("there").isNotNull(), "skipped").when((F.size("missing") > 0) | (F.coalesce("n_unknown", F.lit(0)) > 0), "invalid").otherwise("promoted")
    return rows.select("card_id", outcome.alias("outcome"), F.array_join("missing", ",").alias("missing"), F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"))
