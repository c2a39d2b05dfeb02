"""Joins over parsed schema objects of two dialects: tables, columns, keys, sequences and stored units.

All inputs are DataFrames of narrow rows.  What is gathered in one row (columns, keys or sources of one object) is
bounded by the object, never by the table; hot names are reduced by partial aggregates.  Empty inputs give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.functions.cards import collapsed, stripped_affix


def _listed(value: str, *order: str) -> Column:
    """Values of one object, sorted by ``order``."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*order, value))), lambda x: x[value])


def tiered_units(product: DataFrame, seed: DataFrame, product_names: DataFrame) -> DataFrame:
    """Units of the product tier, and those seed units whose name no product unit of either dialect has (``product_names``(name))."""
    return product.unionByName(seed.join(product_names.select("name").distinct(), "name", "left_anti").select(*product.columns))


def reconciled_units(oracle: DataFrame, db2: DataFrame) -> DataFrame:
    """name, platform, body_oracle and body_db2 of (name, body) of two dialects, a row a name each.

    A DB2 body that equals the Oracle one but for whitespace becomes empty.  Null bodies count as empty.
    """
    side = lambda d, k: d.select("name", F.coalesce("body", F.lit("")).alias(f"body_{k}"), F.lit(k).alias(f"is_{k}"))
    both = side(oracle, "oracle").join(side(db2, "db2"), "name", "full_outer")
    same = collapsed("body_oracle") == collapsed("body_db2")
    return both.select("name", F.concat_ws(",", "is_oracle", "is_db2").alias("platform"), F.coalesce("body_oracle", F.lit("")).alias("body_oracle"), F.when(same, "").otherwise(F.coalesce("body_db2", F.lit(""))).alias("body_db2"))


def repeated_units(units: DataFrame) -> DataFrame:
    """name, n and verdict of the names that units(name, kind, is_body, body) of one dialect use more than once.

    A package of at most one specification and one body is no repetition.
    """
    norm = collapsed(F.coalesce("body", F.lit("")))
    g = units.groupBy("name").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce(F.col("kind") != "package", F.lit(True))).alias("others"), F.count_if("is_body").alias("bodies"), F.min(norm).alias("least"), F.max(norm).alias("most")
    )
    pair = (F.col("others") == 0) & (F.col("bodies") <= 1) & (F.col("n") - F.col("bodies") <= 1)
    return g.where((F.col("n") > 1) & ~pair).select("name", "n", F.when(F.col("least") == F.col("most"), "identical").otherwise("differs in body").alias("verdict"))


def table_structures(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """tab and structure, a digest that columns(tab, name, type_oracle, type_db2, not_null) and keys(tab, col) give in any order."""
    null = F.lit("")
    c = columns.groupBy("tab").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws("|", "name", F.coalesce("type_oracle", null), F.coalesce("type_db2", null), F.col("not_null").cast("string")))), ",").alias("c"))
    k = keys.groupBy("tab").agg(F.array_join(F.sort_array(F.collect_set("col")), ",").alias("k"))
    return c.join(k, "tab", "left").select("tab", F.sha2(F.concat_ws(";", "c", F.coalesce("k", null)).cast("binary"), 256).alias("structure"))


def key_links(fks: DataFrame, product: str) -> DataFrame:
    """tab and related, the ids of the tables that fks(tab, pos, ref_table) name: each once, by first mention."""
    once = fks.groupBy("tab", "ref_table").agg(F.min("pos").alias("pos"))
    return once.groupBy("tab").agg(F.transform(_listed("ref_table", "pos"), lambda t: F.concat(F.lit(f"{product}/db/tables/"), t)).alias("related"))


def united_sources(sources: DataFrame) -> DataFrame:
    """name and paths of sources(name, dialect, pos, path): each path once, the least dialect first, then by place."""
    once = sources.groupBy("name", "path").agg(F.min(F.struct("dialect", "pos")).alias("at"))
    return once.groupBy("name").agg(_listed("path", "at").alias("paths"))


def sequence_owners(sequences: DataFrame, tables: DataFrame) -> DataFrame:
    """name and owner of every sequence(name), given tables(tab, pos).

    The stem is the name without affixes.  Owner: the table of that name; else the longest table that the stem continues
    after an underscore or that starts with the stem, the least pos of equals; else null.  Each prefix of a table name keeps
    its best table, so a stem meets one row a prefix, and no pairs are made.
    """
    t = tables.select("tab", F.upper("tab").alias("u"), "pos")
    best = F.max_by("tab", F.struct(F.length("u").alias("n"), (-F.col("pos")).alias("p")))
    rank = F.max(F.struct(F.length("u").alias("n"), (-F.col("pos")).alias("p")))
    # "=X" serves the stem X of tables that start with X; ">X_" serves stems that go on after the table name X.
    starts = t.where("u <> ''").withColumn("key", F.explode(F.transform(F.sequence(F.lit(1), F.length("u")), lambda n: F.concat(F.lit("="), F.substring("u", F.lit(1), n)))))
    whole = t.where("u <> ''").withColumn("key", F.concat(F.lit(">"), "u", F.lit("_")))
    keyed = starts.unionByName(whole).groupBy("key").agg(best.alias("tab"), rank.alias("rank"))
    exact = t.groupBy("u").agg(F.min_by("tab", "pos").alias("exact"))
    s = sequences.select("name").distinct().withColumn("stem", F.upper(stripped_affix("name")))
    cuts = F.filter(F.sequence(F.lit(1), F.length("stem")), lambda n: F.substring("stem", n, F.lit(1)) == "_")
    keys = F.concat(F.array(F.concat(F.lit("="), "stem")), F.transform(cuts, lambda n: F.concat(F.lit(">"), F.substring("stem", F.lit(1), n))))
    near = s.where("stem <> ''").select("name", F.explode(keys).alias("key")).join(keyed, "key").groupBy("name").agg(F.max_by("tab", "rank").alias("near"))
    return s.join(exact, s["stem"] == exact["u"], "left").join(near, "name", "left").select("name", F.coalesce("exact", "near").alias("owner"))


def tally(rows: DataFrame, by: str) -> DataFrame:
    """How many rows have each value of a column (topic, tier, number of versions)."""
    return rows.groupBy(by).agg(F.count("*").alias("n"))


def run_totals(outcomes: DataFrame, fetched: int) -> DataFrame:
    """One row: how many outcomes(outcome) are of each kind, and whether they add up to what was fetched."""
    kinds = ("emitted", "skipped", "preserved", "cached", "held", "failed")
    counts = [F.count_if(F.coalesce(F.col("outcome") == k, F.lit(False))).alias(k) for k in kinds]
    return outcomes.agg(*counts).select(F.lit(fetched).cast("long").alias("fetched"), *kinds, (sum((F.col(k) for k in kinds), F.lit(0)) == fetched).alias("balanced"))
