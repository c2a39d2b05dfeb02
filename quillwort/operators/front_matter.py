"""Cards as text: front matter to typed rows and back, the card index of two trees, files as an inventory.

Front matter is read line by line: top-level keys, block lists, lists of maps, nested maps of one level, flow lists, quoted and plain
scalars, literal (``|``) and folded (``>``) text, comments.  One row a value: id, key, item (place in a list from 0, else null), sub (key within an
item or a nested map, else null), value and kind (str, int, float, bool, null).  A block that is not of this form gives no rows, as does
a text without one; the fence counts on a line of its own only.  Of a repeated key the last counts.  Lines of one
card meet in one task; a card has few.  Null texts give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quillwort.functions.cards import client_of_id
from quillwort.functions.text import _c, front_matter

KEY = r"""^([^\s:#'"\[\]{},&*!|>%@`-][^:]*?)\s*:(?:[ \t]+(.*))?$"""
# Without alternatives in a loop, which would take a stack frame a character.
DOUBLE, SINGLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', r"'[^']*+(?:''[^']*+)*+'"
#: A value that a line can hold: quoted, a flow list, or plain; a comment may follow.
VALUE = rf"""^(?:{DOUBLE}|{SINGLE}|\[[^\]\["']*+(?:(?:{DOUBLE}|{SINGLE})[^\]\["']*+)*+\]|[|>]-?|[^\s"'\[\]{{}}&*!|>%@`].*)?(?:\s+#.*|#.*)?$"""
ENTRY = rf"""{DOUBLE}|{SINGLE}|[^,\s](?:[^,]*[^,\s])?"""
# Plain words that are no strings.
NULLS, TRUE, FALSE = ("", "~", "null", "Null", "NULL"), ("true", "True", "TRUE", "yes", "Yes", "YES", "on", "On", "ON"), ("false", "False", "FALSE", "no", "No", "NO", "off", "Off", "OFF")


def _scalar(raw: Column) -> tuple[Column, Column]:
    """Value and kind of a scalar as written."""
    bare = F.regexp_replace(F.when(raw.rlike(rf"^(?:{DOUBLE}|{SINGLE})"), F.regexp_extract(raw, rf"^({DOUBLE}|{SINGLE})", 1)).otherwise(F.regexp_replace(raw, r"(?:^|\s+)#.*$", "")), r"^\s+|\s+$", "")
    double, single = bare.startswith('"'), bare.startswith("'")
    read = F.get_json_object(F.concat(F.lit('{"v":'), bare, F.lit("}")), "$.v")
    value = F.when(double, read).when(single, F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit("''"), F.lit("'"))).otherwise(F.when(~bare.isin(*NULLS), bare))
    kind = (
        F.when(double | single, "str").when(bare.isin(*NULLS), "null").when(bare.isin(*TRUE, *FALSE), "bool").when(bare.rlike(r"^[-+]?[0-9]+$"), "int").when(bare.rlike(r"^[-+]?(?:[0-9]+\.[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?$"), "float").otherwise("str")
    )
    return value, kind


def fields(cards: DataFrame) -> DataFrame:
    """The values of the front matter of cards(id, text)."""
    lines = cards.select("id", F.posexplode(F.split(front_matter("text"), "\n")).alias("pos", "line")).select("id", "pos", F.regexp_replace("line", r"\s+$", "").alias("line"))
    body = F.regexp_replace("line", r"^ +", "")
    lines = lines.select("id", "pos", "line", body.alias("body"), (F.length("line") - F.length(body)).alias("indent"))
    card = W.partitionBy("id").orderBy("pos")
    top = (F.col("indent") == 0) & F.col("body").rlike(KEY)
    lines = lines.withColumn("key_no", F.count_if(top).over(card))
    # Text under | or > is text, whatever it looks like; of other lines blank ones and comments go.
    head = F.first(F.when(top, F.regexp_replace(F.regexp_extract("body", KEY, 2), r"\s*#.*$", ""))).over(W.partitionBy("id", "key_no").orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    lines = lines.withColumn("head", head).withColumn("told", F.col("head").rlike(r"^[|>]-?$") & ~top & ((F.col("indent") > 0) | (body == "")))
    lines = lines.where(F.col("told") | ~F.col("body").rlike(r"^(#.*)?$")).withColumn("is_item", ~F.col("told") & F.col("body").rlike(r"^-(\s|$)"))
    rest = F.when(F.col("is_item"), F.regexp_replace("body", r"^-\s*", "")).otherwise(F.col("body"))
    group = W.partitionBy("id", "key_no").orderBy("pos")
    lines = lines.withColumn("rest", rest).withColumn("item", F.count_if("is_item").over(group) - 1).withColumn("top", top)
    pair = F.col("rest").rlike(KEY)
    said = F.when(F.col("told"), F.lit("")).when(pair, F.regexp_extract("rest", KEY, 2)).otherwise(F.col("rest"))
    wrong = (F.col("key_no") == 0) | (~F.col("told") & (((F.col("indent") == 0) & ~F.col("top") & ~F.col("is_item")) | (~F.col("is_item") & ~pair) | ~said.rlike(VALUE) | ((F.col("head") != "") & ~F.col("top"))))
    lines = lines.withColumn("said", said).withColumn("pair", pair).withColumn("wrong", F.max(wrong).over(W.partitionBy("id"))).where(~F.col("wrong"))
    name = F.first(F.when(F.col("top"), F.regexp_extract("body", KEY, 1)), ignorenulls=True).over(W.partitionBy("id", "key_no"))
    lines = lines.withColumn("key", name).withColumn("last", F.max("key_no").over(W.partitionBy("id", "key"))).where("key_no = last")
    texts = lines.where("told").groupBy("id", "key", "head").agg(F.array_sort(F.collect_list(F.struct("pos", "indent", "body"))).alias("t"))
    least = F.array_min(F.transform(F.filter("t", lambda x: x["body"] != ""), lambda x: x["indent"]))
    text = F.transform("t", lambda x: F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(0), x["indent"] - least)), x["body"]))
    text = F.regexp_replace(F.call_function("array_join", text, F.when(F.col("head").startswith("|"), "\n").otherwise(" ")), r"[\n ]+\z", "")
    none = F.lit(None).cast("int").alias("item"), F.lit(None).cast("string").alias("sub")
    texts = texts.select("id", "key", *none, F.concat(text, F.when(F.col("head").endswith("-"), "").otherwise("\n")).alias("value"), F.lit("str").alias("kind"))
    rows = lines.where(~F.col("told") & ~(F.col("top") & F.col("said").rlike(r"^[|>]")))
    flow = F.col("said").startswith("[")
    entries = F.regexp_extract_all(F.regexp_replace("said", r"^\[\s*|\s*\]\s*(#.*)?$", ""), F.lit(ENTRY), F.lit(0))
    several = rows.where(flow & F.col("top")).select("id", "key", F.posexplode(entries).alias("item", "raw")).withColumn("sub", F.lit(None).cast("string"))
    # A key with nothing after it heads a list or map if lines follow, else it is null.
    alone = F.count("*").over(W.partitionBy("id", "key_no"))
    ones = rows.withColumn("n", alone).where(~(flow & F.col("top")) & ~(F.col("top") & (F.col("n") > 1)) & ~(F.col("is_item") & (F.col("rest") == "")))
    ones = ones.select("id", "key", F.when(F.col("item") >= 0, F.col("item")).cast("int").alias("item"), F.when(~F.col("top") & F.col("pair"), F.regexp_extract("rest", KEY, 1)).alias("sub"), F.col("said").alias("raw"))
    value, kind = _scalar(F.col("raw"))
    return ones.unionByName(several).select("id", "key", "item", "sub", value.alias("value"), kind.alias("kind")).unionByName(texts)


def quoted(value: Column | str) -> Column:
    """A string as a front matter value: plain where that reads back as the same string, else in double quotes."""
    v = _c(value)
    _, kind = _scalar(v)
    plain = v.rlike(r"^[\p{L}_/][\p{L}\p{N}_./@ -]*\z") & ~v.endswith(" ") & (kind == "str")
    return F.when(plain, v).otherwise(F.substring(F.to_json(F.struct(v.alias("v"))), F.lit(6), F.length(F.to_json(F.struct(v.alias("v")))) - 6))


def stamped(text: Column | str, key: str, value: Column | str) -> Column:
    """The text with ``key`` added to its front matter, if it has one without that key; doing it twice changes nothing."""
    t = _c(text)
    block = front_matter(t)
    lacks = (block != "") & ~block.rlike(rf"(?m)^{key}\s*:")
    return F.when(lacks, F.concat(F.lit("---\n"), block, F.lit(f"\n{key}: "), quoted(value), F.substring(t, F.length(block) + 5, F.length(t)))).otherwise(t)


def listed(of: DataFrame, key: str) -> DataFrame:
    """id and values of ``key``, a scalar counted as a list of one; null or empty: no row."""
    return of.where((F.col("key") == key) & F.col("sub").isNull() & F.col("value").isNotNull()).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("item", "value"))), lambda x: x["value"]).alias(key))


def card_files(spark: SparkSession, root: str) -> DataFrame:
    """path (below ``root``) and text of the Markdown files of a tree.  Spark lists folders in parallel and passes over those that begin with . or _, and over empty files."""
    read = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.md").load(root)
    return read.select(below(F.col("path"), root).alias("path"), F.col("content").cast("string").alias("text"))


def below(path: Column, root: str) -> Column:
    """A file's path below ``root``, however the file system spells the root's scheme."""
    return F.substring_index(path, root.rstrip("/").split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/", -1)


def card_index(files: DataFrame) -> DataFrame:
    """The cards of files(path, text): card_id, title, description, regime, type, version, product, client, corrects and status.

    Index and log pages and objects of the database tier (a folder ``db``) are no cards; below ``clients/`` only those in a
    client's memory and issues folders are, and their kind is the folder's.
    """
    path = F.col("path")
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    client = path.startswith("clients/")
    inside = F.when(client, F.get(parts, 2).isin("memory", "issues") & (F.size(parts) > 3)).otherwise(~F.array_contains(F.slice(parts, 1, F.size(parts) - 1), "db"))
    kept = files.where(path.endswith(".md") & ~name.isin("index.md", "log.md") & inside).select(F.regexp_replace(path, r"\.md$", "").alias("id"), "text")
    wanted = ("title", "description", "regime", "type", "version", "product", "corrects", "status")
    of = fields(kept).where(F.col("item").isNull() & F.col("sub").isNull() & F.col("key").isin(*wanted))
    got = of.groupBy("id").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in wanted])
    folder = F.split_part("id", F.lit("/"), F.lit(3))
    kind = F.when(F.col("id").startswith("clients/"), F.when(folder == "memory", "memory").otherwise("issue")).otherwise(F.coalesce("type", F.lit("concept")))
    return kept.select("id").join(got, "id", "left").select(
        F.col("id").alias("card_id"), F.coalesce("title", F.when(F.col("id").startswith("clients/"), F.expr("substring(id, 9)")).otherwise(F.col("id"))).alias("title"), F.coalesce("description", F.lit("")).alias("description"),
        "regime", kind.alias("type"), "version", "product", client_of_id(F.col("id")).alias("client"), "corrects", "status",
    )


def file_inventory(spark: SparkSession, root: str, extensions: tuple[str, ...] | None = None) -> DataFrame:
    """path, name, ext, size, modified, depth and segments of the files of a tree but for empty ones; their contents are not read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    rows = read.select(below(F.col("path"), root).alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    ext = F.lower(F.regexp_extract(name, r"^.+(\.[^.]*)$", 1))
    out = rows.select("path", name.alias("name"), ext.alias("ext"), "size", "modified", (F.size(parts) - 1).alias("depth"), F.slice(parts, 1, F.size(parts) - 1).alias("segments"))
    return out.where(F.col("ext").isin(*extensions)) if extensions else out


def upserts(cards: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """card_id, text and outcome of cards(card_id, text) against stored(card_id, text): written, unchanged, or preserved (the stored one is approved).

    A card keeps the place of one stored for the same key whatever its slug: callers name cards by key.  Only ``written`` rows need to be stored.
    """
    old = stored.select("card_id", F.col("text").alias("old"))
    approved = F.col("old").contains("status: approved") & F.lit(not force)
    outcome = F.when(F.coalesce(approved, F.lit(False)), "preserved").when(F.col("old").eqNullSafe(F.col("text")) & F.col("old").isNotNull(), "unchanged").otherwise("written")
    return cards.join(old, "card_id", "left").select("card_id", F.when(outcome == "preserved", F.col("old")).otherwise(F.col("text")).alias("text"), outcome.alias("outcome"))
