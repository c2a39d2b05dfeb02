"""Column functions over card ids, slugs, folder segments, threads and model replies.  All JVM-side; null in, null out unless said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwort.functions.text import _c, slug, stripped

# Extensions that pass through unconverted, folders that name no client, spellings of a version.
PASSTHROUGH = ["vm", "xsd", "xml", "json", "txt", "csv", "properties", "sql"]
GENERAL_FOLDERS = "general shared common public global documentation docs documents library resources reference templates".split()
VERSION = r"(?i)^v?(\d{4}(?:\.\d+)*(?:-\w+)?|\d+\.\d+(?:\.\d+)*(?:-\w+)?)$"
# Affixes of sequence names in order, and replies that only acknowledge.
AFFIXES = ("_SEQUENCE$", "_SEQ$", "^SEQUENCE_", "^SEQ_")
ACKNOWLEDGED = r"(?i)^\W*(done|fixed|resolved|closed|ok|thanks|thank you)\W*$"
# Thread limits, and thresholds of a conflict's probability.
MOST_THREAD, BLOCK, REVIEW, MOST_STATUS = 6000, 0.6, 0.3, 140


def client_of_id(card_id: Column | str) -> Column:
    """The client of clients/<client>/...; null for other ids."""
    return F.when(_c(card_id).startswith("clients/"), F.split_part(_c(card_id), F.lit("/"), F.lit(2)))


def product_of_id(card_id: Column | str) -> Column:
    return F.split_part(_c(card_id), F.lit("/"), F.lit(1))


def strip_version(target: Column | str) -> Column:
    return F.substring_index(_c(target), "@", 1)


def is_memory_path(path: Column | str, prefix: str = "clients/") -> Column:
    return _c(path).startswith(prefix) & _c(path).contains("/memory/") & _c(path).endswith(".md")


def collapsed(text: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.regexp_replace(F.regexp_replace(_c(text), r"\s+", " "), "^ | $", "")


def h1_title(text: Column | str) -> Column:
    """The first top heading; empty where there is none."""
    return F.regexp_extract(_c(text), r"(?m)^# (.*)$", 1)


def extension(path: Column | str) -> Column:
    """Lower-case extension of a path's last part; empty without one."""
    return F.lower(F.regexp_extract(_c(path), r"[^/.][^/]*\.([^./]+)$", 1))


def without_extension(path: Column | str) -> Column:
    return F.regexp_replace(_c(path), r"(?<=[^/.])\.[^./]+$", "")


def doc_slug(product: Column | str, path: Column | str) -> Column:
    """Slug of a corpus path with its folders, without the extension."""
    return slug(F.concat_ws(" ", _c(product), without_extension(path)))


def base_slug(product: Column | str, path: Column | str) -> Column:
    """doc_slug; for files that pass through, with the extension at the end."""
    ext = extension(path)
    return F.when(ext.isin(PASSTHROUGH), F.concat(doc_slug(product, path), F.lit("-"), ext)).otherwise(doc_slug(product, path))


def issue_filename(ticket_id: Column | str, title: Column | str) -> Column:
    return F.concat(_c(ticket_id).cast("string"), F.lit("-"), slug(_c(title), 60, "issue"), F.lit(".md"))


def segment(text: Column | str) -> Column:
    return collapsed(F.lower(_c(text)))


def version_of_segment(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(F.trim(_c(text)), VERSION, 1), F.lit(""))


def folder_hints(segments: Column | str, products: dict[str, str], categories: dict[str, str]) -> Column:
    """struct(product, version, category, client) of a path's folders, from left to right.

    A folder feeds one hint at most: the first that is a product, else the first version, else the first category; the
    first that feeds none and is no general folder is the client.
    """
    table = lambda d: F.create_map(*[F.lit(v) for kv in d.items() for v in kv])
    none = F.lit(None).cast("string")
    start = F.struct(*[none.alias(k) for k in ("product", "version", "category", "client")])

    def step(a: Column, s: Column) -> Column:
        # try_: a folder that is no key gives null
        product = F.when(a["product"].isNull(), F.try_element_at(table(products), segment(s)))
        version = F.when(a["version"].isNull() & product.isNull(), version_of_segment(s))
        category = F.when(a["category"].isNull() & product.isNull() & version.isNull(), F.try_element_at(table(categories), segment(s)))
        client = F.when(product.isNull() & version.isNull() & category.isNull() & ~segment(s).isin(GENERAL_FOLDERS), s)
        return F.struct(*[F.coalesce(a[k], v).alias(k) for k, v in (("product", product), ("version", version), ("category", category), ("client", client))])

    return F.aggregate(_c(segments), start, step)


def thread_text(parts: Column | str) -> Column:
    """The parts that are not blank, a blank line between them."""
    return F.array_join(F.filter(_c(parts), lambda p: stripped(p) != ""), "\n\n")


def truncated_thread(text: Column | str, most: int = MOST_THREAD) -> Column:
    """Head and tail of a thread that is longer than ``most``: what a prompt is given."""
    t = _c(text)
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most // 2), F.lit("\n\n[...truncated...]\n\n"), F.substring(t, -(most // 2), most // 2))).otherwise(t)


def known_values(names: Column | str, text: Column | str) -> Column:
    """Names of three characters or more and the e-mail addresses of a text, sorted."""
    from quillwort.functions.text import EMAIL

    trimmed = F.filter(F.transform(_c(names), F.trim), lambda n: F.length(n) >= 3)
    return F.array_sort(F.array_union(trimmed, F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(EMAIL), F.lit(0))))


def strip_think(text: Column | str) -> Column:
    """A reply without its reasoning; what stands in <answer>, if there is one."""
    t = F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"(?s)<think>.*?</think>", "")
    t = F.trim(F.when(t.contains("<think>") & ~t.contains("</think>"), F.substring_index(t, "<think>", 1)).otherwise(t))
    closed = F.regexp_extract(t, r"(?s)<answer>(.*?)</answer>", 1)
    opened = F.replace(F.substring(t, F.instr(t, "<answer>") + 8, F.length(t)), F.lit("</answer>"), F.lit(""))
    return F.trim(F.when(t.rlike(r"(?s)<answer>.*?</answer>"), closed).when(t.contains("<answer>"), opened).otherwise(t))


def json_part(text: Column | str, kind: str = "{}") -> Column:
    """From the first opening to the last closing bracket of the first fenced block that is one bracket, or of the reply; null if that is no JSON."""
    t = F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"(?is)<think>.*?</think>", "")
    fenced = F.regexp_extract(t, r"(?s)```(?:json)?\s*(\{.*?\})\s*```" if kind == "{}" else r"(?s)```(?:json)?\s*(\[.*?\])\s*```", 1)
    t = F.when(fenced != "", fenced).otherwise(t)
    part = F.regexp_extract(t, r"(?s)(\{.*\})" if kind == "{}" else r"(?s)(\[.*\])", 1)
    return F.when((part != "") & F.try_parse_json(part).isNotNull(), part)


def picks(reply: Column | str, candidates: Column, most: int = 2) -> Column:
    """The reply's picks that are candidates, each once, in order."""
    got = F.from_json(F.get_json_object(json_part(reply), "$.picks"), "array<string>")
    return F.slice(F.array_distinct(F.filter(F.coalesce(got, F.array().cast("array<string>")), lambda p: F.array_contains(candidates, p))), 1, most)


def probability(reply: Column | str) -> Column:
    """The reply's probability, a number however written, within 0 and 1; 1 where it gives none or one that is no number."""
    said = F.get_json_object(json_part(reply), "$.probability")
    p = F.when(said == "true", 1.0).when(said == "false", 0.0).otherwise(said.try_cast("double"))
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)), F.lit(1.0))  # NaN is the greatest number here


def conflict_class(p: Column | str) -> Column:
    return F.when(_c(p) >= BLOCK, "block").when(_c(p) >= REVIEW, "review").otherwise("clear")


def confined(links: Column | str) -> Column:
    """The links of the first one's product."""
    return F.filter(_c(links), lambda x: F.split_part(x, F.lit("/"), F.lit(1)) == F.split_part(F.get(_c(links), 0), F.lit("/"), F.lit(1)))


def derived_versions(sources: Column | str) -> Column:
    """Sorted years of references such as open-systems-2023."""
    years = F.flatten(F.transform(_c(sources), lambda s: F.regexp_extract_all(s, F.lit(r"open-systems-(20\d\d)"), F.lit(1))))
    return F.array_sort(F.array_distinct(years))


def prompt_line(card_id: str, title: str, description: str, product: str, regime: str, client: str, versions: str) -> Column:
    """A card's line in the index that a model is shown."""
    some = lambda c, before, after: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(before), F.col(c), F.lit(after))).otherwise("")
    v = F.when(F.size(versions) > 0, F.concat(F.lit("(v"), F.array_join(versions, ","), F.lit(") "))).otherwise("")
    return F.concat(F.lit("- "), F.col(card_id), F.lit(": "), some(client, "<client:", "> "), some(product, "{", "} "), some(regime, "[", "] "), v, F.col(title), F.lit(", "), F.col(description))


def stripped_affix(name: Column | str) -> Column:
    """A sequence's name in capitals, without the first affix that it has, and without underscores at the ends."""
    n = out = F.upper(_c(name))
    for rule in reversed(AFFIXES):
        out = F.when(n.rlike(rule), F.regexp_replace(n, rule, "")).otherwise(out)
    return F.regexp_replace(out, "^_+|_+$", "")


def has_ddl(text: Column | str) -> Column:
    return F.upper(_c(text)).rlike(r"CREATE TABLE|CREATE OR REPLACE")


def missing_keys(present: Column, required: list[str]) -> Column:
    return F.array_except(F.array(*map(F.lit, required)), present)


def replay_since(stored: Column | str, oldest: Column | str, epoch: str = "1970-01-01T00:00:00Z") -> Column:
    """Where a client's tickets are read from again: the oldest unprocessed one, else what is stored, else the epoch."""
    return F.coalesce(F.nullif(_c(oldest), F.lit("")), F.nullif(_c(stored), F.lit("")), F.lit(epoch))
