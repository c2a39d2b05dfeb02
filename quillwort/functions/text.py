"""Column functions over text: tokens, slugs, personal-data scrubbing, boilerplate.  All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a search leaves out.
SEARCH_STOPWORDS = (
    "a an and are as at be but by can do does for from how i if in is it its of on or that the their them then there these they this to was what when where "
    "which who why will with"
).split()
# Words that a link does not count.
LINK_STOPWORDS = (
    "the and for with was were are not this that from has have had but all any can could would should did does when which into onto out its their there then "
    "than them they been being you your our his her card issue ticket error please request problem user system data one two new old via per"
).split()
# What stands in for scrubbed personal data.
EMAIL_TOKEN, ID_TOKEN, PHONE_TOKEN, NAME_TOKEN = "[email]", "[id]", " [phone]", "[name]"
# Patterns of personal data.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?<!\d)(?:\+\d[\d\s\-]{6,}\d|\(?\d{2,4}\)?[\s\-]\d{3}[\s\-]?\d{2,4})(?!\d)"
THIRTEEN = r"(?<!\d)\d{13}(?!\d)"
# Boilerplate rules in order; each match is deleted.
BOILERPLATE = (r"(?m)^\s*Page \d+ of \d+\s*$", r"(?mi)^\s*(©|\(c\)|Copyright).*\d{4}.*$", r"(?mi)^.*All Rights Reserved.*$", r"(?m)^\.{3,}\d+$")


#: White space of Unicode, the separators of ASCII included, for a bracket of a pattern.
BLANK = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
STRIP = rf"^[{BLANK}]+|[{BLANK}]+\z"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def stripped(text: Column | str) -> Column:
    """Without white space of any kind at the ends; ``trim`` takes blanks only."""
    return F.regexp_replace(_c(text), STRIP, "")


def runs(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits; null gives none."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def search_tokens(text: Column | str) -> Column:
    """Runs without stopwords."""
    return F.filter(runs(text), lambda t: ~t.isin(SEARCH_STOPWORDS))


def link_tokens(text: Column | str, stopwords: list[str] | None = None) -> Column:
    """ASCII words of over two characters without stopwords, then plural s folded, for linking entries to cards."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    kept = F.filter(runs, lambda t: (F.length(t) > 2) & ~t.isin(LINK_STOPWORDS + (stopwords or [])))
    return F.array_distinct(F.transform(kept, lambda t: F.when((F.length(t) > 4) & t.endswith("s") & ~t.endswith("ss"), t.substr(F.lit(1), F.length(t) - 1)).otherwise(t)))


def slug(text: Column | str, most: int | None = None, default: str | None = None) -> Column:
    """Kebab case; cut to ``most`` characters without a hyphen at the end; ``default`` where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(_c(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    if most:
        s = F.regexp_replace(s.substr(1, most), "-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default)) if default else s


def luhn(digits: Column) -> Column:
    """Whether a string of 13 digits has a right check digit."""
    d = F.transform(F.sequence(F.lit(1), F.lit(13)), lambda i: F.when(i % 2 == 1, digits.substr(i, F.lit(1)).cast("int")).otherwise((digits.substr(i, F.lit(1)).cast("int") * 2) % 10 + F.floor(digits.substr(i, F.lit(1)).cast("int") * 2 / 10).cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10 == 0


def national_id(digits: Column) -> Column:
    month, day = digits.substr(3, 2).cast("int"), digits.substr(5, 2).cast("int")
    return month.between(1, 12) & day.between(1, 31) & luhn(digits)


def scrub(text: Column | str, known: Column | None = None) -> Column:
    """Known values (longest first), e-mail addresses, valid 13-digit ids and phone numbers replaced by tokens."""
    t = _c(text)
    if known is not None:
        longest = F.array_sort(known, lambda a, b: F.length(b) - F.length(a))
        t = F.aggregate(longest, t, lambda acc, k: F.replace(acc, k, F.lit(NAME_TOKEN)))
    t = F.regexp_replace(t, EMAIL, EMAIL_TOKEN)
    ids = F.filter(F.array_distinct(F.regexp_extract_all(t, F.lit(THIRTEEN), F.lit(0))), national_id)
    t = F.aggregate(ids, t, lambda acc, k: F.regexp_replace(acc, F.concat(F.lit(r"(?<!\d)"), k, F.lit(r"(?!\d)")), F.lit(ID_TOKEN)))
    return F.regexp_replace(t, PHONE, PHONE_TOKEN)


def leak_kinds(text: Column | str) -> Column:
    """Sorted kinds of personal data in a text; never the values."""
    t = _c(text)
    has_id = F.exists(F.regexp_extract_all(t, F.lit(THIRTEEN), F.lit(0)), national_id)
    return F.array_compact(F.array(F.when(t.rlike(EMAIL), "email"), F.when(has_id, "id"), F.when(t.rlike(PHONE), "phone")))


def strip_boilerplate(text: Column | str) -> Column:
    t = _c(text)
    for rule in BOILERPLATE:
        t = F.regexp_replace(t, rule, "")
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def clean_markdown(text: Column | str) -> Column:
    """Without inline images, dot leaders and runs of blank lines."""
    t = F.regexp_replace(_c(text), r"!\[[^\]]*\]\(data:[^)]*\)", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\.{4,}", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def front_matter(text: Column | str) -> Column:
    """The block between an opening and a closing line of three hyphens; empty where there is none."""
    return F.regexp_extract(_c(text), r"\A(?s)---\n(.*?)\n---\n", 1)


def tier(avg_chars: Column, image_share: Column) -> Column:
    """text from 100 characters a page; else vision if half of the pages are images; else text."""
    return F.when(avg_chars >= 100, "text").when(image_share >= 0.5, "vision").otherwise("text")
