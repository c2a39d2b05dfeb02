"""Schema scripts as rows: tokens, statements, table columns, statements that attach to tables, stored units.

A script is text with ``--`` and ``/* */`` comments, ``'`` strings and ``"`` identifiers, any of which may hold ``;``.  What a line
means depends on whether an earlier line left a string or comment open, so every line is first taken as a function from
that *state* to the next (four states, a byte).  Functions of ``BLOCK`` lines are composed, then those of ``BLOCK`` blocks, and so on; the states come
back down the same way.  A script of any length is thus read in parallel, in rows of ``BLOCK`` lines, and no task holds
a whole one.  A short script (up to ``BLOCK`` lines) takes no shuffle for this.

``statements_of``, ``stored_units_of`` and ``unrecognized_units_of`` take the scripts themselves.  Scripts up to ``WHOLE`` characters are
read in their own row: patterns that step over strings and comments cut them, and nothing is exchanged.  Longer ones go through ``tokens``.

The others work on ``tokens``: script_id, block, line, pos, start (characters before it in the script), raw, kind (word, number,
quoted, string, comment, space, other), statement (how many ``;`` stand before it) and ``continued`` (the rest of a string or comment that an earlier line began).
Null scripts are empty; repeated script_ids are the caller's to rule out.  Empty inputs give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLOCK = 256
#: How often blocks are grouped before the rest is folded at once: BLOCK ** (LEVELS + 1) lines make one step of the last fold.
LEVELS = 2
#: What is open before a line: nothing, a string, an identifier, a comment.
OPENERS = ("", "'", '"', "/*")
TOKEN = r"""--[^\n]*|/\*(?s:.*?)(?:\*/|\z)|'[^']*(?:'|\z)|"[^"]*(?:"|\z)|[\p{L}_][\p{L}\p{N}_$#]*|\p{N}+|[\x09-\x0D\x20]+|(?s:.)"""
SAME = 0b11100100  # every state to itself
AHEAD = 12
#: Characters up to which a script is read in its own row.
WHOLE = 1 << 20
#: An array grows by copies, so sums over arrays are taken in parts of so many items.
PART = 64
# Modifiers of a view, kinds that are stored units, kinds that are known and passed over, and what ends a header.
VIEW_MODIFIERS = ("FORCE", "NO", "EDITIONABLE", "NONEDITIONABLE")
UNIT_KINDS = ("PACKAGE", "PROCEDURE", "FUNCTION", "TRIGGER", "VIEW")
OTHER_KINDS = ("VARIABLE", "TYPE", "SEQUENCE", "SYNONYM", "ALIAS", "NICKNAME")
HEADER_ENDS = ("AS", "IS", "BEGIN")
CONSTRAINT_WORDS = ("CONSTRAINT", "PRIMARY", "UNIQUE", "FOREIGN", "CHECK")
ATTACHING = ("COMMENT", "ALTER", "CREATE")
#: What TOKEN takes as comments and space, as strings and identifiers, and as a token of its own after any of the former; possessive, so that long texts take no stack.
_COMMENT = r"--[^\n]*+|/\*(?:[^*]++|\*(?!/))*+(?:\*/|\z)"
_GAP = _COMMENT + r"|[\x09-\x0D\x20]++"
_QUOTED = r"""'[^']*+(?:'|\z)|"[^"]*+(?:"|\z)"""
_LATER = r"[\p{L}\p{N}_$#]"
_OWN = _QUOTED + rf"|[\p{{L}}_]{_LATER}*+|\p{{N}}++|[^;]"
#: A statement with its ``;``.  What stands before its first token, and then its text to the last one.
_STATEMENT = rf"""(?:{_COMMENT}|{_QUOTED}|[^;'"/\-]++|[/\-])*+(?:;|\z)"""
_BEFORE = rf"\A(?:{_GAP})*+"
_TEXT = rf"\A(?:(?:{_GAP})*+(?:{_OWN}))*+"
_EACH = rf"(?:{_GAP})*+({_OWN})"
_ON = rf"(?:{_GAP}|;)*+"
_EACH_ON = rf"{_ON}({_OWN})"
_LINE_GAP = r"[\x09\x0B-\x0D\x20]*+"


def _split(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _left_open(text: Column) -> Column:
    """The state after a line that begins in code."""
    last = F.try_element_at(_split(text), F.lit(-1))
    open_ = lambda mark, end, least: last.startswith(mark) & ((F.length(last) < least) | ~last.endswith(end))
    return F.when(open_("'", "'", 2), 1).when(open_('"', '"', 2), 2).when(open_("/*", "*/", 4), 3).otherwise(0)


def _step(line: Column) -> Column:
    every = sum((F.shiftleft(_left_open(F.concat(F.lit(o), line)), 2 * s) for s, o in enumerate(OPENERS)), F.lit(0))
    return F.when(line.rlike(r"""['"]|/\*|\*/"""), every).otherwise(SAME)


def _after(step: Column, state: Column) -> Column:
    return F.call_function("shiftright", step, 2 * state).bitwiseAND(F.lit(3))


def _then(first: Column, second: Column) -> Column:
    return sum((F.shiftleft(_after(second, _after(first, F.lit(s))), 2 * s) for s in range(4)), F.lit(0))


def _entry(state: Column, start: Column) -> Column:
    return F.struct(state.cast("int").alias("state"), start.cast("long").alias("start"))


def _begin() -> Column:
    return _entry(F.lit(0), F.lit(0))


def _entries(steps: Column, first: Column) -> Column:
    """The (state, start) before each of steps(step, n), and after the last, given that before the first."""
    def add(seen: Column, x: Column) -> Column:
        last = F.element_at(seen, -1)
        return F.concat(seen, F.array(_entry(_after(x["step"], last["state"]), last["start"] + x["n"])))

    return F.aggregate(steps, F.array(first), add)


def _total(steps: Column) -> tuple[Column, Column]:
    return F.aggregate(steps, F.lit(SAME), lambda f, x: _then(f, x["step"])), F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x["n"])


def _before(parts: DataFrame, level: int) -> DataFrame:
    """script_id, at and entry of parts(script_id, at, step, n): what holds before each part of a script."""
    up = F.floor(F.col("at") / BLOCK) if level else F.lit(0)
    groups = parts.groupBy("script_id", up.cast("long").alias("up")).agg(F.array_sort(F.collect_list(F.struct("at", "step", "n"))).alias("steps"))
    if level:
        step, n = _total(F.col("steps"))
        groups = groups.join(_before(groups.select("script_id", F.col("up").alias("at"), step.alias("step"), n.alias("n")), level - 1).withColumnRenamed("at", "up"), ["script_id", "up"])
    else:
        groups = groups.withColumn("entry", _begin())
    each = groups.select("script_id", F.explode(F.arrays_zip(F.col("steps.at").alias("at"), F.slice(_entries(F.col("steps"), F.col("entry")), 1, F.size("steps")).alias("entry"))).alias("e"))
    return each.select("script_id", "e.at", "e.entry")


def blocks_of(scripts: DataFrame) -> DataFrame:
    """script_id, block, last (the script's last block) and the lines of each block of scripts(script_id, sql)."""
    all_ = scripts.select("script_id", F.split(F.coalesce("sql", F.lit("")), "\n", -1).alias("all"))
    last = F.floor((F.size("all") - 1) / BLOCK).cast("int")
    return all_.select("script_id", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("block"), "all").select(
        "script_id", F.col("block").cast("long").alias("block"), F.col("last").cast("long").alias("last"), F.slice("all", F.col("block") * BLOCK + 1, BLOCK).alias("lines")
    )


def blocks_of_lines(lines: DataFrame) -> DataFrame:
    """The same from lines(script_id, line, text), numbered from 0: for scripts too long for one row."""
    last = lines.groupBy("script_id").agg(F.floor(F.max("line") / BLOCK).alias("last"))
    block = F.floor(F.col("line") / BLOCK)
    grouped = lines.groupBy("script_id", block.alias("block")).agg(F.transform(F.array_sort(F.collect_list(F.struct("line", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]).alias("lines"))
    return grouped.join(last, "script_id").select("script_id", "block", "last", "lines")


def _running(df: DataFrame, value: Column, *order: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over a script's earlier rows; blocks first, then within a block."""
    totals = df.groupBy("script_id", "block").agg(F.sum(value).alias("_t"))
    earlier = W.partitionBy("script_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select("script_id", "block", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_base"))
    inner = W.partitionBy("script_id", "block").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0))).join(base, ["script_id", "block"]).withColumn("before", F.col("_base") + F.col("_in")).drop("_in", "_base")


def tokens(blocks: DataFrame) -> DataFrame:
    """All tokens of ``blocks``; see the module's text."""
    stepped = blocks.withColumn("steps", F.transform("lines", lambda x: F.struct(_step(x).alias("step"), (F.length(x) + 1).cast("long").alias("n"))))
    step, n = _total(F.col("steps"))
    long_ = stepped.where("last > 0")
    entry = _before(long_.select("script_id", F.col("block").alias("at"), step.alias("step"), n.alias("n")), LEVELS).withColumnRenamed("at", "block")
    entered = stepped.where("last = 0").withColumn("entry", _begin()).unionByName(long_.join(entry, ["script_id", "block"]))
    zipped = F.arrays_zip(F.col("lines").alias("text"), F.slice(_entries(F.col("steps"), F.col("entry")), 1, F.size("lines")).alias("entry"))
    lines = entered.select("script_id", "block", F.posexplode(zipped).alias("at", "x")).select(
        "script_id", "block", (F.col("block") * BLOCK + F.col("at")).alias("line"), F.col("x.entry.state").alias("state"), F.col("x.entry.start").alias("line_start"), F.col("x.text").alias("text")
    )
    opener = F.element_at(F.array(*map(F.lit, OPENERS)), F.col("state") + 1)
    cut = lines.select("script_id", "block", "line", "state", "line_start", F.length(opener).alias("hidden"), _split(F.concat(opener, "text")).alias("all"))
    numbered = _running(cut.withColumn("ends", F.size(F.filter("all", lambda t: t == ";"))), F.col("ends"), "line").drop("ends")
    each = numbered.select("script_id", "block", "line", "state", "line_start", "hidden", "before", F.posexplode("all").alias("pos", "whole"))
    first = F.col("pos") == 0
    raw = F.when(first, F.expr("substring(whole, hidden + 1)")).otherwise(F.col("whole"))
    w = W.partitionBy("script_id", "line").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("line_start") + F.coalesce(F.sum(F.length("raw")).over(w), F.lit(0))
    kind = (
        F.when(F.col("whole").startswith("--") | F.col("whole").startswith("/*"), "comment").when(F.col("whole").startswith("'"), "string").when(F.col("whole").startswith('"'), "quoted")
        .when(F.col("whole").rlike(r"^[\x09-\x0D\x20]"), "space").when(F.col("whole").rlike(r"^[\p{L}_]"), "word").when(F.col("whole").rlike(r"^\p{N}"), "number").otherwise("other")
    )
    return each.withColumn("raw", raw).select(
        "script_id", "block", "line", "pos", start.alias("start"), "raw", kind.alias("kind"),
        (F.col("before") + F.count(F.when(F.col("whole") == ";", 1)).over(w)).cast("long").alias("statement"), (first & (F.col("state") > 0)).alias("continued"),
    )


def _tells() -> Column:
    return ~F.col("kind").isin("space", "comment") & ~((F.col("raw") == ";") & (F.col("kind") == "other"))


def _own() -> Column:
    """Tokens but for space, comments and the ``;`` themselves, each once."""
    return _tells() & ~F.col("continued")


def statements(of: DataFrame) -> DataFrame:
    """script_id, statement, start, text (verbatim, from the first to the last token) and n_tokens of every statement that has a token."""
    told = F.when(_tells(), F.col("start"))
    g = of.groupBy("script_id", "statement").agg(
        F.min(told).alias("first"), F.max(told + F.length("raw")).alias("end"), F.count_if(_own()).alias("n_tokens"), F.array_sort(F.collect_list(F.struct("line", "pos", "raw", "start"))).alias("p"),
    )
    newlines = lambda x, i: F.when(i > 0, F.call_function("repeat", F.lit("\n"), (x["line"] - F.get("p", i - 1)["line"]).cast("int"))).otherwise("")
    text = F.array_join(F.transform("p", lambda x, i: F.concat(newlines(x, i), x["raw"])), "")
    whole = g.where("first is not null").withColumn("text", text)
    return whole.select("script_id", "statement", F.col("first").alias("start"), F.substring("text", (F.col("first") - F.element_at("p", 1)["start"] + 1).cast("int"), (F.col("end") - F.col("first")).cast("int")).alias("text"), "n_tokens")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _sums(values: Column) -> Column:
    """The sum of the items before each item."""
    def run(items: Column, first: Column) -> Column:
        return F.slice(F.aggregate(items, F.array(first), lambda seen, x: F.concat(seen, F.array(F.element_at(seen, -1) + x))), 1, F.size(items))

    def summed(of: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(of) - 1) / PART).cast("int"))), lambda k: F.slice(of, k * PART + 1, PART))
        none = F.lit(0).cast("long")
        return _let(parts, lambda p: F.flatten(F.zip_with(p, run(F.transform(p, lambda x: F.aggregate(x, none, lambda a, b: a + b)), none), run)))

    return _let(F.transform(values, lambda x: x.cast("long")), summed)


def _word(word: str) -> str:
    """A pattern of what ``upper`` turns into ``word``."""
    return "".join({"I": r"[Ii\x{131}]", "S": r"[Ss\x{17F}]"}.get(c, f"[{c}{c.lower()}]") for c in word)


def _begins(words: tuple[str, ...], after: str) -> str:
    return rf"{after}(?:{'|'.join(map(_word, words))})(?!{_LATER})"


def _by_length(scripts: DataFrame, checkpoint, short: Callable[[DataFrame], DataFrame], long_: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``short`` of the scripts that are read in their own rows and ``long_`` of the others."""
    in_row = F.length(F.coalesce("sql", F.lit(""))) <= WHOLE
    rest = checkpoint(scripts.where(~in_row))
    got = short(scripts.where(in_row))
    return got if rest.isEmpty() else got.unionByName(long_(rest))


def statements_of(scripts: DataFrame, checkpoint, first: tuple[str, ...] = ()) -> DataFrame:
    """``statements`` of scripts(script_id, sql); of those only that begin with one of the words ``first``, if there are any."""
    wanted = lambda text: text.rlike(_begins(first, r"\A")) if first else F.lit(True)

    def short(of: DataFrame) -> DataFrame:
        parts = F.regexp_extract_all(F.coalesce("sql", F.lit("")), F.lit(_STATEMENT), F.lit(0))
        placed = _let(parts, lambda p: F.arrays_zip(p.alias("part"), _sums(F.transform(p, F.length)).alias("at"), F.sequence(F.lit(0).cast("long"), F.size(p).cast("long")).alias("no")))
        bare = F.transform(placed, lambda x: _let(F.length(F.regexp_extract(x["part"], _BEFORE, 0)), lambda n: F.struct(x["no"].alias("statement"), (x["at"] + n).alias("start"), F.substring(x["part"], n + 1, F.length(x["part"])).alias("text"))))
        told = F.transform(F.filter(bare, lambda x: wanted(x["text"])), lambda x: F.struct(x["statement"], x["start"], F.regexp_extract(x["text"], _TEXT, 0).alias("text")))
        each = of.select("script_id", F.explode(F.filter(told, lambda x: x["text"] != "")).alias("s"))
        return each.select("script_id", "s.statement", "s.start", "s.text", F.regexp_count("s.text", F.lit(_EACH)).cast("long").alias("n_tokens"))

    return _by_length(scripts, checkpoint, short, lambda rest: statements(checkpoint(tokens(blocks_of(rest)))).where(wanted(F.col("text"))))


def unquoted(name: Column) -> Column:
    return F.when(name.startswith('"'), F.regexp_replace(name, '^"|"$', "")).otherwise(name)


def _upper(of: DataFrame) -> DataFrame:
    return of.where(_own()).withColumn("u", F.when(F.col("kind") == "word", F.upper("raw")).otherwise(F.col("raw")))


def _capital(raw: Column) -> Column:
    return F.when(raw.rlike(r"\A[\p{L}_]"), F.upper(raw)).otherwise(raw)


def _read(text: Column, each: str) -> Column:
    """Own tokens of a text: raw, and u, words in capitals."""
    return F.transform(F.regexp_extract_all(text, F.lit(each), F.lit(1)), lambda x: F.struct(x.alias("raw"), _capital(x).alias("u")))


def _said(of: DataFrame, first: tuple[str, ...], read: Callable[[Column], Column]) -> DataFrame:
    """script_id, statement and what ``read`` makes of its own tokens, s, of the statements of ``of`` (or of its tokens) that begin with a word of ``first``; none if that is null."""
    each = of if "text" in of.columns else statements(of)
    each = each.where(F.col("text").rlike(_begins(first, r"\A")))
    return each.select("script_id", "statement", F.explode(F.filter(F.transform(F.array(_read(F.col("text"), _EACH)), read), lambda s: s.isNotNull())).alias("s"))


def _columns(d: Column) -> Column:
    """The columns that a statement of tokens ``d`` gives its table; null if it makes none."""
    u = lambda k: F.get(d, k)["u"]
    lead = F.when(u(0) == "CREATE", F.when(u(1) == "TABLE", 2).when((u(1) == "GLOBAL") & (u(2) == "TEMPORARY") & (u(3) == "TABLE"), 4))
    step = F.transform(d, lambda x: F.when(x["u"] == "(", 1).when(x["u"] == ")", -1).otherwise(0))
    deep = _let(step, lambda s: F.zip_with(F.zip_with(_sums(s), s, lambda a, b: a + b), d, lambda depth, x: F.struct(x["raw"].alias("raw"), x["u"].alias("u"), depth.alias("depth"))))

    def upto_close(t: Column) -> Column:
        close = F.array_position(F.transform(t, lambda x: (x["u"] == ")") & (x["depth"] == 0)), True).cast("int")
        return F.slice(t, 1, F.when(close > 0, close).otherwise(F.size(t)))

    def defs(t: Column) -> Column:
        """The definitions between the commas of the first bracket: place, u, raw and depth of their tokens."""
        comma = F.transform(t, lambda x: ((x["u"] == ",") & (x["depth"] == 1)).cast("int"))
        numbered = _let(comma, lambda c: F.zip_with(t, F.zip_with(_sums(c), c, lambda a, b: a + b), lambda x, k: F.struct(k.alias("place"), x["raw"].alias("raw"), x["u"].alias("u"), x["depth"].alias("depth"))))
        inside = F.filter(numbered, lambda x: (x["depth"] >= 1) & ~((x["depth"] == 1) & x["u"].isin("(", ",")))
        return _let(inside, lambda i: F.transform(F.array_distinct(F.transform(i, lambda x: x["place"])), lambda k: F.filter(i, lambda x: x["place"] == k)))

    us = lambda c: F.transform(c, lambda x: x["u"])
    follows = lambda c, a, b: F.exists(F.arrays_zip(us(c).alias("a"), F.slice(us(c), 2, F.size(c)).alias("b")), lambda x: F.coalesce((x["a"] == a) & (x["b"] == b), F.lit(False)))
    is_column = lambda c: ~F.get(c, 0)["u"].isin(*CONSTRAINT_WORDS)

    def listed(c: Column) -> Column:
        using = F.array_position(us(c), "USING").cast("int")
        key = F.slice(c, 1, F.when(using > 0, using).otherwise(F.size(c)))
        return F.transform(F.filter(key, lambda x: (x["depth"] == 2) & ~x["u"].isin("(", ")", ",")), lambda x: unquoted(x["raw"]))

    def row(c: Column, keys: Column, table_name: Column) -> Column:
        w = lambda k: F.get(c, k)["u"]
        close = F.array_position(us(c), ")").cast("int")
        args = F.when((w(2) == "(") & (close > 0), F.array_join(F.slice(us(c), 3, F.greatest(F.lit(0), close - 2)), "")).otherwise("")
        type_ = F.when(w(1) == "LONG", F.when(w(2) == "RAW", "BLOB").otherwise("CLOB")).otherwise(F.concat(F.coalesce(w(1), F.lit("")), args))
        name = unquoted(F.get(c, 0)["raw"])
        pk = follows(c, "PRIMARY", "KEY") | F.array_contains(keys, name)
        return F.struct(table_name.alias("table_name"), F.get(c, 0)["place"].alias("place"), name.alias("name"), type_.alias("type"), follows(c, "NOT", "NULL").alias("not_null"), pk.alias("pk"))

    def made(t: Column) -> Column:
        table_name = unquoted(F.try_element_at(F.filter(t, lambda x, i: (x["depth"] == 0) & (x["u"] != ")") & (i >= lead)), F.lit(-1))["raw"])
        keys = lambda e: F.array_distinct(F.flatten(F.transform(F.filter(e, lambda c: ~is_column(c) & follows(c, "PRIMARY", "KEY")), listed)))
        rows = _let(defs(t), lambda e: _let(keys(e), lambda k: _let(table_name, lambda n: F.transform(F.filter(e, is_column), lambda c: row(c, k, n)))))
        return F.when(~F.exists(t, lambda x: (x["depth"] == 0) & x["u"].isin("AS", "SELECT")) & table_name.isNotNull(), rows)

    return F.when(lead.isNotNull(), _let(deep, lambda t: _let(upto_close(t), made)))


def table_columns(of: DataFrame) -> DataFrame:
    """script_id, statement, table_name, place, name, type, not_null and pk of the columns of every CREATE TABLE of statements, or of tokens.

    The column list is the first bracket; what follows it (storage, tablespaces) and state words after a constraint say nothing
    about columns.  A table made from a query has no row.  LONG RAW is BLOB, LONG is CLOB.
    """
    return _said(of, ("CREATE",), _columns).select("script_id", "statement", F.explode("s").alias("c")).select("script_id", "statement", "c.*")


def _attachment(d: Column) -> Column:
    """kind, table_name, name and value of what a statement of tokens ``d`` says of a table; null if it says nothing."""
    u, raw = d["u"], d["raw"]
    at = lambda word: F.array_position(u, word).cast("int")
    none = F.array().cast("array<string>")

    def names(start: Column) -> Column:
        """The parts of the dotted name from place ``start`` (from 1) on."""
        more = lambda k: F.get(u, start + 2 * k - 2) == "."
        part = lambda k: F.array(unquoted(F.get(raw, start + 2 * k - 1)))
        return F.concat(part(0), F.when(more(1), F.concat(part(1), F.when(more(2), part(2)).otherwise(none))).otherwise(none))

    def bracket(start: Column) -> Column:
        """Comma-separated first words in the bracket that opens at or after place ``start``."""
        def inner(rest: Column) -> Column:
            opens, closes = (F.array_position(rest["u"], c).cast("int") for c in "()")
            return F.slice(rest, opens + 1, F.greatest(F.lit(0), closes - opens - 1))

        firsts = lambda e: F.transform(F.filter(e, lambda x, i: (i == 0) | (F.get(e, i - 1)["u"] == ",")), lambda x: unquoted(x["raw"]))
        return _let(F.slice(d, start, F.size(d)), lambda rest: _let(inner(rest), firsts))

    def spoken(rest: Column) -> Column:
        """A string, which a doubled quote divides into several."""
        other = F.array_position(F.transform(rest, lambda x: x.startswith("'")), False).cast("int")
        whole = F.array_join(F.slice(rest, 1, F.when(other > 1, other - 1).when(other == 1, 1).otherwise(F.size(rest))), "")
        return F.replace(F.substring(whole, F.lit(2), F.greatest(F.lit(0), F.length(whole) - 2)), F.lit("''"), F.lit("'"))

    word, last = (lambda k: F.get(u, k)), (lambda parts: F.element_at(parts, -1))
    is_at, foreign, refers, on = (at(w) for w in ("IS", "FOREIGN", "REFERENCES", "ON"))
    target = names(F.lit(4))
    comment = (word(0) == "COMMENT") & (word(1) == "ON") & (is_at > 0) & (is_at < F.size(d))
    unique = word(1) == "UNIQUE"
    index = F.when(unique, 4).otherwise(3)
    key = (word(0) == "ALTER") & (word(1) == "TABLE") & (foreign > 0) & (refers > foreign)
    indexed = (word(0) == "CREATE") & ((word(1) == "INDEX") | (unique & (word(2) == "INDEX"))) & (on > 0)
    value = F.when(comment, _let(F.slice(raw, is_at + 1, F.size(d)), spoken))
    pairs = _let(bracket(foreign), lambda own: F.array_join(F.zip_with(own, F.slice(bracket(refers), 1, F.size(own)), lambda a, b: F.concat(a, F.lit("="), b)), ","))
    columns = F.concat(F.when(unique, "unique ").otherwise(""), F.array_join(bracket(on), ","))
    said = lambda kind, table_name, name, v: F.struct(F.lit(kind).alias("kind"), table_name.alias("table_name"), name.alias("name"), v.alias("value"))
    return (
        F.when(comment & (word(2) == "TABLE"), said("comment", last(target), F.lit(None).cast("string"), value))
        .when(comment & (word(2) == "COLUMN") & (F.size(target) > 1), said("column comment", F.get(target, F.size(target) - 2), last(target), value))
        .when(key, said("key", last(names(F.lit(3))), last(names(refers + 1)), pairs)).when(indexed, said("index", last(names(on + 1)), last(names(index)), columns))
    )


def attachments(of: DataFrame) -> DataFrame:
    """What statements say of tables: script_id, statement, kind (comment, column comment, key, index), table_name, name and value.

    ``of``: statements, or tokens.  comment: value is the text; column comment: name is the column; key: name is the referred table, value the
    column pairs in order; index: name and columns, ``unique`` first if it is.
    """
    return _said(of, ATTACHING, _attachment).select("script_id", "statement", "s.*")


def attaching(of: DataFrame, checkpoint, value: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """``attachments`` with ``value`` of their values, and table_name and name of ``table_columns``, of the same statements, which are read once."""
    both = _said(of, ATTACHING, lambda d: _let(F.struct(_attachment(d).alias("found"), _columns(d).alias("columns")), lambda b: F.when(b["found"].isNotNull() | b["columns"].isNotNull(), b)))
    names = F.transform("s.columns", lambda c: F.struct(c["table_name"], c["name"]))
    read = checkpoint(both.select("script_id", "statement", F.col("s.found").withField("value", value(F.col("s.found.value"))).alias("found"), names.alias("columns")))
    return read.where("found is not null").select("script_id", "statement", "found.*"), read.select(F.explode("columns").alias("c")).select("c.*")


def attached(found: DataFrame, columns: DataFrame) -> DataFrame:
    """kind, table_name, name and value of what is in force: the last comment of a table or column, every key and index in order (``place`` from 1).

    A key or index is in force as often as it is stated.  Only tables, and for column comments columns, of ``columns`` count.
    """
    known = found.join(columns.select("table_name").distinct(), "table_name", "left_semi")
    column = columns.select("table_name", "name").distinct()
    said = known.where("kind = 'comment'").unionByName(known.where("kind = 'column comment'").join(column, ["table_name", "name"], "left_semi").select(*known.columns))
    at = F.struct("script_id", "statement")
    last = said.groupBy("kind", "table_name", "name").agg(F.max_by("value", at).alias("value")).withColumn("place", F.lit(1))
    listed = known.where("kind in ('key', 'index')")
    place = F.row_number().over(W.partitionBy("kind", "table_name").orderBy("script_id", "statement"))
    return last.unionByName(listed.select("kind", "table_name", "name", "value", place.alias("place")))


def unattached(found: DataFrame, columns: DataFrame) -> DataFrame:
    """script_id, statement, kind, table_name and name of what refers to a table or column that no script makes."""
    tables, column = columns.select("table_name").distinct(), columns.select("table_name", "name").distinct()
    lost = found.join(tables, "table_name", "left_anti").select("script_id", "statement", "kind", "table_name", "name")
    half = found.where("kind = 'column comment'").join(tables, "table_name", "left_semi").join(column, ["table_name", "name"], "left_anti")
    return lost.unionByName(half.select(*lost.columns))


def _unit(tokens: Column) -> Column:
    """replaced, word (null if it is of no known kind), kind (null, too, if no name follows) and name of the CREATE before ``tokens``, the ``AHEAD`` ones that follow."""
    def parsed(replaced: Column, b: Column) -> Column:
        word = F.get(b, 0)["u"]
        body = F.coalesce(word.isin("PACKAGE", "TYPE") & (F.get(b, 1)["u"] == "BODY"), F.lit(False))
        kind = F.when(word.isin(*UNIT_KINDS, *OTHER_KINDS), F.concat(F.lower(word), F.when(body & (word == "TYPE"), " body").otherwise("")))
        at = F.when(body, 2).otherwise(1)
        part = lambda k: unquoted(F.get(b, at + 2 * k)["raw"])
        dot = lambda k: F.get(b, at + 2 * k - 1)["u"] == "."
        name = F.concat(part(0), F.when(dot(1), F.concat(F.lit("."), part(1), F.when(dot(2), F.concat(F.lit("."), part(2))).otherwise(""))).otherwise(""))
        return F.struct(replaced.alias("replaced"), kind.alias("word"), F.when(F.get(b, at).isNotNull(), kind).alias("kind"), name.alias("name"))

    def read(a: Column) -> Column:
        replaced = (F.coalesce(F.get(a, 0)["u"], F.lit("")) == "OR") & (F.coalesce(F.get(a, 1)["u"], F.lit("")) == "REPLACE")
        rest = lambda r: F.filter(F.when(r, F.slice(a, 3, AHEAD)).otherwise(a), lambda x, i: (i > 2) | ~x["u"].isin(*VIEW_MODIFIERS))
        return _let(replaced, lambda r: _let(rest(r), lambda b: parsed(r, b)))

    return _let(tokens, read)


def _creates(of: DataFrame) -> DataFrame:
    """script_id, start, and what ``_unit`` says of every CREATE of tokens."""
    t = _upper(of)
    n = _running(t, F.lit(1).cast("long"), "start").withColumnRenamed("before", "n").select("script_id", "n", "start", "raw", "u")
    made = n.where("u = 'CREATE'").select("script_id", F.col("start").alias("made"), "n")
    wanted = made.select("script_id", "made", F.explode(F.transform(F.sequence(F.lit(1), F.lit(AHEAD)), lambda k: F.col("n") + k)).alias("n"))
    ahead = wanted.join(n, ["script_id", "n"]).groupBy("script_id", "made").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "raw", "u"))), lambda x: F.struct(x["raw"].alias("raw"), x["u"].alias("u"))).alias("a"))
    none = F.array().cast("array<struct<raw:string,u:string>>")
    return made.join(ahead, ["script_id", "made"], "left").select("script_id", F.col("made").alias("start"), _unit(F.coalesce("a", none)).alias("c")).select("script_id", "start", "c.*")


def _marks(sql: Column) -> Column:
    """What bounds units in a script, in order: mark (create, header or slash, one that stands alone on its line), its place and, of a create, ``_unit``."""
    create, headers, alone = _word("CREATE"), "|".join(map(_word, HEADER_ENDS)), rf"{_LINE_GAP}/{_LINE_GAP}(?:\n|\z)"
    skipped = rf"(?!(?:{create}|{headers})(?!{_LATER}))[\p{{L}}_]{_LATER}*+|[\x09\x0B-\x0D\x20]++|\n(?!{alone})|\p{{N}}++|{_COMMENT}|{_QUOTED}|[^\n\p{{L}}_]"
    pattern = F.lit(rf"(?:{skipped})*+(?:({create}(?=((?:{_ON}(?:{_OWN})){{0,{AHEAD}}}+))|{headers}|\n{_LINE_GAP}/)|\z)")
    found = lambda text: _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda parts: F.arrays_zip(_sums(F.transform(parts, lambda x, i: F.length(x) + F.when(i == 0, -1).otherwise(0))).alias("at"), parts.alias("part"), F.regexp_extract_all(text, pattern, F.lit(1)).alias("mark"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("ahead")))

    def placed(x: Column) -> Column:
        """The line break put before the script is not counted: the sum before the first part is 0, where it is 1 to the left."""
        slash = x["mark"].endswith("/")
        end = x["at"] + F.length(x["part"]) - F.when(x["at"] == 0, 1).otherwise(0)
        mark = F.when(slash, "slash").when(F.length(x["mark"]) == 6, "create").otherwise("header")
        return F.struct(mark.alias("mark"), (end - F.when(slash, 1).otherwise(F.length(x["mark"]))).alias("start"), F.when(F.length(x["mark"]) == 6, _unit(_read(x["ahead"], _EACH_ON))).alias("unit"))

    return _let(F.concat(F.lit("\n"), sql), lambda text: F.transform(F.filter(found(text), lambda x: x["mark"] != ""), placed))


def _bounded(marks: Column, length: Column) -> Column:
    """start, kind, name, head (where the signature ends) and end of the units among ``marks``, from the last mark to the first."""
    place, none = F.lit(None).cast("long"), F.array().cast("array<struct<start:bigint,kind:string,name:string,head:bigint,end:bigint>>")
    state = lambda nxt, slash, header, units: F.struct(nxt.alias("next"), slash.alias("slash"), header.alias("header"), units.alias("units"))

    def unit(s: Column, x: Column) -> Column:
        bound = F.coalesce(s["next"], length)
        end = F.when(s["slash"] < bound, s["slash"]).otherwise(bound)
        head = F.when(s["header"] < end, s["header"]).otherwise(end)
        return F.struct(x["start"].alias("start"), x["unit"]["kind"].alias("kind"), x["unit"]["name"].alias("name"), head.alias("head"), end.alias("end"))

    def step(s: Column, x: Column) -> Column:
        units = F.when(x["unit"]["kind"].isin(*[k.lower() for k in UNIT_KINDS]), F.concat(s["units"], F.array(unit(s, x)))).otherwise(s["units"])
        return (
            F.when(x["mark"] == "slash", state(s["next"], x["start"], s["header"], s["units"])).when(x["mark"] == "header", state(s["next"], s["slash"], x["start"], s["units"]))
            .when(x["unit"]["kind"].isNotNull(), state(x["start"], s["slash"], s["header"], units)).otherwise(s)
        )

    return F.aggregate(F.reverse(marks), state(place, place, place, none), step, lambda s: s["units"])


def _cut(sql: Column, start: Column, to: Column) -> Column:
    return F.substring(sql, (start + 1).cast("int"), (to - start).cast("int"))


def _signature(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$", "")


def stored_units_of(scripts: DataFrame, checkpoint) -> DataFrame:
    """``stored_units`` of scripts(script_id, sql)."""
    def short(of: DataFrame) -> DataFrame:
        sql, at = F.coalesce("sql", F.lit("")), lambda c: F.col(f"x.{c}")
        each = of.select("script_id", sql.alias("sql"), F.explode(_let(sql, lambda s: _bounded(_marks(s), F.length(s).cast("long")))).alias("x"))
        return each.select("script_id", "x.start", "x.kind", "x.name", _signature(_cut(F.col("sql"), at("start"), at("head"))).alias("signature"), _cut(F.col("sql"), at("start"), at("end")).alias("body"))

    return _by_length(scripts, checkpoint, short, lambda rest: stored_units(checkpoint(tokens(blocks_of(rest))), rest))


def unrecognized_units_of(scripts: DataFrame, checkpoint) -> DataFrame:
    """``unrecognized_units`` of scripts(script_id, sql)."""
    def short(of: DataFrame) -> DataFrame:
        unknown = F.filter(_marks(F.coalesce("sql", F.lit(""))), lambda x: (x["mark"] == "create") & x["unit"]["replaced"] & x["unit"]["word"].isNull())
        return of.select("script_id", F.explode(F.transform(unknown, lambda x: x["start"])).alias("start"))

    return _by_length(scripts, checkpoint, short, lambda rest: unrecognized_units(checkpoint(tokens(blocks_of(rest)))))


def stored_units(of: DataFrame, scripts: DataFrame) -> DataFrame:
    """script_id, start, kind, name, signature and body (verbatim) of the packages, procedures, functions, triggers and views of scripts.

    A unit goes to the next ``/`` that stands alone on its line, or else to the next unit, or to the end; its signature to
    AS, IS or BEGIN.  Known kinds that are no units (types, sequences, synonyms) end a unit and have no row.
    """
    creates = _creates(of).where("kind is not null")
    by_line = W.partitionBy("script_id", "line")
    # A comment beside the slash, or a string that goes on, means that it does not stand alone.
    alone = of.withColumn("others", F.count_if((F.col("kind") != "space") & (F.length("raw") > 0)).over(by_line)).where("raw = '/' and kind = 'other' and others = 1")
    marks = creates.select("script_id", "start", F.lit("unit").alias("mark"), "kind", "name")
    none = [F.lit(None).cast("string").alias(c) for c in ("kind", "name")]
    marks = marks.unionByName(alone.select("script_id", "start", F.lit("slash").alias("mark"), *none))
    marks = marks.unionByName(_upper(of).where(F.col("u").isin(*HEADER_ENDS)).select("script_id", "start", F.lit("header").alias("mark"), *none))
    later = W.partitionBy("script_id").orderBy("start").rowsBetween(1, W.unboundedFollowing)
    nxt = lambda mark: F.first(F.when(F.col("mark") == mark, F.col("start")), ignorenulls=True).over(later)
    units = marks.withColumn("slash", nxt("slash")).withColumn("next", nxt("unit")).withColumn("header", nxt("header")).where(F.col("mark") == "unit")
    units = units.where(F.col("kind").isin(*[k.lower() for k in UNIT_KINDS])).join(scripts.select("script_id", "sql"), "script_id")
    bound = F.coalesce("next", F.length("sql").cast("long"))
    units = units.withColumn("end", F.when(F.col("slash") < bound, F.col("slash")).otherwise(bound))
    header = F.when((F.col("header") < F.col("end")), F.col("header")).otherwise(F.col("end"))
    cut = lambda to: _cut(F.col("sql"), F.col("start"), to)
    return units.select("script_id", "start", "kind", "name", _signature(cut(header)).alias("signature"), cut(F.col("end")).alias("body"))


def unrecognized_units(of: DataFrame) -> DataFrame:
    """script_id and start of every CREATE OR REPLACE of an unknown kind: meant as a unit, read as none."""
    return _creates(of).where(F.col("replaced") & F.col("word").isNull()).select("script_id", "start")
