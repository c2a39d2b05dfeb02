"""Schema scripts: statements against a slow reader of whole texts, long scripts in blocks, columns, attachments, stored units."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillwort.operators import scripts as S

SAMPLE = """-- a; comment ' here
CREATE TABLE app."Doc" (
  id NUMBER(9,0) NOT NULL ENABLE, -- key; of (
  note VARCHAR2(30) DEFAULT 'a;b(''
 still; ' NOT NULL,
  raw_1 LONG RAW, old LONG,
  CONSTRAINT pk PRIMARY KEY (id, note) USING INDEX TABLESPACE t
) TABLESPACE big STORAGE (INITIAL 64K);
/* block ;
 ' over ; lines
*/ COMMENT ON TABLE app."Doc" IS 'it''s;
two lines';;
COMMENT ON COLUMN app."Doc".note IS 'n';
COMMENT ON COLUMN app."Doc".nope IS 'n';
COMMENT ON TABLE other IS 'n';
ALTER TABLE app."Doc" ADD CONSTRAINT fk FOREIGN KEY (id, note) REFERENCES x.Other (a, "b") ENABLE;
CREATE UNIQUE INDEX ix ON app."Doc" (id DESC, note);
CREATE TABLE t2 AS SELECT (1) FROM dual;
CREATE GLOBAL TEMPORARY TABLE t3 (k INTEGER PRIMARY KEY, "M N" DATE);
CREATE OR REPLACE PROCEDURE app.p (x IN NUMBER) AS
BEGIN
  y := x
  / 2; z := 'CREATE VIEW v;
/
';
END;
  /
CREATE FORCE VIEW v AS SELECT 1 FROM dual;
CREATE OR REPLACE PROCEEDURE oops AS BEGIN NULL; END;
/
CREATE OR REPLACE TYPE t_x AS OBJECT (a NUMBER);
CREATE OR REPLACE PACKAGE BODY "P" IS x; END;
"""
TOKEN = re.compile(r"""--[^\n]*|/\*(?s:.*?)(?:\*/|\Z)|'[^']*(?:'|\Z)|"[^"]*(?:"|\Z)|[^\W\d][\w$#]*|\d+|[\x09-\x0D\x20]+|(?s:.)""")


def slow_statements(sql):
    out, no, tokens = [], 0, []
    for m in [*TOKEN.finditer(sql), None]:
        if m is None or m[0] == ";":
            if tokens:
                out.append((no, tokens[0].start(), sql[tokens[0].start() : tokens[-1].end()], len(tokens)))
            no, tokens = no + 1, []
        elif not re.match(r"--|/\*|[\x09-\x0D\x20]", m[0]):
            tokens.append(m)
    return out


def tokens(spark, *scripts):
    df = spark.createDataFrame(list(enumerate(scripts)), "script_id int, sql string")
    return S.tokens(S.blocks_of(df)).persist(), df


def statements(t):
    return sorted(map(tuple, S.statements(t).collect()))


@pytest.mark.parametrize("block", [256, 3])
def test_statements_equal_a_slow_reader(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(block)
    pieces = ["'", '"', "/*", "*/", "--", ";", "\n", "a", " ", "/", "*", "-", "é", "\r", "''"]
    texts = [SAMPLE, None, "", ";", "'open; \n;", "select 1", "a;b/*/;c"] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(400)] + ["".join(rng.choice(pieces) for _ in range(9000))]
    t, _ = tokens(spark, *texts)
    assert statements(t) == sorted((k, *s) for k, x in enumerate(texts) for s in slow_statements(x or ""))
    assert "".join(r["raw"] for r in t.where("script_id = 0").orderBy("line", "pos").collect()) == SAMPLE.replace("\n", "")


def test_long_script_is_read_from_its_lines(spark):
    lines = spark.range(60_000).select(F.lit(7).alias("script_id"), F.col("id").alias("line"), F.element_at(F.array(*map(F.lit, ("x := 'a;", "b'; /* ;", "*/ y; --'"))), (F.col("id") % 3 + 1).cast("int")).alias("text"))
    got = S.statements(S.tokens(S.blocks_of_lines(lines)))
    # x := 'a;\nb' and y, 20,000 times each.
    assert got.groupBy("text").count().orderBy("text").collect() == [("x := 'a;\nb'", 20_000), ("y", 20_000)]
    assert got.agg(F.max("start"), F.max("statement")).first() == ((8 + 1 + 8 + 1 + 9 + 1) * 19_999 + 18 + 3, 39_999)


def test_columns_of_tables(spark):
    t, _ = tokens(spark, SAMPLE)
    got = sorted(tuple(r)[2:] for r in S.table_columns(t).collect())
    assert got == [
        ("Doc", 0, "id", "NUMBER(9,0)", True, True), ("Doc", 1, "note", "VARCHAR2(30)", True, True), ("Doc", 2, "raw_1", "BLOB", False, False), ("Doc", 3, "old", "CLOB", False, False),
        ("t3", 0, "k", "INTEGER", False, True), ("t3", 1, "M N", "DATE", False, False),
    ]


def test_attachments_in_order_and_leftovers(spark):
    t, _ = tokens(spark, SAMPLE, 'COMMENT ON TABLE "Doc" IS \'later\'; CREATE INDEX i2 ON "Doc" (old); ALTER TABLE nowhere ADD FOREIGN KEY (a) REFERENCES b (c)')
    found, columns = S.attachments(t), S.table_columns(t)
    got = sorted((tuple(r) for r in S.attached(found, columns).select("kind", "table_name", "name", "value", "place").collect()), key=str)
    assert got == [
        ("column comment", "Doc", "note", "n", 1), ("comment", "Doc", None, "later", 1), ("index", "Doc", "i2", "old", 2), ("index", "Doc", "ix", "unique id,note", 1), ("key", "Doc", "Other", "id=a,note=b", 1),
    ]
    lost = {(r["kind"], r["table_name"]) for r in S.unattached(found, columns).collect()}
    assert lost == {("column comment", "Doc"), ("comment", "other"), ("key", "nowhere")}
    said = {r["value"] for r in found.where("kind = 'comment'").collect()}
    assert said == {"it's;\ntwo lines", "n", "later"}


def test_stored_units_are_verbatim(spark):
    t, df = tokens(spark, SAMPLE, None)
    got = [tuple(r)[2:] for r in S.stored_units(t, df).orderBy("start").collect()]
    cut = lambda a, b: SAMPLE[SAMPLE.index(a) : SAMPLE.index(b)]
    assert got == [
        ("procedure", "app.p", "CREATE OR REPLACE PROCEDURE app.p (x IN NUMBER)", cut("CREATE OR REPLACE PROCEDURE app.p", "/\nCREATE FORCE")),
        ("view", "v", "CREATE FORCE VIEW v", cut("CREATE FORCE", "/\nCREATE OR REPLACE TYPE")),
        ("package", "P", 'CREATE OR REPLACE PACKAGE BODY "P"', SAMPLE[SAMPLE.index("CREATE OR REPLACE PACKAGE") :]),
    ]
    assert [r["start"] for r in S.unrecognized_units(t).collect()] == [SAMPLE.index("CREATE OR REPLACE PROCEEDURE")]


def test_empty_table_of_scripts(spark):
    t, df = S.tokens(S.blocks_of(spark.createDataFrame([], "script_id int, sql string"))), spark.createDataFrame([], "script_id int, sql string")
    assert [x.count() for x in (S.statements(t), S.table_columns(t), S.attachments(t), S.stored_units(t, df), S.unrecognized_units(t))] == [0] * 5
