"""Logical inputs of the curation engine as views of the parquet tables; one text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: 18 of 20 ids exist; the rest dangle.
CARDS = """
SELECT doc_id AS ord, concat('p', cast(doc_id % 20 AS string), '/', cast(doc_id AS string)) AS card_id, concat('p', cast(doc_id % 20 AS string)) AS product,
  lang AS platform, split_part(text, '.', 1) AS title, text AS description, source,
  CASE WHEN doc_id % 13 = 5 THEN 'correction' WHEN doc_id % 11 = 3 THEN 'memory' WHEN doc_id % 17 = 2 THEN 'issue' ELSE 'concept' END AS type,
  CASE WHEN doc_id % 3 = 0 THEN 'new' WHEN doc_id % 3 = 1 THEN 'old' END AS regime,
  CASE WHEN doc_id % 13 <> 5 AND (doc_id % 11 = 3 OR doc_id % 17 = 2) THEN concat('client', cast(doc_id % 5 AS string)) END AS client,
  CASE WHEN doc_id % 2 = 0 THEN 'approved' ELSE 'draft' END AS status,
  CASE WHEN doc_id % 13 = 5 THEN concat('p', cast((doc_id * 3 + 1) % 20 AS string), '/', cast(doc_id * 3 + 1 AS string)) END AS corrects, length(text) AS n_chars
FROM documents"""
EDGES = """
SELECT doc_id AS src_ord, concat('p', cast(doc_id % 20 AS string), '/', cast(doc_id AS string)) AS src, 0 AS pos, concat('p', cast((doc_id * 7 + 1) % n % 20 AS string), '/', cast((doc_id * 7 + 1) % n AS string)) AS dst
FROM documents, (SELECT count(*) + 50 AS n FROM documents) AS k
UNION ALL
SELECT doc_id, concat('p', cast(doc_id % 20 AS string), '/', cast(doc_id AS string)), 1, concat('p', cast((doc_id * 13 + 5) % n % 20 AS string), '/', cast((doc_id * 13 + 5) % n AS string))
FROM documents, (SELECT count(*) + 50 AS n FROM documents) AS k"""
TICKETS = """
SELECT conv_id AS ticket_id, concat('client', cast(conv_id % 7 AS string)) AS client, max(CASE WHEN turn = f THEN text END) AS subject, max(CASE WHEN turn = f THEN text END) AS description, sum(length(text)) AS thread_chars,
  count(CASE WHEN role = 'assistant' THEN 1 END) AS n_agent, count(*) AS n_turns
FROM (SELECT *, min(turn) OVER (PARTITION BY conv_id) AS f FROM conversations) AS c GROUP BY conv_id"""
#: A schema script for each document, around its whole text: as a comment, as a string, and as prose with whatever quotes it has.
_TABLE = "concat('doc_', cast(doc_id AS string))"
SCRIPTS = f"""
SELECT doc_id AS script_id, concat(
  '-- script; of document ', cast(doc_id AS string), nl, '/* ', replace(body, '*/', '* /'), ' */', nl,
  'CREATE ', CASE WHEN doc_id % 5 = 0 THEN 'GLOBAL TEMPORARY ' ELSE '' END, 'TABLE app.', {_TABLE}, ' (', nl, '  id NUMBER(9,0) NOT NULL ENABLE, -- key; of (', nl,
  '  "Note" VARCHAR2(', cast(30 + doc_id % 9 AS string), ') DEFAULT ', q, 'a;b(', q, q, q, ',', nl, '  raw_', cast(doc_id % 3 AS string), ' LONG RAW,', nl, '  old LONG, made DATE,', nl,
  '  CONSTRAINT pk_', cast(doc_id AS string), ' PRIMARY KEY (id, "Note") USING INDEX TABLESPACE (t)', nl, ') TABLESPACE big STORAGE (INITIAL 64K);', nl,
  'COMMENT ON TABLE app.', {_TABLE}, ' IS ', q, replace(body, q, concat(q, q)), q, ';', nl,
  'COMMENT ON COLUMN app.', {_TABLE}, CASE WHEN doc_id % 4 = 1 THEN '.missing' ELSE '."Note"' END, ' IS ', q, lang, q, ';;', nl,
  'CREATE TABLE copy_', cast(doc_id AS string), ' AS SELECT (1) FROM app.', {_TABLE}, ';', nl,
  'ALTER TABLE app.doc_', cast(doc_id * 3 % 1000 AS string), ' ADD CONSTRAINT fk FOREIGN KEY (id, "Note") REFERENCES app.', {_TABLE}, ' (id, old) ENABLE;', nl,
  'CREATE ', CASE WHEN doc_id % 2 = 0 THEN 'UNIQUE ' ELSE '' END, 'INDEX ix_', cast(doc_id AS string), ' ON ', {_TABLE}, ' (id DESC, "Note");', nl,
  'CREATE OR REPLACE PROCEDURE app.p_', cast(doc_id AS string), ' (x IN NUMBER) AS', nl, 'BEGIN', nl, '  y := x', nl, '    / 2; z := ', q, 'CREATE VIEW v;', nl, '/', nl, q, ';', nl, 'END;', nl, '/', nl,
  CASE WHEN doc_id % 11 = 0 THEN concat('CREATE OR REPLACE PROCEEDURE oops IS BEGIN NULL; END;', nl) ELSE '' END,
  'CREATE OR REPLACE NO FORCE VIEW "V".v_', cast(doc_id AS string), ' AS SELECT 1 FROM dual;', nl, 'create or replace type body t_', cast(doc_id AS string), ' IS x; END;', nl,
  'CREATE PACKAGE BODY pk_', cast(doc_id AS string), ' IS x; END;', nl, ' / ', nl, body) AS sql
FROM (SELECT doc_id, lang, coalesce(text, '') AS body, chr(10) AS nl, chr(39) AS q FROM documents) AS d"""
#: Cards as Markdown files of two trees, around each document's whole text; some have no block, some a wrong one.
CARD_FILES = """
SELECT doc_id, concat(CASE WHEN doc_id % 7 = 1 THEN concat('clients/c', cast(doc_id % 3 AS string), '/memory') WHEN doc_id % 7 = 2 THEN concat('clients/c', cast(doc_id % 3 AS string), '/issues')
    WHEN doc_id % 7 = 3 THEN 'clients/c0/drafts' WHEN doc_id % 7 = 4 THEN concat('p', cast(doc_id % 20 AS string), '/db/tables') ELSE concat('p', cast(doc_id % 20 AS string)) END,
    '/', CASE WHEN doc_id % 50 = 0 THEN 'index' WHEN doc_id % 50 = 6 THEN 'log' ELSE cast(doc_id AS string) END, '.md') AS path,
  concat(CASE WHEN doc_id % 10 = 9 THEN 'no block: ' ELSE concat('---', nl) END,
    CASE WHEN doc_id % 13 = 0 THEN '' ELSE concat('title: ', q, replace(replace(replace(replace(replace(split_part(body, '.', 1), b, concat(b, b)), q, concat(b, q)), nl, concat(b, 'n')), chr(9), ' '), chr(13), ' '), q, ' # --- as written', nl) END,
    'description: ', chr(39), replace(replace(lang, nl, ' '), chr(39), concat(chr(39), chr(39))), ': it', chr(39), chr(39), 's', chr(39), nl,
    CASE WHEN doc_id % 3 = 0 THEN concat('regime: new', nl) WHEN doc_id % 3 = 1 THEN concat('regime: ~', nl) ELSE '' END, 'type: ', CASE WHEN doc_id % 6 = 5 THEN 'correction' ELSE 'concept' END, nl,
    'version: ', cast(2000 + doc_id % 25 AS string), nl, 'share: -0.', cast(doc_id % 9 AS string), nl, 'live: yes', nl, 'product: p', cast(doc_id % 20 AS string), nl,
    'related: [p1/', cast(doc_id * 7 % 100 AS string), ', ', q, 'p2/a, b', q, ']', nl, 'tags:', nl, '  - ', source, nl, '# a comment', nl, '- ', q, lang, q, nl,
    'sources:', nl, '  - ref: open-systems-20', cast(10 + doc_id % 15 AS string), nl, '    page: ', cast(doc_id % 99 AS string), nl, '  - ref: x', nl, 'owner:', nl, '  name: Ada', nl,
    CASE WHEN doc_id % 11 = 4 THEN concat('wrong [line', nl) WHEN doc_id % 11 = 5 THEN concat('wrong: [a, b', nl) ELSE '' END, 'status: draft', nl, 'status: ', CASE WHEN doc_id % 2 = 0 THEN 'approved' ELSE 'draft' END, nl,
    '---', nl, 'status: none', nl, body) AS text
FROM (SELECT doc_id, coalesce(lang, 'xx') AS lang, coalesce(source, 'none') AS source, coalesce(text, '') AS body, chr(10) AS nl, chr(34) AS q, chr(92) AS b FROM documents) AS d"""
VIEWS = {"cards": CARDS, "edges": EDGES, "tickets": TICKETS, "scripts": SCRIPTS, "card_files": CARD_FILES}
BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or a logical input over base tables."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE if f"FROM {t}" in VIEWS[name]}
    sql = VIEWS[name]
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **tables)


def with_views(sql: str) -> str:
    """DuckDB SQL with the logical inputs that it names put before it."""
    used = [f"{v} AS ({q})" for v, q in VIEWS.items() if f" {v}" in sql]
    recursive = sql.lstrip().startswith("WITH RECURSIVE")
    body = sql.lstrip().removeprefix("WITH RECURSIVE").removeprefix("WITH") if sql.lstrip().startswith("WITH") else None
    head = f"WITH {'RECURSIVE ' if recursive else ''}" + ", ".join(used)
    return f"{head}, {body}" if body and used else f"{head} {sql}" if used else sql
