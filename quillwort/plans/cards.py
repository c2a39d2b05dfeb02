"""Registered queries over cards as text, with the DuckDB SQL of each.  The SQL reads the shapes that the view writes; tests cover the others."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillwort.operators import front_matter as M
from quillwort.plans import query
from quillwort.sources.views import load

#: Lines of the blocks by key; a block with a line that is no key, item or value is left out as a whole.
_FIELDS = r"""
blk AS (SELECT doc_id, regexp_extract(text, '\A---\n((?s:.*?))\n---\n', 1) AS block FROM card_files),
ln0 AS (SELECT doc_id, unnest(string_split(block, chr(10))) AS line, generate_subscripts(string_split(block, chr(10)), 1) AS pos FROM blk WHERE block <> ''),
ln AS (SELECT doc_id, pos, rtrim(line) AS line, ltrim(line) AS body, regexp_matches(line, '^[^\s:#"\[-][^:]*:(\s|$)') AS top, regexp_matches(line, '^\s*-(\s|$)') AS is_item FROM ln0 WHERE NOT regexp_matches(line, '^\s*(#.*)?$')),
bad AS (SELECT DISTINCT doc_id FROM ln WHERE (NOT top AND NOT is_item AND NOT starts_with(line, ' ')) OR regexp_matches(line, ':\s*\[[^\]]*$')),
nb AS (SELECT *, count(*) FILTER (top) OVER (PARTITION BY doc_id ORDER BY pos) AS key_no FROM ln WHERE doc_id NOT IN (SELECT doc_id FROM bad)),
it AS (SELECT *, regexp_extract(first_value(line) OVER (PARTITION BY doc_id, key_no ORDER BY pos), '^([^:]*?)\s*:', 1) AS key, count(*) FILTER (is_item) OVER (PARTITION BY doc_id, key_no ORDER BY pos) - 1 AS item, count(*) OVER (PARTITION BY doc_id, key_no) AS n,
  CASE WHEN is_item THEN regexp_replace(body, '^-\s*', '') ELSE body END AS rest FROM nb),
lst AS (SELECT *, max(key_no) OVER (PARTITION BY doc_id, key) AS last, regexp_matches(rest, '^[^\s:#"\[-][^:]*:(\s|$)') AS pair FROM it),
rw AS (SELECT doc_id, key, CASE WHEN item >= 0 THEN item END AS item, CASE WHEN NOT top AND pair THEN regexp_extract(rest, '^([^:]*?)\s*:', 1) END AS sub, trim(CASE WHEN pair THEN regexp_replace(rest, '^[^:]*:', '') ELSE rest END) AS raw, top, n FROM lst WHERE key_no = last),
sp AS (SELECT doc_id, key, item, sub, raw FROM rw WHERE NOT (top AND (n > 1 OR starts_with(raw, '[')))
  UNION ALL SELECT doc_id, key, generate_subscripts(e, 1) - 1, NULL, unnest(e) FROM (SELECT doc_id, key, regexp_extract_all(raw[2:-2], '"(?:[^"\\]|\\.)*"|[^,\s](?:[^,]*[^,\s])?') AS e FROM rw WHERE top AND starts_with(raw, '['))),
fl AS (SELECT doc_id, key, item::INT AS item, sub, CASE raw[1] WHEN '"' THEN json_extract_string(concat('{"v":', regexp_extract(raw, '^"(?:[^"\\]|\\.)*"'), '}'), '$.v') WHEN '''' THEN replace(raw[2:-2], '''''', '''') ELSE nullif(nullif(raw, '~'), '') END AS value,
  CASE WHEN raw[1] IN ('"', '''') THEN 'str' WHEN raw IN ('', '~') THEN 'null' WHEN raw IN ('yes', 'no', 'true', 'false') THEN 'bool' WHEN regexp_matches(raw, '^-?[0-9]+$') THEN 'int' WHEN regexp_matches(raw, '^-?[0-9]+\.[0-9]+$') THEN 'float' ELSE 'str' END AS kind FROM sp)"""


def _files(spark, sf):
    return load(spark, sf, "card_files")


@query(f"WITH {_FIELDS} SELECT doc_id AS id, key, item, sub, value, kind FROM fl")
def card_fields(spark, sf):
    return M.fields(_files(spark, sf).select(F.col("doc_id").alias("id"), "text"))


@query(rf"""WITH {_FIELDS},
k AS (SELECT doc_id, regexp_replace(path, '\.md$', '') AS card_id, string_split(path, '/') AS parts FROM card_files WHERE NOT regexp_matches(path, '(^|/)(index|log)\.md$')),
kept AS (SELECT * FROM k WHERE CASE WHEN parts[1] = 'clients' THEN parts[3] IN ('memory', 'issues') ELSE NOT list_contains(parts[:-2], 'db') END),
f AS (SELECT doc_id, key, value FROM fl WHERE item IS NULL AND sub IS NULL)
SELECT card_id, coalesce((SELECT max(value) FROM f WHERE f.doc_id = kept.doc_id AND key = 'title'), regexp_replace(card_id, '^clients/', '')) AS title, coalesce((SELECT max(value) FROM f WHERE f.doc_id = kept.doc_id AND key = 'description'), '') AS description,
  (SELECT max(value) FROM f WHERE f.doc_id = kept.doc_id AND key = 'regime') AS regime, CASE WHEN parts[1] <> 'clients' THEN coalesce((SELECT max(value) FROM f WHERE f.doc_id = kept.doc_id AND key = 'type'), 'concept') WHEN parts[3] = 'memory' THEN 'memory' ELSE 'issue' END AS type,
  (SELECT max(value) FROM f WHERE f.doc_id = kept.doc_id AND key = 'version') AS version, (SELECT max(value) FROM f WHERE f.doc_id = kept.doc_id AND key = 'product') AS product, CASE WHEN parts[1] = 'clients' THEN parts[2] END AS client,
  NULL::VARCHAR AS corrects, (SELECT max(value) FROM f WHERE f.doc_id = kept.doc_id AND key = 'status') AS status FROM kept""")
def card_index(spark, sf):
    return M.card_index(_files(spark, sf))


@query(r"""WITH b AS (SELECT path, text, regexp_extract(text, '\A---\n((?s:.*?))\n---\n', 1) AS block, length(text) % 2 = 0 AS even FROM card_files)
SELECT path, sha256(CASE WHEN block <> '' AND NOT regexp_matches(block, '(?m)^regime\s*:') THEN concat('---', chr(10), block, chr(10), 'regime: ', CASE WHEN even THEN 'p1/new' ELSE '"it: new"' END, text[length(block) + 5:]) ELSE text END) AS sha FROM b""")
def stamped_cards(spark, sf):
    regime = F.when(F.length("text") % 2 == 0, "p1/new").otherwise("it: new")
    return _files(spark, sf).select("path", F.sha2(M.stamped("text", "regime", regime).cast("binary"), 256).alias("sha"))


@query(r"""WITH n AS (SELECT path AS card_id, text FROM card_files WHERE doc_id % 50 NOT IN (0, 6)), o AS (SELECT path AS card_id, CASE WHEN doc_id % 3 = 0 THEN concat(text, ' old') ELSE text END AS old FROM card_files WHERE doc_id % 5 > 0 AND doc_id % 50 NOT IN (0, 6))
SELECT card_id, CASE WHEN contains(old, 'status: approved') THEN 'preserved' WHEN old = text THEN 'unchanged' ELSE 'written' END AS outcome, sha256(CASE WHEN contains(old, 'status: approved') THEN old ELSE text END) AS sha FROM n LEFT JOIN o USING (card_id)""")
def card_upserts(spark, sf):
    files = _files(spark, sf).where("doc_id % 50 not in (0, 6)")
    stored = files.where("doc_id % 5 > 0").select(F.col("path").alias("card_id"), F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" old"))).otherwise(F.col("text")).alias("text"))
    got = M.upserts(files.select(F.col("path").alias("card_id"), "text"), stored)
    return got.select("card_id", "outcome", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
