"""Registered queries over schema scripts, with the DuckDB SQL of each.  The operators read scripts line by line; the SQL reads whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.operators import scripts as P
from quillwort.plans import _checkpoint, query
from quillwort.sources.views import load

_TOKEN = P.TOKEN.replace("'", "''")
#: Tokens of whole scripts, their places by a running sum of lengths.
_LEXED = rf"""
t0 AS (SELECT script_id, unnest(regexp_extract_all(sql, '{_TOKEN}')) AS raw, generate_subscripts(regexp_extract_all(sql, '{_TOKEN}'), 1) AS i FROM scripts),
t1 AS (SELECT *, (sum(length(raw)) OVER w - length(raw))::BIGINT AS start, (count(*) FILTER (raw = ';') OVER w - (raw = ';')::INT)::BIGINT AS statement,
  NOT (raw[1:2] IN ('--', '/*') OR regexp_matches(raw, '^[\x09-\x0D\x20]')) AS told FROM t0 WINDOW w AS (PARTITION BY script_id ORDER BY i)),
own AS (SELECT script_id, i, start, raw, CASE WHEN regexp_matches(raw, '^[\p{{L}}_]') THEN upper(raw) ELSE raw END AS u, statement FROM t1 WHERE told AND raw <> ';'),
bare AS (SELECT *, CASE WHEN raw[1] = '"' THEN regexp_replace(raw, '^"|"$', '', 'g') ELSE raw END AS name FROM own)"""


@query(f"""WITH {_LEXED},
s AS (SELECT script_id, statement, min(start) AS start, max(start + length(raw)) AS stop, count(*) AS n_tokens FROM own GROUP BY ALL)
SELECT script_id, statement, start, (stop - start)::INT AS n_chars, n_tokens, sha256(substring(sql, start + 1, stop - start)) AS sha FROM s JOIN scripts USING (script_id)""")
def ddl_statements(spark, sf):
    return P.statements_of(load(spark, sf, "scripts"), _checkpoint(spark)).select("script_id", "statement", "start", F.length("text").alias("n_chars"), "n_tokens", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))


_COLUMNS = """
n0 AS (SELECT *, row_number() OVER w AS n, nth_value(u, 1) OVER f AS u1, nth_value(u, 2) OVER f AS u2, nth_value(u, 3) OVER f AS u3, nth_value(u, 4) OVER f AS u4, sum(CASE u WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER w AS depth
  FROM bare WINDOW w AS (PARTITION BY script_id, statement ORDER BY i), f AS (PARTITION BY script_id, statement ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
n1 AS (SELECT *, CASE WHEN u2 = 'TABLE' THEN 2 ELSE 4 END AS lead, count(*) FILTER (u = ')' AND depth = 0) OVER (PARTITION BY script_id, statement ORDER BY i) - (u = ')' AND depth = 0)::INT AS closed FROM n0 WHERE u1 = 'CREATE' AND (u2 = 'TABLE' OR (u2 = 'GLOBAL' AND u3 = 'TEMPORARY' AND u4 = 'TABLE'))),
n2 AS (SELECT *, count(*) FILTER (u = ',' AND depth = 1) OVER (PARTITION BY script_id, statement ORDER BY i) AS def, bool_or(depth = 0 AND u IN ('AS', 'SELECT')) OVER (PARTITION BY script_id, statement) AS made FROM n1 WHERE closed = 0),
tn AS (SELECT script_id, statement, arg_max(name, n) AS table_name FROM n2 WHERE NOT made AND depth = 0 AND u <> ')' AND n > lead GROUP BY ALL),
df AS (SELECT script_id, statement, def, list(u ORDER BY i) AS us, list(name ORDER BY i) AS names, list(depth ORDER BY i) AS ds FROM n2 WHERE NOT made AND depth >= 1 AND NOT (u IN ('(', ',') AND depth = 1) GROUP BY ALL),
pk AS (SELECT DISTINCT script_id, statement, unnest(list_filter(names[1:coalesce(nullif(list_position(us, 'USING'), 0), len(us))], lambda x, i: ds[i] = 2 AND us[i] NOT IN ('(', ')', ','))) AS name FROM df
  WHERE us[1] IN ('CONSTRAINT', 'PRIMARY', 'UNIQUE', 'FOREIGN', 'CHECK') AND contains(' ' || array_to_string(us, ' ') || ' ', ' PRIMARY KEY ')),
cols AS (SELECT script_id, statement, table_name, def AS place, names[1] AS name, CASE WHEN us[2] = 'LONG' THEN CASE WHEN us[3] = 'RAW' THEN 'BLOB' ELSE 'CLOB' END
    ELSE concat(us[2], CASE WHEN us[3] = '(' THEN array_to_string(us[3:list_position(us, ')')], '') END) END AS type,
  contains(' ' || array_to_string(us, ' ') || ' ', ' NOT NULL ') AS not_null,
  contains(' ' || array_to_string(us, ' ') || ' ', ' PRIMARY KEY ') OR EXISTS (SELECT 1 FROM pk WHERE pk.script_id = df.script_id AND pk.statement = df.statement AND pk.name = df.names[1]) AS pk
  FROM df JOIN tn USING (script_id, statement) WHERE us[1] NOT IN ('CONSTRAINT', 'PRIMARY', 'UNIQUE', 'FOREIGN', 'CHECK'))"""


@query(f"WITH {_LEXED}, {_COLUMNS} SELECT script_id, statement, table_name, place, name, type, not_null, pk FROM cols")
def ddl_columns(spark, sf):
    return P.table_columns(P.statements_of(load(spark, sf, "scripts"), _checkpoint(spark), ("CREATE",)))


#: What statements say of tables, from their tokens in one row each.
_ATTACHED = r"""
al AS (SELECT script_id, statement, list(u ORDER BY i) AS us, list(name ORDER BY i) AS ns, list(raw ORDER BY i) AS rs FROM bare GROUP BY ALL HAVING us[1] IN ('COMMENT', 'ALTER', 'CREATE')),
dots AS (SELECT *, coalesce(list_position(us, 'IS'), 0) AS is_at, coalesce(list_position(us, 'FOREIGN'), 0) AS fk, coalesce(list_position(us, 'REFERENCES'), 0) AS rf, coalesce(list_position(us, 'ON'), 0) AS on_at, CASE WHEN us[2] = 'UNIQUE' THEN 3 ELSE 2 END AS ix FROM al),
par AS (SELECT *, list_transform([4, 3, rf + 1, on_at + 1, ix + 1], lambda p: list_concat([ns[p]], CASE WHEN us[p + 1] = '.' THEN list_concat([ns[p + 2]], CASE WHEN us[p + 3] = '.' THEN [ns[p + 4]] ELSE [] END) ELSE [] END)) AS nm FROM dots),
bk AS (SELECT *, list_transform([fk + 2, rf + 2 * len(nm[3]), on_at + 2 * len(nm[4])], lambda p: list_filter(ns[p + 1:p + coalesce(list_position(us[p:], ')'), 0) - 2], lambda x, i: i = 1 OR us[p + i - 1] = ',')) AS br FROM par),
att AS (
  SELECT script_id, statement, 'comment' AS kind, nm[1][-1] AS table_name, NULL AS name, replace(rs[is_at + 1][2:-2], '''''', '''') AS value FROM bk WHERE us[1] = 'COMMENT' AND us[2] = 'ON' AND us[3] = 'TABLE' AND is_at > 0
  UNION ALL SELECT script_id, statement, 'column comment', nm[1][-2], nm[1][-1], replace(rs[is_at + 1][2:-2], '''''', '''') FROM bk WHERE us[1] = 'COMMENT' AND us[2] = 'ON' AND us[3] = 'COLUMN' AND is_at > 0 AND len(nm[1]) > 1
  UNION ALL SELECT script_id, statement, 'key', nm[2][-1], nm[3][-1], array_to_string(list_transform(list_zip(br[1], br[2])[:least(len(br[1]), len(br[2]))], lambda x: x[1] || '=' || x[2]), ',') FROM bk WHERE us[1] = 'ALTER' AND us[2] = 'TABLE' AND fk > 0 AND rf > fk
  UNION ALL SELECT script_id, statement, 'index', nm[4][-1], nm[5][-1], concat(CASE WHEN us[2] = 'UNIQUE' THEN 'unique ' END, array_to_string(br[3], ',')) FROM bk WHERE us[1] = 'CREATE' AND us[ix] = 'INDEX' AND on_at > 0)"""


def _attaching(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """What attaches, its values as digests before they are exchanged, and tables with their columns."""
    cut = _checkpoint(spark)
    return P.attaching(P.statements_of(load(spark, sf, "scripts"), cut, P.ATTACHING), cut, lambda v: F.sha2(v.cast("binary"), 256))


@query(f"""WITH {_LEXED}, {_COLUMNS}, {_ATTACHED},
k AS (SELECT * FROM att WHERE table_name IN (SELECT table_name FROM cols)),
c AS (SELECT kind, table_name, name, arg_max(value, (script_id, statement)) AS value FROM k WHERE kind = 'comment' OR (kind = 'column comment' AND EXISTS (SELECT 1 FROM cols WHERE cols.table_name = k.table_name AND cols.name = k.name)) GROUP BY ALL)
SELECT kind, table_name, name, sha256(value) AS value, 1 AS place FROM c
UNION ALL SELECT kind, table_name, name, sha256(value), (row_number() OVER (PARTITION BY kind, table_name ORDER BY script_id, statement))::INT FROM k WHERE kind IN ('key', 'index')""")
def ddl_attachments(spark, sf):
    found, columns = _attaching(spark, sf)
    return P.attached(found, columns)


@query(f"""WITH {_LEXED}, {_COLUMNS}, {_ATTACHED}
SELECT script_id, statement, kind, table_name, name FROM att WHERE table_name NOT IN (SELECT table_name FROM cols) OR (kind = 'column comment' AND NOT EXISTS (SELECT 1 FROM cols WHERE cols.table_name = att.table_name AND cols.name = att.name))""")
def ddl_unattached(spark, sf):
    return P.unattached(*_attaching(spark, sf))


#: CREATE statements by the tokens after each CREATE; names from the parts after the kind.
_CREATES = """
ah AS (SELECT script_id, start, u, list(struct_pack(u := u, name := name)) OVER (PARTITION BY script_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING) AS a FROM bare),
c0 AS (SELECT script_id, start, coalesce(a[1].u = 'OR' AND a[2].u = 'REPLACE', FALSE) AS replaced, a FROM ah WHERE u = 'CREATE'),
c1 AS (SELECT script_id, start, replaced, list_filter(CASE WHEN replaced THEN a[3:] ELSE a END, lambda x, i: i > 3 OR x.u NOT IN ('FORCE', 'NO', 'EDITIONABLE', 'NONEDITIONABLE')) AS b FROM c0),
c2 AS (SELECT *, coalesce(b[1].u IN ('PACKAGE', 'TYPE') AND b[2].u = 'BODY', FALSE) AS body, CASE WHEN b[1].u IN ('PACKAGE', 'PROCEDURE', 'FUNCTION', 'TRIGGER', 'VIEW', 'VARIABLE', 'TYPE', 'SEQUENCE', 'SYNONYM', 'ALIAS', 'NICKNAME') THEN lower(b[1].u) END AS word FROM c1),
c3 AS (SELECT script_id, start, replaced, word, CASE WHEN b[p].u IS NOT NULL THEN word || CASE WHEN body AND word = 'type' THEN ' body' ELSE '' END END AS kind,
  concat(b[p].name, CASE WHEN b[p + 1].u = '.' THEN concat('.', b[p + 2].name, CASE WHEN b[p + 3].u = '.' THEN '.' || b[p + 4].name END) END) AS name FROM (SELECT *, CASE WHEN body THEN 3 ELSE 2 END AS p FROM c2))"""


@query(rf"""WITH {_LEXED}, {_CREATES},
k AS (SELECT script_id, start, kind, name, coalesce(lead(start) OVER (PARTITION BY script_id ORDER BY start), length(sql)) AS bound, sql FROM c3 JOIN scripts USING (script_id) WHERE kind IS NOT NULL),
sl AS (SELECT script_id, start FROM bare JOIN scripts USING (script_id) WHERE raw = '/' AND regexp_matches(substring(sql, 1, start), '(^|\n)[\x09\x0B-\x0D\x20]*\z') AND regexp_matches(substring(sql, start + 2), '^[\x09\x0B-\x0D\x20]*(\n|\z)')),
e AS (SELECT k.*, coalesce((SELECT min(sl.start) FROM sl WHERE sl.script_id = k.script_id AND sl.start > k.start AND sl.start < k.bound), k.bound) AS stop FROM k WHERE kind IN ('package', 'procedure', 'function', 'trigger', 'view')),
h AS (SELECT e.*, coalesce((SELECT min(b.start) FROM bare b WHERE b.script_id = e.script_id AND b.start > e.start AND b.start < e.stop AND b.u IN ('AS', 'IS', 'BEGIN')), e.stop) AS head FROM e)
SELECT script_id, start, kind, name, regexp_replace(substring(sql, start + 1, head - start), '^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$', '', 'g') AS signature, sha256(substring(sql, start + 1, stop - start)) AS body_sha FROM h""")
def stored_units(spark, sf):
    return P.stored_units_of(load(spark, sf, "scripts"), _checkpoint(spark)).select("script_id", "start", "kind", "name", "signature", F.sha2(F.col("body").cast("binary"), 256).alias("body_sha"))


@query(f"WITH {_LEXED}, {_CREATES} SELECT script_id, start FROM c3 WHERE replaced AND word IS NULL")
def unrecognized_units(spark, sf):
    return P.unrecognized_units_of(load(spark, sf, "scripts"), _checkpoint(spark))
