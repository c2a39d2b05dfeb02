"""Registered queries of the curation engine over the parquet tables, with the DuckDB SQL of each."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions import cards as K
from quillwort.functions import text as T
from quillwort.operators import curation as C
from quillwort.operators import evaluation as E
from quillwort.operators import ledger as L
from quillwort.operators import retrieval as R
from quillwort.operators import schema as S
from quillwort.operators import validation as V
from quillwort.sources.views import load, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = with_views(sql)
        return f

    return add


def _checkpoint(spark: SparkSession):
    def cut(df: DataFrame) -> DataFrame:
        context, base = spark.sparkContext, spark.conf.get("spark.checkpoint.dir", None)
        if not context.getCheckpointDir():
            if not base and not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(base or tempfile.mkdtemp(prefix="spark-"))
        return df.checkpoint()

    return cut


#: White space of any kind taken off the ends.
_BARE = "regexp_replace({0}, '" + T.STRIP.replace("{", "{{").replace("}", "}}") + "', '', 'g')"
_STOP = "(" + ",".join(f"'{w}'" for w in T.SEARCH_STOPWORDS) + ")"
_RUNS = r"list_filter(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+'), lambda t: t NOT IN " + _STOP + ")"


@query(f"""
WITH c AS (SELECT card_id, {_RUNS.format("concat_ws(' ', title, description, card_id)")} AS w FROM cards WHERE type = 'concept'),
q AS (SELECT item_id AS qid, unnest(list_distinct({_RUNS.format("text")})) AS term FROM benchmark),
tf AS (SELECT term, card_id, count(*) AS tf FROM (SELECT card_id, unnest(w) AS term FROM c) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (SELECT qid, card_id, round(sum((ln((1e0 + (SELECT count(*) FROM c)) / (1e0 + df)) + 1e0) * (1e0 + ln(tf::DOUBLE))), 6) AS score FROM q JOIN tf USING (term) JOIN df USING (term) GROUP BY qid, card_id)
SELECT * FROM (SELECT qid, card_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, card_id)::INT AS place FROM s WHERE score > 0) WHERE place <= 20""")
def rank_concepts(spark, sf):
    asked = load(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return R.rank_concepts(asked, R.searchable(load(spark, sf, "cards")))


@query("""
SELECT card_id, title, score FROM (SELECT card_id, title, ((contains(h, 'the'))::INT + (contains(h, 'ation'))::INT + (contains(h, 'p1/'))::INT)::INT AS score FROM (
  SELECT card_id, title, lower(concat_ws(' ', title, description, card_id)) AS h FROM cards)) WHERE score > 0 ORDER BY score DESC, card_id LIMIT 20""")
def search_objects(spark, sf):
    return R.search_objects(load(spark, sf, "cards"), "the ation p1/")


_LINK_STOP = "(" + ",".join(f"'{w}'" for w in T.LINK_STOPWORDS) + ")"
_LINK = "list_distinct(list_transform(list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda t: length(t) > 2 AND t NOT IN " + _LINK_STOP + "), lambda t: CASE WHEN length(t) > 4 AND suffix(t, 's') AND NOT suffix(t, 'ss') THEN t[:-2] ELSE t END))"


@query(f"""
WITH tg AS (SELECT card_id, unnest({_LINK.format("concat_ws(' ', title, replace(card_id, '/', ' '))")}) AS t FROM cards WHERE type = 'concept'),
idf AS (SELECT t, ln(((SELECT count(DISTINCT card_id) FROM tg) + 1e0) / (count(*) + 1e0)) + 1e0 AS idf FROM tg GROUP BY t),
wt AS (SELECT card_id, t, idf FROM tg JOIN idf USING (t)),
mass AS (SELECT card_id, sum(idf) AS mass FROM wt GROUP BY card_id),
e AS (SELECT ticket_id AS entry_id, unnest({_LINK.format("subject")}) AS t FROM tickets),
g AS (SELECT entry_id, card_id, sum(idf) AS hit, count(*) AS n_shared FROM e JOIN wt USING (t) GROUP BY ALL HAVING count(*) >= 2),
s AS (SELECT entry_id, card_id, n_shared, round(hit / mass, 6) AS score FROM g JOIN mass USING (card_id))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY score DESC, card_id)::INT AS place FROM s WHERE score >= 0.30) WHERE place <= 3""")
def suggest_links(spark, sf):
    return R.suggest_links(load(spark, sf, "tickets").select(F.col("ticket_id").alias("entry_id"), F.col("subject").alias("query")), load(spark, sf, "cards"), checkpoint=_checkpoint(spark))


@query("""
WITH info AS (SELECT card_id, regime FROM cards WHERE type NOT IN ('memory', 'issue')),
r AS (SELECT ord AS request_id, card_id AS seed FROM cards),
l0 AS (SELECT request_id, seed AS card_id, regime, 1 AS place FROM r JOIN info ON info.card_id = r.seed),
n AS (SELECT l0.request_id, e.dst, min(e.pos) AS pos FROM l0 JOIN edges e ON e.src = l0.card_id JOIN info ON info.card_id = e.dst
  WHERE (l0.regime IS NULL OR info.regime IS NULL OR l0.regime = info.regime) AND e.dst <> l0.card_id GROUP BY ALL)
SELECT request_id, card_id, place::INT AS place FROM l0
UNION ALL SELECT request_id, dst, (1 + row_number() OVER (PARTITION BY request_id ORDER BY pos))::INT FROM n""")
def resolve_bundles(spark, sf):
    cards = load(spark, sf, "cards")
    asked = cards.select(F.col("ord").alias("request_id"), F.col("card_id").alias("seed"), F.lit(0).alias("seed_pos"))
    return R.resolve_bundles(asked, cards, load(spark, sf, "edges"))


@query("SELECT card_id, title, product, type, regime, client FROM cards WHERE type <> 'correction' AND NOT (type IN ('memory', 'issue') AND client IS DISTINCT FROM 'client1')")
def list_concepts(spark, sf):
    return R.list_concepts(load(spark, sf, "cards"), "client1")


@query("SELECT sha256(text) AS sha, count(*) AS n, min(doc_id) AS keep, max(doc_id) AS last FROM documents GROUP BY text HAVING count(*) > 1")
def exact_duplicates(spark, sf):
    return C.exact_duplicates(load(spark, sf, "documents"))


@query(f"""
WITH a AS (SELECT conv_id AS ticket_id, count(*) FILTER (role = 'assistant' AND {_BARE.format('text')} <> '' AND NOT regexp_matches({_BARE.format('text')}, '{K.ACKNOWLEDGED}')) AS n_solid FROM conversations GROUP BY 1),
t AS (SELECT ticket_id, sha256(concat(coalesce(client, ''), '|', coalesce(lower({_BARE.format('subject')}), ''), '|', coalesce(lower({_BARE.format('description')}), ''))) AS h,
  CASE WHEN regexp_matches(concat_ws(' ', subject, description), '{C.NOISE}') THEN 'noise-pattern' WHEN thread_chars < 120 THEN 'thin-content' WHEN n_solid = 0 THEN 'no-diagnosis' ELSE 'keep' END AS alone FROM tickets JOIN a USING (ticket_id))
SELECT ticket_id, CASE WHEN ticket_id > min(CASE WHEN alone = 'keep' THEN ticket_id END) OVER (PARTITION BY h) THEN 'duplicate' ELSE alone END AS verdict FROM t""")
def ticket_verdicts(spark, sf):
    said = load(spark, sf, "conversations").select(F.col("conv_id").alias("ticket_id"), "role", F.col("text").alias("body"))
    return C.ticket_verdicts(load(spark, sf, "tickets").drop("n_agent").join(C.substantial_replies(said), "ticket_id").withColumnRenamed("n_solid", "n_agent"))


@query("""
WITH p AS (SELECT p_partkey AS pos, concat(p_brand, '/', (p_size % 7)::VARCHAR) AS stem, ['doc', 'docx', 'xls', 'xlsx', 'xsd'][p_partkey % 5 + 1] AS ext FROM part),
f AS (SELECT *, CASE WHEN ext IN ('doc', 'docx') THEN 'word' WHEN ext IN ('xls', 'xlsx') THEN 'xls' ELSE ext END AS family, CASE ext WHEN 'docx' THEN 1 WHEN 'doc' THEN 3 WHEN 'xlsx' THEN 7 WHEN 'xls' THEN 8 ELSE 99 END AS rank FROM p)
SELECT pos, stem, ext, family, row_number() OVER w = 1 AS kept, first_value(pos) OVER w AS kept_pos FROM f WINDOW w AS (PARTITION BY stem, family ORDER BY rank, pos)""")
def format_variants(spark, sf):
    part = load(spark, sf, "part")
    exts = F.array(*map(F.lit, ("doc", "docx", "xls", "xlsx", "xsd")))
    return C.format_variants(part.select(F.col("p_partkey").alias("pos"), F.concat_ws("/", "p_brand", (F.col("p_size") % 7).cast("string")).alias("stem"), F.element_at(exts, (F.col("p_partkey") % 5 + 1).cast("int")).alias("ext")))


@query("""
WITH b AS (SELECT p_partkey AS pos, concat(trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-'), '-', trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-')) AS base FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY pos) AS n FROM b) SELECT pos, CASE WHEN n = 1 THEN base ELSE concat(base, '-', n::VARCHAR) END AS slug FROM n""")
def assign_slugs(spark, sf):
    return C.assign_slugs(load(spark, sf, "part").select(F.col("p_partkey").alias("pos"), F.col("p_brand").alias("product"), F.col("p_type").alias("name")))


@query("SELECT base, version, path FROM (SELECT p_brand AS base, p_size::VARCHAR AS version, p_name AS path, row_number() OVER (PARTITION BY p_brand ORDER BY p_size::VARCHAR DESC, p_name) AS n FROM part) WHERE n = 1")
def newest_documents(spark, sf):
    return C.newest(load(spark, sf, "part").select(F.col("p_brand").alias("base"), F.col("p_size").cast("string").alias("version"), F.col("p_name").alias("path")))


@query("SELECT product, coalesce(regime, 'none') AS regime, count(*) AS n FROM cards GROUP BY ALL")
def corpus_gauges(spark, sf):
    return C.corpus_gauges(load(spark, sf, "cards"))


@query("SELECT corrects, string_agg(card_id, ',' ORDER BY ord) AS corrections, count(*) AS n FROM cards WHERE type = 'correction' AND status = 'approved' GROUP BY corrects")
def corrections_by_target(spark, sf):
    return C.corrections_by_target(load(spark, sf, "cards"))


@query("SELECT e.src, e.dst, a.regime AS a, b.regime AS b FROM edges e JOIN cards a ON a.card_id = e.src JOIN cards b ON b.card_id = e.dst WHERE a.regime <> b.regime")
def cross_facet_edges(spark, sf):
    return C.cross_facet_edges(load(spark, sf, "cards"), load(spark, sf, "edges"))


@query("SELECT src, dst, pos FROM edges e WHERE NOT EXISTS (SELECT 1 FROM cards c WHERE c.card_id = e.dst)")
def dangling_edges(spark, sf):
    return C.dangling_edges(load(spark, sf, "cards"), load(spark, sf, "edges"))


@query("""
WITH c AS (SELECT card_id, corrects, status, ord FROM cards WHERE type = 'correction'),
s AS (SELECT e.src AS card_id, e.dst AS old, c.status FROM edges e JOIN c ON c.card_id = e.src WHERE e.pos = 0),
gone AS (SELECT DISTINCT old AS card_id FROM s WHERE status = 'approved')
SELECT card_id, 'dangling' AS finding FROM c WHERE corrects NOT IN (SELECT card_id FROM cards WHERE type <> 'correction')
UNION ALL SELECT DISTINCT card_id, 'supersedes unknown' FROM s WHERE old NOT IN (SELECT card_id FROM c)
UNION ALL SELECT card_id, 'superseded but approved' FROM c WHERE status = 'approved' AND card_id IN (SELECT card_id FROM gone)
UNION ALL SELECT min(card_id), 'several live' FROM c WHERE status = 'approved' AND card_id NOT IN (SELECT card_id FROM gone) AND corrects IN (SELECT card_id FROM cards) GROUP BY corrects HAVING count(*) > 1""")
def correction_findings(spark, sf):
    return C.correction_findings(load(spark, sf, "cards"), load(spark, sf, "edges").where("pos = 0").select(F.col("src").alias("card_id"), F.col("dst").alias("old")))


@query("""
WITH m AS (SELECT card_id, product, client, status FROM cards WHERE type = 'memory'),
s AS (SELECT m.*, o.card_id AS old, o.client AS old_client, o.status AS old_status FROM edges e JOIN m ON m.card_id = e.src LEFT JOIN m o ON o.card_id = e.dst WHERE e.pos = 1)
SELECT card_id, 'bad product' AS finding FROM m WHERE product NOT IN ('p1', 'p2', 'p3', 'p4', 'p5', 'p6', 'p7', 'p8', 'p9')
UNION ALL SELECT e.src, 'dangling related' FROM edges e JOIN m ON m.card_id = e.src WHERE e.pos = 0 AND e.dst NOT IN (SELECT card_id FROM cards WHERE type = 'concept')
UNION ALL SELECT card_id, 'supersedes unknown' FROM s WHERE old IS NULL
UNION ALL SELECT card_id, 'supersedes across clients' FROM s WHERE old IS NOT NULL AND client IS DISTINCT FROM old_client
UNION ALL SELECT DISTINCT old, 'superseded but approved' FROM s WHERE client IS NOT DISTINCT FROM old_client AND status = 'approved' AND old_status = 'approved'""")
def memory_findings(spark, sf):
    cards, edges = load(spark, sf, "cards"), load(spark, sf, "edges")
    pick = lambda k, name: edges.where(f"pos = {k}").select(F.col("src").alias("card_id"), F.col("dst").alias(name))
    return C.memory_findings(cards.where("type = 'memory'"), pick(0, "dst"), pick(1, "old"), cards.where("type = 'concept'"), [f"p{k}" for k in range(1, 10)])


@query("""
WITH m AS (SELECT card_id, client, status, ord, platform FROM cards WHERE type = 'memory'),
gone AS (SELECT old.card_id FROM edges e JOIN m new ON new.card_id = e.src AND new.status = 'approved' JOIN m old ON old.card_id = e.dst AND old.client IS NOT DISTINCT FROM new.client WHERE e.pos = 1),
live AS (SELECT * FROM m WHERE status = 'approved' AND card_id NOT IN (SELECT card_id FROM gone)),
k AS (SELECT card_id, 'related ' || dst AS mark FROM edges JOIN live ON src = card_id UNION SELECT card_id, 'tag ' || platform FROM live UNION SELECT card_id, 'tag ' || (ord % 50)::VARCHAR FROM live)
SELECT DISTINCT a.client, a.card_id AS a, b.card_id AS b FROM live a JOIN k ka ON ka.card_id = a.card_id JOIN k kb ON kb.mark = ka.mark JOIN live b ON b.card_id = kb.card_id WHERE a.client IS NOT DISTINCT FROM b.client AND a.card_id < b.card_id""")
def conflict_candidates(spark, sf):
    """Tags are the platform (a hot one) and a number, related cards are the edges."""
    cards, edges = load(spark, sf, "cards"), load(spark, sf, "edges")
    memories = cards.where("type = 'memory'")
    tags = memories.select("card_id", F.explode(F.array(F.concat(F.lit("tag "), "platform"), F.concat(F.lit("tag "), (F.col("ord") % 50).cast("string")))).alias("mark"))
    related = edges.select(F.col("src").alias("card_id"), F.concat(F.lit("related "), "dst").alias("mark"))
    live = C.live_memories(memories, edges.where("pos = 1").select(F.col("src").alias("card_id"), F.col("dst").alias("old")))
    return C.conflict_candidates(live.select("card_id", "client"), tags.unionByName(related))


@query("""
WITH RECURSIVE s AS (SELECT src, dst FROM edges WHERE pos = 1),
r(a, b) AS (SELECT src, dst FROM s UNION SELECT r.a, s.dst FROM r JOIN s ON s.src = r.b),
loops AS (SELECT DISTINCT a FROM r WHERE a = b)
SELECT DISTINCT a AS node FROM r WHERE b IN (SELECT a FROM loops)""")
def supersedes_cycles(spark, sf):
    return C.cyclic_nodes(load(spark, sf, "edges").where("pos = 1"), _checkpoint(spark))


@query("""
WITH l AS (SELECT p_brand AS tab, p_type AS col, min(p_size) AS pos, min(p_name) AS type FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL),
r AS (SELECT p_brand AS tab, p_type AS col, min(p_size) AS pos, min(p_name) AS type FROM part WHERE p_partkey % 2 = 1 GROUP BY ALL)
SELECT coalesce(l.tab, r.tab) AS tab, coalesce(l.col, r.col) AS col, coalesce(l.pos, r.pos + 1000) AS pos, l.type AS type_oracle, r.type AS type_db2 FROM l FULL JOIN r ON l.tab = r.tab AND l.col = r.col""")
def reconcile_columns(spark, sf):
    side = lambda k: load(spark, sf, "part").where(f"p_partkey % 2 = {k}").groupBy(F.col("p_brand").alias("tab"), F.col("p_type").alias("col")).agg(F.min("p_size").alias("pos"), F.min("p_name").alias("type"))
    return C.reconcile_columns(side(0), side(1))


@query("""
SELECT l_orderkey % 500 AS name, arg_min(l_shipdate::DATE::VARCHAR, o) AS module, arg_max(l_partkey, o) FILTER (kind <> 'body') AS spec, arg_max(l_partkey, o) FILTER (kind = 'body') AS body
FROM (SELECT *, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS o, CASE WHEN l_linenumber % 2 = 0 THEN 'body' ELSE 'spec' END AS kind FROM lineitem) GROUP BY ALL""")
def package_units(spark, sf):
    u = load(spark, sf, "lineitem").select((F.col("l_orderkey") % 500).alias("name"), F.when(F.col("l_linenumber") % 2 == 0, "body").otherwise("spec").alias("kind"), F.to_date("l_shipdate").cast("string").alias("module"), F.col("l_partkey").alias("body"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("ord"))
    return C.package_units(u)


@query("SELECT split_part(url, '/', 4) AS ext, count(*) AS n, sum(length(html))::BIGINT AS bytes, 0::BIGINT AS errors FROM pages GROUP BY 1 ORDER BY n DESC, ext LIMIT 15")
def inventory_stats(spark, sf):
    return C.inventory_stats(load(spark, sf, "pages").select(F.split_part("url", F.lit("/"), F.lit(4)).alias("ext"), F.length("html").cast("long").alias("size")))


_EVAL = """
WITH q AS (SELECT ord AS id, client, regime AS expected_regime, CASE WHEN ord % 4 > 0 THEN product END AS expected_product, CASE WHEN ord % 3 = 0 THEN '2023' END AS expected_version,
  CASE WHEN ord % 5 = 0 THEN corrects END AS expects_correction, CASE WHEN type = 'memory' THEN card_id END AS expects_memory, CASE WHEN ord % 2 = 0 THEN card_id ELSE 'p0/0' END AS expected FROM cards),
b AS (SELECT ord AS id, card_id, true AS selected FROM cards WHERE ord % 6 < 5 UNION ALL SELECT src_ord, dst, pos = 0 FROM edges),
i AS (SELECT card_id, regime, product, CASE WHEN ord % 2 = 0 THEN '2023' ELSE '2024' END AS version, client AS card_client FROM cards),
j AS (SELECT q.*, b.card_id, b.selected, i.regime, i.product, i.version, i.card_client FROM q LEFT JOIN b USING (id) LEFT JOIN i ON i.card_id = b.card_id),
s AS (SELECT id, coalesce(bool_or(card_id = expected AND selected), false) AS select_hit, coalesce(bool_or(card_id = expected), false) AS bundle_hit,
  count(*) FILTER (selected AND regime <> expected_regime) AS cross_regime, count(*) FILTER (selected AND product <> expected_product) AS cross_product, count(*) FILTER (selected AND version <> expected_version) AS off_version,
  count(*) FILTER (card_client IS NOT NULL AND card_client IS DISTINCT FROM client) AS cross_client,
  any_value(expects_correction) IS NULL OR coalesce(bool_or(card_id = expects_correction), false) AS correction_ok, any_value(expects_memory) IS NULL OR coalesce(bool_or(card_id = expects_memory), false) AS m FROM j GROUP BY id),
r AS (SELECT id, select_hit, bundle_hit, cross_regime, cross_regime = 0 AS regime_ok, cross_product, cross_product = 0 AS product_ok, off_version, off_version = 0 AS version_ok, correction_ok, cross_client, cross_client = 0 AND m AS memory_ok FROM s)
"""


def _eval_inputs(spark, sf):
    cards, edges = load(spark, sf, "cards"), load(spark, sf, "edges")
    some = lambda where, c: F.when(F.expr(where), F.col(c))
    q = cards.select(F.col("ord").alias("id"), "client", F.col("regime").alias("expected_regime"), some("ord % 4 > 0", "product").alias("expected_product"), F.when(F.col("ord") % 3 == 0, "2023").alias("expected_version"), some("ord % 5 = 0", "corrects").alias("expects_correction"), some("type = 'memory'", "card_id").alias("expects_memory"))
    answers = cards.select(F.col("ord").alias("id"), F.when(F.col("ord") % 2 == 0, F.col("card_id")).otherwise("p0/0").alias("expected"))
    served = cards.where("ord % 6 < 5").select(F.col("ord").alias("id"), "card_id", F.lit(True).alias("selected")).unionByName(edges.select(F.col("src_ord").alias("id"), F.col("dst").alias("card_id"), (F.col("pos") == 0).alias("selected")))
    info = cards.select("card_id", "regime", "product", F.array(F.when(F.col("ord") % 2 == 0, "2023").otherwise("2024")).alias("versions"), "client")
    return q, answers, served, info


@query(_EVAL + "SELECT * FROM r")
def eval_scores(spark, sf):
    return E.scores(*_eval_inputs(spark, sf))


@query(_EVAL + """SELECT count(*) AS n, count(*) FILTER (select_hit) AS select_hit, count(*) FILTER (bundle_hit) AS bundle_hit, count(*) FILTER (regime_ok) AS regime_ok, count(*) FILTER (version_ok) AS version_ok,
  count(*) FILTER (product_ok) AS product_ok, count(*) FILTER (correction_ok) AS correction_ok, count(*) FILTER (memory_ok) AS memory_ok, count(*) FILTER (l.quality = 1) AS correct, count(*) FILTER (l.toxic = 0) AS grounded,
  0::BIGINT AS select_empty, count(*) FILTER (l.quality IS NULL) AS answer_empty, count(*) FILTER (l.doc_id % 50 = 0) AS judge_empty, count(*) FILTER (l.doc_id % 7 = 0) AS unscored, count(*) FILTER (l.quality IS NULL OR l.doc_id % 50 = 0) > 0 AS failed FROM r JOIN labels l ON l.doc_id = r.id""")
def eval_aggregate(spark, sf):
    replies = load(spark, sf, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("correct"), (F.col("toxic") == 0).alias("grounded"), F.when(F.col("doc_id") % 7 == 0, "unscored").otherwise("").alias("note"), F.lit(False).alias("select_empty"), F.col("quality").isNull().alias("answer_empty"), (F.col("doc_id") % 50 == 0).alias("judge_empty"))
    return E.totals(E.scores(*_eval_inputs(spark, sf)), replies)


@query("SELECT DISTINCT ord AS id, client FROM cards WHERE type IN ('memory', 'issue') AND client IS NOT NULL")
def required_clients(spark, sf):
    cards = load(spark, sf, "cards")
    scoped = F.when(F.col("type").isin("memory", "issue"), F.concat(F.lit("clients/"), "client", F.lit("/memory/"), F.col("ord").cast("string"))).otherwise(F.col("card_id"))
    return E.required_clients(cards.select(F.col("ord").alias("id"), F.when(F.col("type") == "memory", scoped).alias("expects_memory")), cards.select(F.col("ord").alias("id"), scoped.alias("expected")))


@query("SELECT ord AS id, (SELECT count(DISTINCT client) FROM cards WHERE type = 'memory') - CASE WHEN client IN (SELECT client FROM cards WHERE type = 'memory') THEN 1 ELSE 0 END AS n FROM cards")
def exposed_clients(spark, sf):
    cards = load(spark, sf, "cards")
    return E.exposed_clients(cards.select(F.col("ord").alias("id"), "client"), cards.where("type = 'memory'").select("client"))


@query("SELECT product, count(*) AS n, sha256(string_agg('- ' || card_id, chr(10) ORDER BY card_id)) AS page_sha FROM cards WHERE type <> 'correction' GROUP BY product")
def index_pages(spark, sf):
    return C.index_pages(load(spark, sf, "cards"))


#: Operations of a ledger: an objective of seven events, some of them by others than its owner.
_OPS = """ops AS (SELECT event_id AS seq, event_id // 7 AS k, user_id // 2 AS u, event_id % 7 AS n, event_type, props FROM events),
log AS (SELECT seq, k, CASE WHEN n = 4 THEN u + 1 ELSE k % 50 END AS owner, CASE n WHEN 0 THEN 'open' WHEN 3 THEN 'status' WHEN 5 THEN 'forget' WHEN 6 THEN 'visibility' ELSE 'entry' END AS op, event_type, props FROM ops),
own AS (SELECT k, arg_min(owner, seq) AS owner, min(seq) AS since FROM log WHERE op = 'open' GROUP BY k),
ok AS (SELECT log.* FROM log JOIN own ON own.k = log.k AND own.owner = log.owner AND seq >= since)"""


def _ledger(spark, sf):
    n = F.col("event_id") % 7
    return load(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.floor(F.col("event_id") / 7).alias("k"), F.when(n == 4, F.floor(F.col("user_id") / 2) + 1).otherwise(F.floor(F.col("event_id") / 7) % 50).alias("owner"),
        F.when(n == 0, "open").when(n == 3, "status").when(n == 5, "forget").when(n == 6, "visibility").otherwise("entry").alias("op"), F.col("event_type").alias("kind"), "props",
    )


@query(f"WITH {_OPS} SELECT k AS objective_id, owner, coalesce(arg_max(event_type, seq) FILTER (op = 'status'), 'open') AS status, count(*) FILTER (op = 'entry') AS n_entries, max(seq) AS updated_at FROM ok WHERE op IN ('open', 'status', 'entry') GROUP BY k, owner")
def objectives(spark, sf):
    return L.objectives(_ledger(spark, sf).where("op in ('open', 'status', 'entry')").select("seq", "op", F.col("k").alias("objective_id"), "owner", F.col("kind").alias("status")))


_SAID = "['investigate', 'implement', 'learn', 'work', 'open', 'active', 'resolved', 'parked', 'finding', 'step', 'memo', 'private', NULL]"


@query(f"""
WITH l AS (SELECT event_id AS seq, CASE event_id % 7 WHEN 0 THEN 'open' WHEN 3 THEN 'status' WHEN 5 THEN 'forget' WHEN 6 THEN 'visibility' ELSE 'entry' END AS op, ({_SAID})[event_id % 13 + 1] AS value FROM events)
SELECT seq, CASE op WHEN 'open' THEN 'mode' WHEN 'entry' THEN 'kind' ELSE op END AS field, value FROM l WHERE op <> 'forget' AND (value IS NULL OR value NOT IN (SELECT unnest(CASE l.op WHEN 'open' THEN ['investigate', 'implement', 'learn']
  WHEN 'status' THEN ['open', 'active', 'resolved', 'done'] WHEN 'visibility' THEN ['private', 'promotion_requested'] ELSE ['plan', 'step', 'finding', 'decision', 'quiz_result', 'note'] END)))""")
def refused_operations(spark, sf):
    said = F.element_at(F.expr(f"array{_SAID}".replace("[", "(").replace("]", ")")), (F.col("seq") % 13 + 1).cast("int"))
    return L.refusals(_ledger(spark, sf).select("seq", "op", said.alias("value")))


@query(f"WITH {_OPS} SELECT k AS objective_id, row_number() OVER (PARTITION BY k ORDER BY seq)::INT AS place, seq, event_type AS kind FROM ok WHERE op = 'entry'")
def entry_log(spark, sf):
    return L.entry_log(_ledger(spark, sf).select("seq", "op", F.col("k").alias("objective_id"), "owner", "kind"))


def _memories(spark, sf):
    log = _ledger(spark, sf).where("k % 3 > 0 or op <> 'forget'")
    return L.memories(log.select("seq", "op", F.col("k").alias("memory_id"), "owner", F.col("props").alias("text"), F.array("kind", F.concat(F.lit("t"), (F.col("k") % 4).cast("string"))).alias("tags"), F.array((F.col("k") % 9).cast("string")).alias("card_ids"), F.when(F.col("k") % 5 > 0, F.concat(F.lit("client"), (F.col("k") % 5).cast("string"))).alias("client"), F.lit("promotion_requested").alias("visibility")))


_MEM = f"""WITH {_OPS}, held AS (SELECT k, owner, arg_min(props, seq) FILTER (op = 'open') AS text, arg_min(event_type, seq) FILTER (op = 'open') AS tag, 't' || (k % 4)::VARCHAR AS tag2, CASE WHEN k % 5 > 0 THEN 'client' || (k % 5)::VARCHAR END AS client,
  CASE WHEN count(*) FILTER (op = 'visibility') > 0 THEN 'promotion_requested' ELSE 'private' END AS visibility, max(seq) FILTER (op <> 'forget') AS last FROM ok GROUP BY k, owner HAVING count(*) FILTER (op = 'forget' AND k % 3 > 0) = 0)"""


@query(_MEM + " SELECT k AS memory_id, owner, text, visibility, last AS updated_at, concat(tag, ',', tag2) AS tags FROM held")
def memories(spark, sf):
    return _memories(spark, sf).select("memory_id", "owner", "text", "visibility", "updated_at", F.array_join("tags", ",").alias("tags"))


@query(_MEM + " SELECT k AS memory_id, last AS updated_at FROM held WHERE owner = 3 AND tag2 = 't1' AND client = 'client3' AND (contains(lower(text), '1') OR contains(tag, '1') OR contains(tag2, '1')) ORDER BY last DESC LIMIT 20")
def recall_memories(spark, sf):
    return L.recall(_memories(spark, sf), 3, needle="1", tags=["t1"], client="client3").select("memory_id", "updated_at")


@query(_MEM + " SELECT k AS memory_id, client, text AS memory, owner AS submitted_by, 'approved' AS status FROM held WHERE client IS NOT NULL AND visibility = 'private'")
def promotable_memories(spark, sf):
    return L.promotable(_memories(spark, sf)).drop("related", "tags")


@query("""
WITH c AS (SELECT ord, CASE WHEN client IS NOT NULL THEN concat('clients/', client, '/memory/', ord::VARCHAR, '.md') ELSE card_id END AS id, title, description, product, regime, client FROM cards)
SELECT ord, CASE WHEN starts_with(id, 'clients/') THEN split_part(id, '/', 2) END AS client_of, split_part(id, '/', 1) AS product_of, starts_with(id, 'clients/') AS memory_path, split_part(concat(id, '@2022'), '@', 1) AS bare,
  sha256(concat('- ', id, ': ', CASE WHEN client IS NOT NULL THEN concat('<client:', client, '> ') ELSE '' END, '{', product, '} ', CASE WHEN regime IS NOT NULL THEN concat('[', regime, '] ') ELSE '' END,
    CASE WHEN ord % 3 = 0 THEN '(v2023,2024) ' ELSE '' END, title, ', ', description)) AS line, CASE WHEN ord % 3 = 0 THEN '2023,2024' ELSE '' END AS versions FROM c""")
def card_facets(spark, sf):
    c = load(spark, sf, "cards").withColumn("id", F.when(F.col("client").isNotNull(), F.concat(F.lit("clients/"), "client", F.lit("/memory/"), F.col("ord").cast("string"), F.lit(".md"))).otherwise(F.col("card_id")))
    refs = F.when(F.col("ord") % 3 == 0, F.array(F.lit("kb/open-systems-2024/x"), F.lit("open-systems-2023 and open-systems-2024"))).otherwise(F.array(F.lit("open-systems-1999")))
    c = c.withColumn("v", K.derived_versions(refs))
    return c.select("ord", K.client_of_id("id").alias("client_of"), K.product_of_id("id").alias("product_of"), K.is_memory_path("id").alias("memory_path"), K.strip_version(F.concat("id", F.lit("@2022"))).alias("bare"), F.sha2(K.prompt_line("id", "title", "description", "product", "regime", "client", "v").cast("binary"), 256).alias("line"), F.array_join("v", ",").alias("versions"))


@query(r"""
WITH p AS (SELECT p_partkey AS pos, p_brand AS product, concat(p_type, '/', p_name, '.', ['Docx', 'xsd', 'PDF', 'txt'][p_partkey % 4 + 1]) AS path, ['docx', 'xsd', 'pdf', 'txt'][p_partkey % 4 + 1] AS ext, p_name AS name FROM part),
s AS (SELECT *, trim(regexp_replace(lower(concat(product, ' ', regexp_replace(path, '\.[^.]+$', ''))), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM p)
SELECT pos, slug AS doc_slug, CASE WHEN ext IN ('xsd', 'txt') THEN concat(slug, '-', ext) ELSE slug END AS base_slug, concat(pos::VARCHAR, '-', rtrim(substr(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 1, 60), '-'), '.md') AS file, ext FROM s""")
def file_slugs(spark, sf):
    exts = F.element_at(F.array(*map(F.lit, ("Docx", "xsd", "PDF", "txt"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("pos"), F.col("p_brand").alias("product"), F.concat("p_type", F.lit("/"), "p_name", F.lit("."), exts).alias("path"), F.col("p_name").alias("name"))
    return p.select("pos", K.doc_slug("product", "path").alias("doc_slug"), K.base_slug("product", "path").alias("base_slug"), K.issue_filename("pos", "name").alias("file"), K.extension("path").alias("ext"))


@query(r"""
WITH p AS (SELECT p_partkey AS pos, ['Docs', p_brand, concat('v', (2020 + p_size % 7)::VARCHAR, '.1'), p_type, 'Release   Notes', ' Brand#11 '] AS s FROM part),
n AS (SELECT pos, s, list_transform(s, lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))) AS l FROM p),
h AS (SELECT *, list_position(list_transform(l, lambda x: x IN ('brand#11', 'brand#22', 'brand#33')), true) AS pp, list_position(list_transform(l, lambda x: regexp_matches(x, '^v?[0-9]{4}(\.[0-9]+)*$')), true) AS vp, list_position(list_transform(l, lambda x: x = 'release notes'), true) AS cp FROM n)
SELECT pos, CASE l[pp] WHEN 'brand#11' THEN 'one' WHEN 'brand#22' THEN 'two' WHEN 'brand#33' THEN 'three' END AS product, ltrim(l[vp], 'v') AS version, CASE WHEN cp > 0 THEN 'notes' END AS category,
  list_filter(s, lambda x, i: l[i] NOT IN ('docs') AND i IS DISTINCT FROM pp AND i IS DISTINCT FROM vp AND i IS DISTINCT FROM cp)[1] AS client FROM h""")
def folder_hints(spark, sf):
    segments = F.array(F.lit("Docs"), "p_brand", F.concat(F.lit("v"), (F.col("p_size") % 7 + 2020).cast("string"), F.lit(".1")), "p_type", F.lit("Release   Notes"), F.lit(" Brand#11 "))
    hints = K.folder_hints(segments, {"brand#11": "one", "brand#22": "two", "brand#33": "three"}, {"release notes": "notes"})
    return load(spark, sf, "part").select(F.col("p_partkey").alias("pos"), hints.alias("h")).select("pos", "h.*")


@query(f"""
WITH r AS (SELECT conv_id AS id, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER ({_BARE.format('text')} <> '') AS t FROM conversations GROUP BY 1)
SELECT id, length(coalesce(t, ''))::INT AS n, sha256(CASE WHEN length(t) > 200 THEN concat(left(t, 100), chr(10), chr(10), '[...truncated...]', chr(10), chr(10), right(t, 100)) ELSE coalesce(t, '') END) AS cut FROM r""")
def thread_texts(spark, sf):
    """A thread's parts are gathered by ticket: a ticket has few."""
    parts = load(spark, sf, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("p"))
    t = parts.select("id", K.thread_text("p").alias("t"))
    return t.select("id", F.length("t").alias("n"), F.sha2(K.truncated_thread("t", 200).cast("binary"), 256).alias("cut"))


@query("""
SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN 'x1' WHEN 1 THEN 'a,b' WHEN 2 THEN '' ELSE 'b' END AS picks, CASE doc_id % 4 WHEN 0 THEN 1e0 WHEN 1 THEN (doc_id % 10) / 10e0 WHEN 2 THEN 1e0 ELSE 0.12345678e0 END AS probability,
  CASE WHEN doc_id % 4 = 3 THEN 'clear' WHEN doc_id % 4 <> 1 OR doc_id % 10 >= 6 THEN 'block' WHEN doc_id % 10 >= 3 THEN 'review' ELSE 'clear' END AS verdict, CASE doc_id % 4 WHEN 0 THEN 'yes' WHEN 2 THEN 'no json } here {' ELSE NULL END AS answer FROM documents""")
def model_replies(spark, sf):
    """Replies made up in four shapes: answer tags with a pick, a fenced object, prose, and an object after a fenced block that has none and thoughts in capitals."""
    k = F.col("doc_id") % 4
    reply = F.when(k == 0, F.lit('<think>{"picks": ["a"]}</think> {"picks": ["zz", "x1", "x1"]} <answer> yes </answer>')).when(k == 1, F.concat(F.lit('Sure\n```json\n{"picks": ["a", "q", "b", "a", "x1"], "probability": '), ((F.col("doc_id") % 10) / 10).cast("string"), F.lit("}\n```"))).when(k == 2, F.lit("no json } here {")).otherwise(F.lit('<THINK>{"x"</THINK>```json\nnone\n``` {"picks": ["b"], "probability": 0.12345678}'))
    p = K.probability("r")
    return load(spark, sf, "documents").select(F.col("doc_id").alias("id"), reply.alias("r")).select("id", F.array_join(K.picks("r", F.array(F.lit("a"), F.lit("b"), F.lit("x1"))), ",").alias("picks"), p.alias("probability"), K.conflict_class(p).alias("verdict"), F.when(F.col("id") % 2 == 0, K.strip_think("r")).alias("answer"))


_PLAN = "doc_id::VARCHAR AS path, lang AS platform, CASE WHEN doc_id % 9 > 0 THEN source END AS product, CASE WHEN doc_id % 8 > 0 THEN 'guide' ELSE 'memo' END AS doc_type"


@query(f"""
WITH f AS (SELECT doc_id::VARCHAR AS path FROM documents WHERE doc_id % 10 > 0), i AS (SELECT {_PLAN} FROM documents WHERE doc_id % 2 = 0), x AS (SELECT doc_id::VARCHAR AS path FROM documents WHERE doc_id % 7 = 0),
g AS (SELECT doc_id::VARCHAR AS keep, (doc_id + doc_id % 2)::VARCHAR AS drop FROM documents WHERE doc_id % 11 = 0)
SELECT path AS key, 'included and excluded' AS finding FROM (SELECT path FROM i INTERSECT SELECT path FROM x)
UNION ALL SELECT path, 'include path missing' FROM i WHERE path NOT IN (SELECT path FROM f) UNION ALL SELECT path, 'no product' FROM i WHERE product IS NULL
UNION ALL SELECT path, 'invalid doc_type' FROM i WHERE doc_type <> 'guide' UNION ALL SELECT path, 'invalid platform' FROM i WHERE platform NOT IN ('en', 'de') UNION ALL SELECT path, 'invalid product' FROM i WHERE product NOT IN ('src0', 'src1', 'src2')
UNION ALL SELECT keep, 'kept and dropped' FROM g WHERE keep = drop UNION ALL SELECT DISTINCT keep, 'kept path missing' FROM g WHERE keep NOT IN (SELECT path FROM f) UNION ALL SELECT drop, 'dropped path missing' FROM g WHERE drop NOT IN (SELECT path FROM f)""")
def plan_findings(spark, sf):
    d = load(spark, sf, "documents")
    path = F.col("doc_id").cast("string").alias("path")
    include = d.where("doc_id % 2 = 0").select(path, F.col("lang").alias("platform"), F.when(F.col("doc_id") % 9 > 0, F.col("source")).alias("product"), F.when(F.col("doc_id") % 8 > 0, "guide").otherwise("memo").alias("doc_type"))
    groups = d.where("doc_id % 11 = 0").select(F.col("doc_id").cast("string").alias("keep"), (F.col("doc_id") + F.col("doc_id") % 2).cast("string").alias("drop"))
    return V.plan_findings(include, d.where("doc_id % 7 = 0").select(path), groups, d.where("doc_id % 10 > 0").select(path), ["en", "de"], ["src0", "src1", "src2"], ["guide"])


@query("""
WITH d AS (SELECT doc_id::VARCHAR || '.md' AS name, CASE WHEN doc_id % 12 > 0 THEN 's' || (doc_id // 2)::VARCHAR END AS slug, CASE WHEN doc_id % 9 > 0 THEN 'guide' END AS doc_type, CASE WHEN doc_id % 5 > 0 THEN 'active' WHEN doc_id % 2 = 0 THEN 'odd' END AS status, lang AS platform, source AS product, CASE WHEN doc_id % 14 > 0 THEN '2023' END AS version FROM documents),
k AS (SELECT * FROM d WHERE slug IS NOT NULL AND name = (SELECT min(name) FROM d e WHERE e.slug = d.slug)),
r AS (SELECT 's' || doc_id::VARCHAR AS slug, 's' || (doc_id * 3 + 1)::VARCHAR || '@2022' AS target FROM documents)
SELECT name AS key, 'missing slug' AS finding FROM d WHERE slug IS NULL UNION ALL SELECT name, 'duplicate slug' FROM d WHERE slug IS NOT NULL AND name NOT IN (SELECT name FROM k)
UNION ALL SELECT name, 'invalid doc_type' FROM k WHERE doc_type IS NULL UNION ALL SELECT name, 'invalid status' FROM k WHERE status = 'odd' UNION ALL SELECT name, 'missing platform' FROM k WHERE coalesce(platform, '') = ''
UNION ALL SELECT name, 'missing product' FROM k WHERE coalesce(product, '') = '' UNION ALL SELECT name, 'missing version' FROM k WHERE version IS NULL
UNION ALL SELECT slug, 'dangling related' FROM r WHERE slug IN (SELECT slug FROM k) AND split_part(target, '@', 1) NOT IN (SELECT slug FROM k)""")
def atomic_findings(spark, sf):
    d = load(spark, sf, "documents")
    s = lambda c: F.concat(F.lit("s"), c.cast("string"))
    i = F.col("doc_id")
    docs = d.select(F.concat(i.cast("string"), F.lit(".md")).alias("name"), F.when(i % 12 > 0, s(F.floor(i / 2))).alias("slug"), F.when(i % 9 > 0, "guide").alias("doc_type"), F.when(i % 5 > 0, "active").when(i % 2 == 0, "odd").alias("status"), F.col("lang").alias("platform"), F.col("source").alias("product"), F.when(i % 14 > 0, "2023").alias("version"))
    return V.atomic_findings(docs, d.select(s(i).alias("slug"), F.concat(s(i * 3 + 1), F.lit("@2022")).alias("target")), ["guide"], ["active", "superseded"])


@query("""
WITH d AS (SELECT card_id, status, ord FROM cards WHERE ord % 4 = 1), k AS (SELECT card_id FROM cards WHERE ord % 5 = 0),
ids AS (SELECT card_id FROM d UNION SELECT card_id FROM k), b AS (SELECT src AS card_id, count(*) AS n FROM edges WHERE dst NOT IN (SELECT card_id FROM ids) GROUP BY 1)
SELECT d.card_id, CASE WHEN status <> 'approved' OR d.card_id IN (SELECT card_id FROM k) THEN 'skipped' WHEN ord % 3 = 0 OR coalesce(n, 0) > 0 THEN 'invalid' ELSE 'promoted' END AS outcome, CASE WHEN ord % 3 = 0 THEN 'title' ELSE '' END AS missing, coalesce(n, 0) AS n_unknown FROM d LEFT JOIN b USING (card_id)""")
def card_promotions(spark, sf):
    cards = load(spark, sf, "cards")
    drafts = cards.where("ord % 4 = 1").select("card_id", "status", F.when(F.col("ord") % 3 == 0, F.array(F.lit("type"))).otherwise(F.array(F.lit("type"), F.lit("title"))).alias("keys"))
    return V.promotions(drafts, cards.where("ord % 5 = 0").select("card_id"), load(spark, sf, "edges").select(F.col("src").alias("card_id"), "dst"), ["type", "title"])


@query("""
WITH info AS (SELECT card_id, regime, n_chars FROM cards WHERE NOT (type IN ('memory', 'issue') AND client IS DISTINCT FROM 'client1')),
r AS (SELECT ord AS request_id, card_id AS seed FROM cards), l0 AS (SELECT request_id, seed AS card_id, regime, 1 AS place FROM r JOIN info ON info.card_id = r.seed),
n AS (SELECT l0.request_id, e.dst AS card_id, min(e.pos) AS pos FROM l0 JOIN edges e ON e.src = l0.card_id JOIN info ON info.card_id = e.dst WHERE (l0.regime IS NULL OR info.regime IS NULL OR l0.regime = info.regime) AND e.dst <> l0.card_id GROUP BY ALL),
p AS (SELECT request_id, card_id, place FROM l0 UNION ALL SELECT request_id, card_id, 1 + row_number() OVER (PARTITION BY request_id ORDER BY pos) FROM n),
w AS (SELECT request_id, max(card_id) FILTER (place = 1) AS a, max(card_id) FILTER (place = 2) AS b, max(card_id) FILTER (place = 3) AS c, max(n_chars) FILTER (place = 1) AS na, max(n_chars) FILTER (place = 2) AS nb, max(n_chars) FILTER (place = 3) AS nc FROM p JOIN info USING (card_id) GROUP BY 1),
k AS (SELECT *, b IS NOT NULL AND na + nb <= 3000 AS kb FROM w),
s AS (SELECT *, CASE WHEN kb THEN [a, b] ELSE [a] END AS ids FROM k),
f AS (SELECT s.request_id, x.card_id AS fix, min(list_position(s.ids, x.corrects) * 1000000000 + x.ord) AS o FROM s, cards x WHERE x.type = 'correction' AND x.status = 'approved' AND list_contains(s.ids, x.corrects) AND NOT list_contains(s.ids, x.card_id) GROUP BY ALL),
g AS (SELECT request_id, string_agg(fix, ',' ORDER BY o) AS corrections FROM f GROUP BY 1)
SELECT request_id, array_to_string(ids, ',') AS card_ids, coalesce(corrections, '') AS corrections, array_to_string(list_filter([c, CASE WHEN NOT kb THEN b END], lambda x: x IS NOT NULL), ',') AS dropped, (na + CASE WHEN kb THEN nb ELSE 0 END)::BIGINT AS chars FROM s LEFT JOIN g USING (request_id)""")
def budgeted_bundles(spark, sf):
    cards = load(spark, sf, "cards")
    asked = cards.select(F.col("ord").alias("request_id"), F.col("card_id").alias("seed"), F.lit(0).alias("seed_pos"))
    got = R.budgeted_bundles(R.resolve_bundles(asked, cards, load(spark, sf, "edges"), max_cards=2, client="client1"), cards, 2, 3000)
    joined = lambda c: F.array_join(c, ",").alias(c)
    return got.select("request_id", joined("card_ids"), joined("corrections"), joined("dropped"), "chars")


_UNITS = "concat('u', (p_partkey % 700)::VARCHAR) AS name, CASE WHEN p_partkey % 3 = 0 THEN 'procedure' ELSE 'package' END AS kind, p_size % 2 = 0 AS is_body, concat(p_brand, CASE WHEN p_partkey % 2 = 0 THEN '  ' ELSE ' ' END, p_partkey % 9) AS body, p_partkey AS ord"


def _units(spark, sf):
    k = F.col("p_partkey")
    body = F.concat("p_brand", F.when(k % 2 == 0, "  ").otherwise(" "), (k % 9).cast("string"))
    return load(spark, sf, "part").select(F.concat(F.lit("u"), (k % 700).cast("string")).alias("name"), F.when(k % 3 == 0, "procedure").otherwise("package").alias("kind"), (F.col("p_size") % 2 == 0).alias("is_body"), body.alias("body"), k.alias("ord"))


@query(f"""
WITH u AS (SELECT {_UNITS} FROM part), p AS (SELECT * FROM u WHERE ord % 4 > 0), s AS (SELECT * FROM u WHERE ord % 4 = 0)
SELECT ord, name, kind FROM p UNION ALL SELECT ord, name, kind FROM s WHERE name NOT IN (SELECT name FROM p WHERE ord % 5 = 0)""")
def tiered_units(spark, sf):
    u = _units(spark, sf).select("ord", "name", "kind")
    product = u.where("ord % 4 > 0")
    return S.tiered_units(product, u.where("ord % 4 = 0"), product.where("ord % 5 = 0"))


@query(rf"""
WITH u AS (SELECT {_UNITS} FROM part), o AS (SELECT name, min(body) AS body FROM u WHERE ord % 2 = 0 GROUP BY 1), d AS (SELECT name, max(body) AS body FROM u WHERE ord % 2 = 1 GROUP BY 1)
SELECT coalesce(o.name, d.name) AS name, CASE WHEN d.name IS NULL THEN 'oracle' WHEN o.name IS NULL THEN 'db2' ELSE 'oracle,db2' END AS platform, coalesce(o.body, '') AS body_oracle,
  CASE WHEN regexp_replace(o.body, '\s+', ' ', 'g') = regexp_replace(d.body, '\s+', ' ', 'g') THEN '' ELSE coalesce(d.body, '') END AS body_db2 FROM o FULL JOIN d ON o.name = d.name""")
def reconciled_units(spark, sf):
    u = _units(spark, sf)
    return S.reconciled_units(u.where("ord % 2 = 0").groupBy("name").agg(F.min("body").alias("body")), u.where("ord % 2 = 1").groupBy("name").agg(F.max("body").alias("body")))


@query(rf"""
WITH u AS (SELECT {_UNITS} FROM part)
SELECT name, count(*) AS n, CASE WHEN count(DISTINCT regexp_replace(body, '\s+', ' ', 'g')) = 1 THEN 'identical' ELSE 'differs in body' END AS verdict FROM u
GROUP BY name HAVING count(*) > 1 AND NOT (bool_and(kind = 'package') AND count(*) FILTER (is_body) <= 1 AND count(*) FILTER (NOT is_body) <= 1)""")
def repeated_units(spark, sf):
    return S.repeated_units(_units(spark, sf))


@query("""
WITH c AS (SELECT concat('t', (l_orderkey % 3000)::VARCHAR) AS tab, concat(l_linenumber, '|', l_returnflag, '|', coalesce(CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END, ''), '|', CASE WHEN l_linenumber % 3 = 0 THEN 'true' ELSE 'false' END) AS v FROM lineitem),
k AS (SELECT DISTINCT concat('t', (l_orderkey % 3000)::VARCHAR) AS tab, l_linenumber::VARCHAR AS col FROM lineitem WHERE l_linenumber % 5 = 1)
SELECT tab, sha256(concat(cs, ';', coalesce(ks, ''))) AS structure FROM (SELECT tab, string_agg(DISTINCT v, ',' ORDER BY v) AS cs FROM c GROUP BY 1) LEFT JOIN (SELECT tab, string_agg(col, ',' ORDER BY col) AS ks FROM k GROUP BY 1) USING (tab)""")
def table_structures(spark, sf):
    n = F.col("l_linenumber")
    c = load(spark, sf, "lineitem").select(F.concat(F.lit("t"), (F.col("l_orderkey") % 3000).cast("string")).alias("tab"), n.cast("string").alias("name"), F.col("l_returnflag").alias("type_oracle"), F.when(n % 2 == 0, F.col("l_linestatus")).alias("type_db2"), (n % 3 == 0).alias("not_null"))
    return S.table_structures(c, c.where("cast(name AS int) % 5 = 1").select("tab", F.col("name").alias("col")))


@query("""
WITH f AS (SELECT l_orderkey AS tab, concat('s', (l_suppkey % 3)::VARCHAR) AS ref, min(l_linenumber * 1000000 + l_partkey) AS pos FROM lineitem GROUP BY ALL)
SELECT tab, string_agg('core/db/tables/' || ref, ',' ORDER BY pos, ref) AS related FROM f GROUP BY tab""")
def key_links(spark, sf):
    f = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tab"), (F.col("l_linenumber") * F.lit(1000000).cast("long") + F.col("l_partkey")).alias("pos"), F.concat(F.lit("s"), (F.col("l_suppkey") % 3).cast("string")).alias("ref_table"))
    return S.key_links(f, "core").select("tab", F.array_join("related", ",").alias("related"))


@query("""
WITH s AS (SELECT l_orderkey AS name, l_linenumber % 2 AS dialect, l_partkey AS pos, concat('f', (l_suppkey % 4)::VARCHAR, '.sql') AS path FROM lineitem),
o AS (SELECT name, path, min(dialect * 1000000000 + pos) AS place FROM s GROUP BY ALL)
SELECT name, string_agg(path, ',' ORDER BY place, path) AS paths FROM o GROUP BY name""")
def united_sources(spark, sf):
    s = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("name"), (F.col("l_linenumber") % 2).alias("dialect"), F.col("l_partkey").alias("pos"), F.concat(F.lit("f"), (F.col("l_suppkey") % 4).cast("string"), F.lit(".sql")).alias("path"))
    return S.united_sources(s).select("name", F.array_join("paths", ",").alias("paths"))


@query("""
WITH t AS (SELECT p_partkey AS pos, concat(upper(split_part(p_type, ' ', 1)), '_', p_partkey::VARCHAR) AS tab FROM part WHERE p_partkey % 7 = 0 UNION ALL SELECT -p_partkey, concat('T', p_partkey::VARCHAR) FROM part WHERE p_partkey % 11 = 0),
s AS (SELECT concat('SEQ_', upper(split_part(p_type, ' ', 1)), '_', p_partkey::VARCHAR, CASE WHEN p_size % 2 = 0 THEN '_X' ELSE '' END) AS name, concat(upper(split_part(p_type, ' ', 1)), '_', p_partkey::VARCHAR, CASE WHEN p_size % 2 = 0 THEN '_X' ELSE '' END) AS stem FROM part UNION SELECT concat('T', p_partkey::VARCHAR, '_SEQ'), concat('T', p_partkey::VARCHAR) FROM part WHERE p_partkey < 500),
m AS (SELECT name, tab, row_number() OVER (PARTITION BY name ORDER BY CASE WHEN tab = stem THEN 0 ELSE 1 END, length(tab) DESC, pos) AS r FROM s JOIN t ON starts_with(stem, tab || '_') OR starts_with(tab, stem))
SELECT s.name, m.tab AS owner FROM s LEFT JOIN m ON m.name = s.name AND r = 1""")
def sequence_owners(spark, sf):
    p, k = load(spark, sf, "part"), F.col("p_partkey")
    base, own = F.concat(F.upper(F.split_part("p_type", F.lit(" "), F.lit(1))), F.lit("_"), k.cast("string")), F.concat(F.lit("T"), k.cast("string"))
    tables = p.where(k % 7 == 0).select(base.alias("tab"), k.alias("pos")).unionByName(p.where(k % 11 == 0).select(own.alias("tab"), (-k).alias("pos")))
    names = p.select(F.concat(F.lit("SEQ_"), base, F.when(F.col("p_size") % 2 == 0, "_X").otherwise("")).alias("name")).unionByName(p.where(k < 500).select(F.concat(own, F.lit("_SEQ")).alias("name")))
    return S.sequence_owners(names, tables)


@query("SELECT product, count(*) AS n FROM cards WHERE type = 'concept' GROUP BY 1")
def topic_counts(spark, sf):
    return S.tally(load(spark, sf, "cards").where("type = 'concept'"), "product")


@query("SELECT CASE WHEN ord % 3 = 0 THEN 2 ELSE 0 END AS n_versions, count(*) AS n FROM cards GROUP BY 1")
def version_counts(spark, sf):
    refs = F.when(F.col("ord") % 3 == 0, F.array(F.lit("kb/open-systems-2024/x"), F.lit("open-systems-2023 and open-systems-2024"))).otherwise(F.array(F.lit("open-systems-1999")))
    return S.tally(load(spark, sf, "cards").select(F.size(K.derived_versions(refs)).alias("n_versions")), "n_versions")


@query("""
WITH t AS (SELECT ['emitted', 'skipped', 'preserved', 'cached', 'held', 'failed', 'lost'][(ticket_id % 41) % 7 + 1] AS o FROM tickets), c AS (SELECT count(*) AS fetched, count(*) FILTER (o = 'emitted') AS emitted, count(*) FILTER (o = 'skipped') AS skipped,
  count(*) FILTER (o = 'preserved') AS preserved, count(*) FILTER (o = 'cached') AS cached, count(*) FILTER (o = 'held') AS held, count(*) FILTER (o = 'failed') AS failed FROM t)
SELECT *, emitted + skipped + preserved + cached + held + failed = fetched AS balanced FROM c""")
def run_totals(spark, sf):
    t = load(spark, sf, "tickets")
    kinds = F.array(*map(F.lit, ("emitted", "skipped", "preserved", "cached", "held", "failed", "lost")))
    return S.run_totals(t.select(F.element_at(kinds, (F.col("ticket_id") % 41 % 7 + 1).cast("int")).alias("outcome")), t.count())


@query(None)
def scrub_personal_data(spark, sf):
    """Phone patterns look around, which DuckDB's expressions cannot: tested against Python."""
    docs = load(spark, sf, "documents")
    return docs.select("doc_id", T.scrub("text").alias("scrubbed"), F.array_join(T.leak_kinds("text"), ",").alias("kinds")).where("kinds <> ''")


@query(r"""
WITH s AS (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?m)^\s*Page \d+ of \d+\s*$', '', 'g'), '(?mi)^\s*(©|\(c\)|Copyright).*\d{4}.*$', '', 'g'), '(?mi)^.*All Rights Reserved.*$', '', 'g'), '(?m)^\.{3,}\d+$', '', 'g') AS t FROM documents)
SELECT doc_id, length(text)::INT AS before, length(regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g'))::INT AS after FROM s""")
def strip_boilerplate(spark, sf):
    return load(spark, sf, "documents").select("doc_id", F.length("text").alias("before"), F.length(T.strip_boilerplate("text")).alias("after"))


@query(r"""
SELECT page_id, CASE WHEN n >= 100 THEN 'text' WHEN img >= 0.5 THEN 'vision' ELSE 'text' END AS tier FROM (
  SELECT page_id, length(regexp_replace(html, '<[^>]*>', '', 'g')) / 20e0 AS n, (page_id % 3) / 2e0 AS img FROM pages)""")
def route_tiers(spark, sf):
    return load(spark, sf, "pages").select("page_id", T.tier(F.length(F.regexp_replace("html", "<[^>]*>", "")) / F.lit(20.0), (F.col("page_id") % 3) / F.lit(2.0)).alias("tier"))


from quillwort.plans import cards, ddl  # noqa: E402, F401  they register their queries
