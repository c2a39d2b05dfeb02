import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quillwort.functions import cards as K
from quillwort.functions import text as T
from quillwort.operators import curation as C
from quillwort.operators import ledger as L
from quillwort.operators import retrieval as R
from quillwort.operators import schema as S
from quillwort.plans import ORACLE_SQL, QUERIES
from quillwort.sources.views import BASE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in BASE:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(pdf):
    cols = sorted(pdf.columns)
    plain = lambda v: None if pd.isna(v) else float(v) if isinstance(v, (int, float)) or hasattr(v, "item") else str(v)
    return cols, sorted((tuple(map(plain, r)) for r in pdf[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(ORACLE_SQL[name]).df())


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_scrub_and_leaks(spark):
    d = spark.createDataFrame([("mail a.b@c.org now",), ("call +1 555 010 9999 ok",), ("id 8001015009087 here",), ("id 8013015009087 here",), ("nothing",), (None,)], "t string")
    got = d.select(T.scrub("t"), F.array_join(T.leak_kinds("t"), ",")).collect()
    assert got[0][0] == "mail [email] now" and got[0][1] == "email"
    assert "[phone]" in got[1][0] and got[1][1] == "phone"
    assert got[2][0] == "id [id] here" and got[2][1] == "id"
    assert "[id]" not in got[3][0]
    assert got[4] == ("nothing", "") and got[5][0] is None


def test_scrub_query_equals_python(spark):
    got = {r["doc_id"]: r["kinds"] for r in QUERIES["scrub_personal_data"](spark, SF).collect()}
    phone, email = re.compile(T.PHONE, re.A), re.compile(T.EMAIL)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    for kind, p in (("email", email), ("phone", phone)):
        assert {i for i, k in got.items() if kind in k.split(",")} == {r["doc_id"] for r in docs if p.search(r["text"])}


def test_slugs_and_formats(spark):
    d = spark.createDataFrame([(1, "P", "a b"), (2, "p", "A-B"), (3, "p", "c")], "pos int, product string, name string")
    assert [r["slug"] for r in C.assign_slugs(d).orderBy("pos").collect()] == ["p-a-b", "p-a-b-2", "p-c"]
    f = spark.createDataFrame([(1, "x", "doc"), (2, "x", "docx"), (3, "x", "xsd"), (4, "y", "doc")], "pos int, stem string, ext string")
    assert {r["pos"]: r["kept"] for r in C.format_variants(f).collect()} == {1: False, 2: True, 3: True, 4: True}


def test_rejected_ticket_does_not_make_a_duplicate(spark):
    t = spark.createDataFrame([(1, "c", "s", "d", 10, 1), (2, "c", "s", "d", 500, 1), (3, "c", "s", "d", 500, 1)], "ticket_id int, client string, subject string, description string, thread_chars int, n_agent int")
    assert {r["ticket_id"]: r["verdict"] for r in C.ticket_verdicts(t).collect()} == {1: "thin-content", 2: "keep", 3: "duplicate"}


def test_bundle_guards(spark):
    cards = spark.createDataFrame([("a", "new", "concept", None), ("b", "old", "concept", None), ("c", "new", "concept", None), ("d", None, "concept", None), ("m", "new", "memory", "x")], "card_id string, regime string, type string, client string")
    edges = spark.createDataFrame([("a", "b", 0), ("a", "c", 1), ("a", "m", 2), ("c", "d", 0), ("c", "a", 1)], "src string, dst string, pos int")
    ask = spark.createDataFrame([(1, "a", 0), (1, "a", 1)], "request_id int, seed string, seed_pos int")
    got = [(r["card_id"], r["place"]) for r in R.resolve_bundles(ask, cards, edges, depth=2).orderBy("place").collect()]
    assert got == [("a", 1), ("c", 2), ("d", 3)]


def slow_bundle(ids, cards, related, depth, max_cards, max_chars, client):
    """Breadth first by hand: cards is id to (regime, client, size)."""
    visible = lambda c: c in cards and cards[c][1] in (None, client)
    frontier = [c for c in dict.fromkeys(ids) if visible(c)]
    seen, chosen, dropped = set(frontier), [], []
    for level in range(depth + 1):
        following = []
        for c in frontier:
            if len(chosen) == max_cards:
                dropped.append(c)
                continue
            chosen.append(c)
            for d in related.get(c, ()) if level < depth else ():
                clash = visible(d) and cards[c][0] and cards[d][0] and cards[c][0] != cards[d][0]
                if d not in seen and visible(d) and not clash:
                    seen.add(d)
                    following.append(d)
        frontier = following
    kept, used = [], 0
    for c in chosen:
        if kept and max_chars is not None and used + cards[c][2] > max_chars:
            dropped.append(c)
        else:
            kept.append(c)
            used += cards[c][2]
    return kept, dropped, used


@pytest.mark.parametrize("depth,most,chars,client", [(2, 8, None, None), (2, 4, 60, "x"), (1, 3, 30, "y"), (3, 6, 5, None)])
def test_bundles_equal_breadth_first_by_hand(spark, depth, most, chars, client):
    rng = random.Random(depth)
    ids = [f"c{k}" for k in range(30)]
    cards = {c: (rng.choice(["new", "old", None]), rng.choice([None, None, None, "x", "y"]), rng.randrange(1, 40)) for c in ids}
    related = {c: rng.sample(ids, rng.randrange(0, 6)) + ["gone"] for c in ids}
    asked = {k: rng.choices(ids, k=rng.randrange(1, 4)) for k in range(25)}
    rows = [(c, r, "memory" if o else "concept", o, n, None, None, k) for k, (c, (r, o, n)) in enumerate(cards.items())]
    d = spark.createDataFrame(rows + [("fix1", None, "correction", None, 9, "c1", "approved", 90), ("fix0", None, "correction", None, 9, "c1", "approved", 91), ("fix2", None, "correction", None, 9, "c2", "draft", 92)], "card_id string, regime string, type string, client string, n_chars int, corrects string, status string, ord int")
    e = spark.createDataFrame([(c, x, k) for c, xs in related.items() for k, x in enumerate(xs)], "src string, dst string, pos int")
    q = spark.createDataFrame([(k, c, p) for k, cs in asked.items() for p, c in enumerate(cs)], "request_id int, seed string, seed_pos int")
    got = {r["request_id"]: r for r in R.budgeted_bundles(R.resolve_bundles(q, d, e, depth, most, client), d, most, chars).collect()}
    for k, seeds in asked.items():
        kept, dropped, used = slow_bundle(seeds, cards, related, depth, most, chars, client)
        assert (k in got) == bool(kept)
        if kept:
            r = got[k]
            assert (r["card_ids"], sorted(r["dropped"]), r["chars"]) == (kept, sorted(dropped), used)
            assert r["corrections"] == (["fix1", "fix0"] if "c1" in kept else [])


def test_links_count_raw_words(spark):
    """Words are tested before the fold, by the link list: "issue" and "error" count nothing, "ours" is no stop word folded."""
    d = spark.createDataFrame([("Issues with the user error in dock doors",), ("not our waves per wave",), (None,)], "t string")
    assert [sorted(r[0]) for r in d.select(T.link_tokens("t")).collect()] == [["dock", "door", "issue"], ["wave"], []]


def test_empty_parts_of_a_ticket_are_told_apart(spark):
    t = spark.createDataFrame([(1, "c", "x", None, 500, 1), (2, "c", None, "x", 500, 1), (3, None, "x", None, 500, 0)], "ticket_id int, client string, subject string, description string, thread_chars int, n_agent int")
    assert {r["ticket_id"]: r["verdict"] for r in C.ticket_verdicts(t).collect()} == {1: "keep", 2: "keep", 3: "no-diagnosis"}
    said = spark.createDataFrame([(1, "assistant", " Done. "), (1, "user", "it broke"), (2, "assistant", "thank you!"), (2, "assistant", "The cache was stale."), (3, "assistant", "  "), (3, "assistant", "\n\u3000\t\n"), (3, "assistant", "\n ok \n")], "ticket_id int, role string, body string")
    assert {r["ticket_id"]: r["n_solid"] for r in C.substantial_replies(said).collect()} == {1: 0, 2: 1, 3: 0}


def test_ledger_refuses_others(spark):
    log = spark.createDataFrame([(1, "open", 7, 1, None), (2, "status", 7, 2, "done"), (3, "entry", 7, 1, None), (4, "status", 7, 1, "resolved"), (5, "status", 8, 1, "done")], "seq int, op string, objective_id int, owner int, status string")
    assert [tuple(r) for r in L.objectives(log).collect()] == [(7, 1, "resolved", 1, 4)]
    assert L.refused(log.where("op = 'status'"), "status", L.STATUSES).count() == 0
    said = [(1, "open", "learn"), (2, "open", "work"), (3, "status", "active"), (4, "status", "parked"), (5, "entry", "finding"), (6, "entry", None), (7, "visibility", "public"), (8, "forget", None)]
    got = L.refusals(spark.createDataFrame(said, "seq int, op string, value string")).collect()
    assert {tuple(r) for r in got} == {(2, "mode", "work"), (4, "status", "parked"), (6, "kind", None), (7, "visibility", "public")}


def test_model_replies_however_written(spark):
    replies = {
        '```json\nnothing\n``` {"probability": 0.12345678}': 0.12345678, '<THINK>{"probability": 0.9}</THINK>{"probability": "0.25"}': 0.25, '{"probability": 1e-2}': 0.01, '{"probability": NaN}': 1.0, '{"probability": "nan"}': 1.0,
        '{"probability": 7}': 1.0, '{"probability": -3}': 0.0, '{"probability": true}': 1.0, '{"probability": "high"}': 1.0, "no": 1.0, '```\n{"probability": 0.5}\n``` and {"probability": 0.7}': 0.5,
    }
    d = spark.createDataFrame([(r,) for r in replies], "r string")
    assert {r["r"]: r["p"] for r in d.select("r", K.probability("r").alias("p")).collect()} == replies
    lists = {'so: ["a", 1] and so on': '["a", 1]', '```json\n[{"x": 1}]\n``` [2]': '[{"x": 1}]', "[1": None, "{}": None}
    d = spark.createDataFrame([(r,) for r in lists], "r string")
    assert {r["r"]: r["p"] for r in d.select("r", K.json_part("r", "[]").alias("p")).collect()} == lists


@pytest.mark.parametrize("block", [1000, 3])
def test_conflicts_of_live_memories_are_made_once(spark, block):
    rng = random.Random(block)
    held = [(f"m{k}", rng.choice(["c1", "c2", None]), rng.choice(["approved", "approved", "draft"])) for k in range(60)]
    marks = [(c, m) for c, _, _ in held for m in ["hot"] * rng.randrange(2) + [f"t{rng.randrange(12)}" for _ in range(rng.randrange(4))] + [None]]
    old = [(f"m{k}", f"m{k + 1}") for k in range(0, 58, 9)] + [("m3", "m999")]
    by = {c: (client, status) for c, client, status in held}
    gone = {b for a, b in old if b in by and by[a][1] == "approved" and by[a][0] == by[b][0]}
    live = [c for c, _, status in held if status == "approved" and c not in gone]
    own = {c: {m for d, m in marks if d == c and m} for c in live}
    want = sorted((by[a][0] or "", *sorted((a, b))) for k, a in enumerate(live) for b in live[:k] if by[a][0] == by[b][0] and own[a] & own[b])
    m = spark.createDataFrame(held, "card_id string, client string, status string")
    kept = C.live_memories(m, spark.createDataFrame(old, "card_id string, old string"))
    assert sorted(r["card_id"] for r in kept.collect()) == sorted(live)
    got = C.conflict_candidates(kept.select("card_id", "client"), spark.createDataFrame(marks, "card_id string, mark string"), block)
    assert sorted((r["client"] or "", r["a"], r["b"]) for r in got.collect()) == want


def test_sequence_names_and_hints(spark):
    d = spark.createDataFrame([("ORDERS_SEQ",), ("SEQ_ORDERS",), ("ORDERS_SEQUENCE",), ("PLAIN",), ("orders_seq",)], "n string")
    assert [r[0] for r in d.select(K.stripped_affix("n")).collect()] == ["ORDERS", "ORDERS", "ORDERS", "PLAIN", "ORDERS"]
    h = spark.createDataFrame([(["Shared", "WMS", "wms", "v9.2", "2024"],), ([],)], "s array<string>").select(K.folder_hints("s", {"wms": "W"}, {}).alias("h")).collect()
    assert [tuple(r["h"]) for r in h] == [("W", "9.2", None, "wms"), (None, None, None, None)]


def test_front_matter(spark):
    d = spark.createDataFrame([("---\ntitle: a --- b\n---\nbody",), ("no",)], "t string")
    assert [r[0] for r in d.select(T.front_matter("t")).collect()] == ["title: a --- b", ""]


def test_sequence_owner_precedence(spark):
    tables = spark.createDataFrame([("ROUTE_PLAN_LEG", 0), ("ROUTE", 1), ("Order_Line", 2), ("ORDER_ITEM", 3), ("X_FOO", 4), ("AB1", 6), ("AB2", 5)], "tab string, pos int")
    names = spark.createDataFrame([("ROUTE_SEQ",), ("ROUTE_PLAN_SEQ",), ("ROUTE_9_SEQ",), ("ORDER_SEQ",), ("X_Y_SEQ",), ("AB_SEQ",), ("_SEQ",), ("NONE_SEQ",), ("route_seq",), (None,)], "name string")
    got = {r["name"]: r["owner"] for r in S.sequence_owners(names, tables).collect()}
    # An exact name beats longer ones; of equal lengths the first table; X_FOO is no start of X_Y.
    want = {"ROUTE_SEQ": "ROUTE", "ROUTE_PLAN_SEQ": "ROUTE_PLAN_LEG", "ROUTE_9_SEQ": "ROUTE", "ORDER_SEQ": "Order_Line", "X_Y_SEQ": None, "AB_SEQ": "AB2", "_SEQ": None, "NONE_SEQ": None, "route_seq": "ROUTE", None: None}
    assert got == want


def test_units_of_two_dialects(spark):
    o = spark.createDataFrame([("a", "x  y"), ("b", "x"), ("c", None)], "name string, body string")
    d = spark.createDataFrame([("a", " x\ny "), ("b", "z"), ("e", "w")], "name string, body string")
    assert {tuple(r) for r in S.reconciled_units(o, d).collect()} == {("a", "oracle,db2", "x  y", ""), ("b", "oracle,db2", "x", "z"), ("c", "oracle", "", ""), ("e", "db2", "", "w")}
    assert S.reconciled_units(o.limit(0), d.limit(0)).count() == 0
    u = spark.createDataFrame([("p", "package", True, "b"), ("p", "package", False, "s"), ("q", "package", True, "b"), ("q", "package", True, " b "), ("r", None, False, "a"), ("r", "procedure", False, None), ("s", "procedure", False, "k")], "name string, kind string, is_body boolean, body string")
    assert {tuple(r) for r in S.repeated_units(u).collect()} == {("q", 2, "identical"), ("r", 2, "differs in body")}


def test_run_totals_of_no_rows(spark):
    none = spark.createDataFrame([], "outcome string")
    assert S.run_totals(none, 0).first()["balanced"] and not S.run_totals(none, 1).first()["balanced"]
