"""What grows with the input: rounds, exchanges, candidates; results stay those of the plain way."""

import math
import random
import re
from collections import Counter

from quillwort.operators import curation as C
from quillwort.operators import retrieval as R
from quillwort.operators import scripts as P
from test_scripts import SAMPLE, slow_statements

ODD = (None, "", ";", "'open; \n;", "select 1", "a;b/*/;c", "create table t (a int, b int)  -- end", "/* ; */ create /* ' */ table x (y long raw not null) ; 'z", "comment on table t is 'a''b' ; alter table", "a" * 300_000 + " ;'" + "b;" * 200_000)


def scripts_of(spark, seed=4):
    rng = random.Random(seed)
    pieces = ["'", '"', "/*", "*/", "--", ";", "\n", "create ", "Table t", "(", ")", ",", " is ", "/", "-", "é", "\r", "''", "ıs", "as", "\n / \n", "or replace ", "procedure p"]
    texts = [SAMPLE, *ODD] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(90))) for _ in range(300)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "script_id int, sql string")


def kept(df):
    return df.localCheckpoint()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def rows(df):
    return sorted(map(repr, df.collect()))



def slow_cyclic(edges):
    live = set(edges)
    while True:
        alive = {a for a, _ in live}
        kept = {(a, b) for a, b in live if b in alive - {None}}
        if kept == live:
            return alive
        live = kept


def test_cycles_take_few_rounds_on_long_chains(spark):
    rounds = []

    def cut(df):
        rounds.append(1)
        return df.localCheckpoint()

    rng = random.Random(8)
    chain = [(f"a{k}", f"a{k + 1}") for k in range(700)]
    lead = [(f"b{k}", f"b{k + 1}") for k in range(400)] + [("b400", "b395"), ("a100", "b7")]
    tree = [(f"t{k}", f"t{k // 2}") for k in range(2, 300)] + [("loop", "loop"), ("loop", "t9"), (None, "loop"), ("x", None)]
    few = [(f"r{rng.randrange(60)}", f"r{rng.randrange(90)}") for _ in range(75)]
    for edges in (chain + lead + tree, few, few[:40] + few[:20], [("one", "two")], []):
        rounds.clear()
        got = {r["node"] for r in C.cyclic_nodes(spark.createDataFrame(edges, "src string, dst string"), cut).collect()}
        assert got == slow_cyclic(edges)
        assert len(rounds) <= 14


def test_statements_are_read_without_an_exchange(spark, monkeypatch):
    texts, scripts = scripts_of(spark)
    got = P.statements_of(scripts, kept)
    assert exchanges(got) == 0
    assert sorted(map(tuple, got.collect())) == sorted((k, *s) for k, x in enumerate(texts) for s in slow_statements(x or ""))
    begun = P.statements_of(scripts, kept, ("CREATE", "COMMENT"))
    assert rows(begun) == sorted(repr(r) for r in got.collect() if r["text"].upper().split()[0].split("(")[0] in ("CREATE", "COMMENT"))
    short = scripts.where("coalesce(length(sql), 0) < 9000")
    monkeypatch.setattr(P, "WHOLE", 40)
    assert rows(P.statements_of(short, kept)) == rows(got.join(short.select("script_id"), "script_id", "left_semi"))


def test_columns_attachments_and_units_are_read_without_an_exchange(spark, monkeypatch):
    texts, scripts = scripts_of(spark, 6)
    wide = "create table wide (" + ", ".join(f"c{k} varchar2({k}) not null" for k in range(300)) + "); alter table wide add foreign key (" + ", ".join(f"c{k}" for k in range(150)) + ") references x (" + ", ".join(f"d{k}" for k in range(150)) + ")"
    scripts = scripts.where("coalesce(length(sql), 0) < 9000").unionByName(spark.createDataFrame([(-1, wide)], scripts.schema))
    said, tokens = P.statements_of(scripts, kept), P.tokens(P.blocks_of(scripts)).localCheckpoint()
    plain = (P.table_columns(tokens), P.attachments(tokens), P.stored_units(tokens, scripts), P.unrecognized_units(tokens))
    in_row = (P.table_columns(said), P.attachments(said), P.stored_units_of(scripts, kept), P.unrecognized_units_of(scripts, kept))
    for got, want in zip(in_row, plain, strict=True):
        assert exchanges(got) == 0
        assert rows(got) == rows(want) != []
    assert in_row[0].where("script_id = -1 and not_null").count() == 300
    pairs = in_row[1].where("script_id = -1").first()["value"].split(",")
    assert pairs == [f"c{k}=d{k}" for k in range(150)]
    found, columns = P.attaching(said, kept, lambda v: v)
    assert rows(found) == rows(in_row[1]) and rows(columns) == rows(in_row[0].select("table_name", "name"))
    monkeypatch.setattr(P, "WHOLE", 40)
    assert rows(P.stored_units_of(scripts, kept)) == rows(in_row[2])
    assert rows(P.unrecognized_units_of(scripts, kept)) == rows(in_row[3])


def slow_links(entries, cards):
    df = Counter(w for ws in cards.values() for w in ws)
    idf = {w: math.log((len(cards) + 1) / (k + 1)) + 1 for w, k in df.items()}
    out = []
    for e, asked in entries.items():
        scored = [(-round(sum(idf[w] for w in ws & asked) / sum(idf[w] for w in ws), 6), c, len(ws & asked)) for c, ws in cards.items() if len(ws & asked) >= 2]
        out += [(e, c, n, -s, k) for k, (s, c, n) in enumerate(sorted(x for x in scored if -x[0] >= 0.30)[:3], 1)]
    return sorted(out)


def test_links_exchange_no_pairs(spark, monkeypatch):
    rng = random.Random(1)
    # A few common words, so that most entries meet most cards, and some of many words.
    draw = lambda k: {f"word{min(int(rng.expovariate(0.12)), 60):02d}" for _ in range(k)}
    cards = {f"p{k % 9}/{1000 + k}": draw(rng.choice((2, 4, 7, 30))) for k in range(120)}
    entries = {k: draw(rng.choice((0, 2, 5, 9, 40))) for k in range(90)}
    c = spark.createDataFrame([(k, "concept", " ".join(sorted(w))) for k, w in cards.items()] + [("p0/x", "issue", "word00")], "card_id string, type string, title string")
    e = spark.createDataFrame([(k, " ".join(w)) for k, w in entries.items()] + [(-1, None)], "entry_id long, query string")
    want = slow_links(entries, {k: w | {k.split("/")[1]} for k, w in cards.items()})
    got = R.suggest_links(e, c, checkpoint=kept)
    assert not re.search(r"hashpartitioning\(entry_id#\w+, card_id#", got._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, got.collect())) == want and len(want) > 150
    monkeypatch.setattr(R, "MOST_WORDS", 6)
    assert sorted(map(tuple, R.suggest_links(e, c).collect())) == want
