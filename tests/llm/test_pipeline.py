"""Stages of corpus_pipeline against brute force, with null, repeated and empty rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from quillwort.llm import near_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)], SCHEMA)


def shingles(text):
    w = [x.decode("utf-8") for x in (text or "").encode().lower().split()]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def components(texts):
    """The component of each text by comparing all pairs."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def near_copies(rng, n=70):
    """Texts with edited copies on both sides of 0.8, chains of copies, and a passage that all of them share."""
    words = [f"w{k}é" for k in range(300)]
    shared = " ".join(rng.choice(words) for _ in range(15))
    texts = []
    for _ in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(3, 150))]
        for _ in range(rng.randrange(1, 6)):
            texts.append(" ".join(w) + " " + shared * (len(w) > 60))
            w = list(w)
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(words)
    return texts


@pytest.mark.parametrize("often", [3, 10**9])
def test_near_dedup_brute_force(spark, monkeypatch, often):
    monkeypatch.setattr(near_dedup, "OFTEN", often)
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 0 if often > 3 else 10**6)
    monkeypatch.setattr(near_dedup, "GROUP", 2 if often > 3 else 100)
    rng = random.Random(11)
    texts = near_copies(rng) + ["", None, "  \n", "a b c", "A b  c", "a b d"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    group = components(texts)
    want = {min(i for (i, _), h in zip(rows, group) if h == g) for g in group}
    got = [r["doc_id"] for r in P.drop_near_copies(spark, docs(spark, rows), "").collect()]
    assert sorted(got) == sorted(want)
    # Of sets that differ, a good number are near copies: recall is not trivial here.
    assert sum(group[k] != k for k in range(len(texts))) > 40


def templated(rng, n):
    """Texts of 12 segments, each in one of two variants: every shingle stands in half of them, and linked texts differ in one segment."""
    segments = [[" ".join(f"s{k}v{v}x{rng.randrange(10**6)}" for _ in range(30)) for v in (0, 1)] for k in range(12)]
    picks = [[rng.randrange(2) for _ in range(12)] for _ in range(n)]
    return [" ".join(segments[k][v] for k, v in enumerate(p)) for p in picks]


@pytest.mark.parametrize(("n", "block"), [(400, 400), (900, 150)])
def test_near_dedup_loses_no_link_of_templated_texts(spark, monkeypatch, n, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = templated(random.Random(n), n)
    group = components(texts)
    assert len(set(group)) < 0.6 * n
    frame = docs(spark, list(enumerate(texts))).withColumn("tie", F.lit(5)).withColumn("sid", F.lit("x"))
    got = near_dedup.near_dedup(frame).select("doc_id", "tie", "sid").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(group)) and {(r["tie"], r["sid"]) for r in got} == {(5, "x")}


def test_parities_never_exceed_the_differing_shingles():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 1500)).astype(np.uint64))
        b = np.unique(np.r_[rng.permutation(a)[: rng.integers(0, len(a) + 1)], rng.integers(0, 2**63, rng.integers(0, 300)).astype(np.uint64)])
        least = near_dedup._unlike(None, [near_dedup.parities(a), near_dedup.parities(b)], np.array([0]), np.array([1]))[0]
        assert least <= len(np.setxor1d(a, b))


def test_shingles_are_counted_over_all_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SAMPLE", 10, raising=False)
    frame = docs(spark, [(k, f"a passage that all of them share x{k} y{k} z{k} u{k} v{k}") for k in range(120)] + [(None, None), (7, "")])
    for rows in (frame, frame.repartition(7)):
        n = near_dedup.frequent(rows)[1].tolist()
        assert sum(x >= 120 for x in n) == 3 and max(n) < 130
    assert not len(near_dedup.frequent(docs(spark, []))[1])


def test_pairs_of_large_groups_go_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PAIRS", 20)
    monkeypatch.setattr(near_dedup, "BLOCK", 50)
    texts = templated(random.Random(5), 300)
    got = near_dedup.near_dedup(docs(spark, list(enumerate(texts)))).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(components(texts)))


@pytest.mark.parametrize("nearest", [False, True])
def test_texts_with_many_shingles_in_common_meet_once(spark, monkeypatch, nearest):
    frame, made = type(spark.range(0)), spark.sparkContext.accumulator(0)
    plain = frame.mapInArrow

    def counting(self, func, schema):
        def counted(batches):
            for b in func(batches):
                made.add(b.num_rows)
                yield b

        return plain(self, counted, schema)

    monkeypatch.setattr(frame, "mapInArrow", counting)
    s = np.arange(100, dtype=np.uint64)
    sets = spark.createDataFrame([(k, 100, bytearray(near_dedup.parities(s))) for k in range(40)], "sid long, n int, bits binary")
    # Forty sets, thirty common shingles; each set lacks one of them.
    shared = near_dedup.shared_postings(spark.createDataFrame([(k, [t for t in range(30) if k % 30 != t]) for k in range(40)], "sid long, prefix array<long>"))
    roots = spark.createDataFrame([(k, k) for k in range(5)], "sid long, root long")
    got = {(r["a"], r["b"]) for r in near_dedup.crossing(sets, near_dedup.groups_of(shared), roots, nearest).collect()}
    assert got == ({(k, int(k == 0)) for k in range(40)} if nearest else {(a, b) for b in range(40) for a in range(b)})
    assert 0 < made.value <= 4 * len(got)


def test_parities_take_a_bit_a_shingle():
    rng = np.random.default_rng(7)
    a, b = (np.unique(rng.integers(0, 2**63, 800).astype(np.uint64)) for _ in range(2))
    assert len(near_dedup.parities(a)) == 128
    # Texts without a common shingle are still told apart: 9 times the differing bits exceed both sizes.
    assert 9 * near_dedup._unlike(None, [near_dedup.parities(a), near_dedup.parities(b)], np.array([0]), np.array([1]))[0] > len(a) + len(b)


def content(rows):
    return sorted(((r[0], r[1]) for r in rows), key=str)


def test_toxic_rows_do_not_take_their_namesakes_along(spark, tmp_path):
    rng = random.Random(1)
    good = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    clean = lambda: " ".join(rng.choices(good, k=30))
    toxic = lambda: " ".join(rng.choices(good, k=30) + rng.choices(["nastyword", "vilething", "scumbagged"], k=3))
    rows = [(k, toxic() if k % 3 == 0 else clean()) for k in range(900)]
    spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(900)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    more = [(None, clean()), (None, toxic()), (None, clean()), (None, None), (5000, clean()), (5000, toxic()), (5001, "")]
    got = content(P.drop_toxic(spark, docs(spark, rows + more), str(tmp_path)).where("doc_id is null or doc_id >= 5000").select("doc_id", "text").collect())
    assert got == content([more[0], more[2], more[3], more[4], more[6]])


def test_near_dedup_null_and_repeated_ids(spark):
    rng = random.Random(2)
    a, b, c, d = ([f"x{rng.randrange(999)}" for _ in range(60)] for _ in range(4))
    near = lambda t: " ".join([*t[:-1], "other"])
    text = lambda t: " ".join(t)
    rows = [(7, text(a)), (7, text(b)), (None, text(c)), (None, near(c)), (None, near(a)), (8, near(b)), (None, text(d)), (9, near(d)), (10, ""), (None, None), (7, text(a))]
    got = P.drop_near_copies(spark, docs(spark, rows), "").select("doc_id", "text").collect()
    by = {(i, "c" if (t or "").split()[:5] == c[:5] else t) for i, t in got}
    assert len(got) == 5 and by == {(7, text(a)), (7, text(b)), (None, "c"), (9, near(d)), (10, "")}


def test_cut_rows_keep_their_own_text(spark):
    rng = random.Random(3)
    passage, other = (" ".join(f"x{rng.randrange(99)}" for _ in range(30)) for _ in range(2))
    rows = [(1, f"one  {passage}"), (None, f"a {passage}"), (None, f"b {passage} tail"), (None, f"c  {other}"), (None, f"d {other}"), (None, None), (2, "two  words"), (2, f"again {passage}"), (3, "")]
    want = [(1, f"one  {passage}"), (None, "a"), (None, "b tail"), (None, f"c  {other}"), (None, "d"), (None, None), (2, "two  words"), (2, "again"), (3, "")]
    got = P.drop_repeated_passages(spark, docs(spark, rows), "").collect()
    assert content(got) == content(want)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) and r["lang"] == "en" for r in got)
    assert {r["text"]: r["source"] for r in got if r["doc_id"] is None} == {t: f"s{k % 3}" for k, (i, t) in enumerate(want) if i is None}


def test_contaminated_rows_do_not_take_their_namesakes_along(spark, tmp_path):
    item = " ".join(f"k{k}" for k in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"a {item}"), (None, "clean"), (1, item), (1, "clean too"), (None, None), (2, "")]
    got = P.drop_contaminated(spark, docs(spark, rows), str(tmp_path)).select("doc_id", "text").collect()
    assert content(got) == content([rows[1], rows[3], rows[4], rows[5]])


def test_near_dedup_spares_the_driver(spark):
    """Few jobs on small tables, whose every job takes memory of the driver; broadcasts are Spark's own again afterwards."""
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words[k:] + [f"x{k}"] * 10) for k in range(0, 30, 3) for _ in range(2)] + [" ".join(f"y{k}{j}" for j in range(40)) for k in range(10)]
    name, group = "spark.sql.autoBroadcastJoinThreshold", "spared"
    before = spark.conf.get(name)
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = near_dedup.near_dedup(docs(spark, list(enumerate(texts)))).select("doc_id").collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r["doc_id"] for r in got) == sorted(set(components(texts)))
    assert spark.conf.get(name) == before
    assert jobs <= 140
