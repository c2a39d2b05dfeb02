import hashlib
import random
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quillwort.llm import ORACLE_SQL, QUERIES
from quillwort.llm import decontamination, fingerprint, license_scan, mixing, quality, simhash, substring_dedup, suffix_dedup, toxicity, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, chunk long, fp long, size long, h string, score double"


def docs(spark, rows):
    """Documents, with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, s, None, None, 7, 7, 7, "h", 0.5) for i, t, s in rows], SCHEMA)


def edge_rows():
    rng = random.Random(5)
    words = [f"w{k}é" for k in range(40)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 90))), f"s{k % 3}") for k in range(30)]
    rows += [(40 + k, f"x{k} {passage} y{k} tail", None) for k in range(6)] + [(60, "a " * 100, "s0"), (61, "a b " * 40, "s1"), (62, None, None), (63, "", "s0"), (None, passage, "s1"), (64, passage, "s2"), (64, passage, "s2"), (65, "Under the MIT License.", "s1")]
    return rows


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def table(pdf):
    cols = sorted(pdf.columns)
    plain = lambda v: None if pd.isna(v) else float(v) if isinstance(v, (int, float)) or hasattr(v, "item") else str(v)
    return cols, sorted((tuple(map(plain, r)) for r in pdf[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert table(QUERIES[name](spark, SF).toPandas()) == table(duck.sql(ORACLE_SQL[name]).df())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))


@pytest.mark.parametrize("rows_per_chunk", [4, 1000])
def test_substring_dedup_brute_force(spark, rows_per_chunk):
    rows, seen, want = edge_rows(), set(), []
    for i, t, _ in in_order(rows):
        w = (t or "").split()
        gone = set()
        for k in range(len(w) - 19):
            s = tuple(w[k : k + 20])
            gone.update(range(k, k + 20)) if s in seen else seen.add(s)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = [tuple(r) for r in substring_dedup.substring_dedup(docs(spark, rows), rows_per_chunk).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rows_per_chunk", [4, 1000])
def test_suffix_dedup_brute_force(spark, rows_per_chunk):
    rows = edge_rows()
    first, want = {}, []
    rank = {i: k for k, i in enumerate(dict.fromkeys(r[0] for r in in_order(rows)))}
    for i, t, _ in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], 10**9), rank[i])
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < rank[i]:
                gone[k : k + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.suffix_dedup(docs(spark, rows), rows_per_chunk, with_text=False).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("in_a_partition", [simhash.LINKS, 20])
def test_simhash_links_and_components(spark, monkeypatch, in_a_partition):
    monkeypatch.setattr(simhash, "LINKS", in_a_partition)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 40, np.uint64)
    near = [int(b) ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in rng.integers(0, 64, (12, 2))]
    chain = [0]
    for k in range(0, 40, 2):
        chain.append(chain[-1] ^ (3 << k))
    fps = np.array(sorted({*map(int, base), *near, *chain}), np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    d = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    checked = simhash.links(simhash.pivot_table(d)).cache()
    signed = fps.view(np.int64).tolist()
    near = {(min(signed[i], signed[j]), max(signed[i], signed[j])) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2).tolist() if i < j}
    assert sorted(map(tuple, checked.collect())) == sorted(near)
    got = {r["fp"]: r["root"] for r in simhash.components(checked).collect()}
    groups = {}
    for i, x in enumerate(fps.view(np.int64).tolist()):
        groups.setdefault(find(i), set()).add(x)
    want = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
    assert got == want


def test_pivot_coordinates_tell_the_bits():
    """Of any two bytes, the eight coordinates of a band differ: equal coordinates mean equal bits."""
    words = simhash.PIVOTS[1:9]
    assert len({tuple(bin(x ^ w).count("1") - bin(x).count("1") for w in words) for x in range(256)}) == 256
    assert len(simhash.PIVOTS) == 65


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({k: " " for k in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum((2 * sum(h >> bit & 1 for h in hs) > len(hs)) << bit for bit in range(64))


def test_simhash_query_brute_force(spark):
    """Shingles, bits, links and components of whole rows, with null, empty, short, long and repeated ones."""
    rows = edge_rows() + [(70, "One  two\tTHREE four five six seven", "s"), (71, "one two three four five six seven", "s"), (72, "É é", "s"), (73, "x y " * 20_000, "s")]
    fp = [slow_fingerprint(t) for _, t, _ in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(fp[i] ^ fp[j]).count("1") <= 2 and root[i] > root[j]:
                    root[i], changed = root[j], True
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    want = sorted(((rows[i][0], f"{fp[i]:016x}", least[root[i]]) for i in range(len(rows))), key=str)
    got = [(r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in simhash.simhash_groups(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == want


def test_simhash_edges(spark):
    got = simhash.simhash_groups(docs(spark, edge_rows())).collect()
    assert len(got) == len(edge_rows())
    empty = {i for i, t, _ in edge_rows() if not (t or "").split()}
    assert {(r["fp"], r["component_id"]) for r in got if r["doc_id"] in empty} == {(0, min(empty))}


def test_masks_miss_no_overlap():
    for missing in combinations(range(decontamination.WINDOW), decontamination.WINDOW - decontamination.NEED):
        assert any(not {s + o for o in m} & set(missing) for m in decontamination.MASKS for s in range(decontamination.WINDOW - m[-1]))


def test_decontamination_edges(spark, monkeypatch):
    item = " ".join(f"k{k}" for k in range(20))
    changed = item.replace("k3 ", "zz ").replace("k9 ", "zz ")
    rows = [(1, f"start {item} end", "s"), (2, f"a b c {changed} d", "s"), (3, "k0 k1 k2 k3 other words entirely", "s"), (4, None, "s"), (5, "short one", "s"), (None, item, "s")]
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (10, "short one"), (11, "")], "item_id long, text string")
    for limit in (1_000_000, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", limit)
        got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs(spark, rows), bench).collect()}
        assert got == {(1, 7), (2, 7), (5, 10), (None, 7)}
    clash = docs(spark, rows).withColumn("_tie", F.lit(1)).withColumn("tie", F.lit(2))
    kept = decontamination.decontaminate(clash, bench)
    assert kept.columns == clash.columns and {(r["doc_id"], r["_tie"], r["tie"]) for r in kept.collect()} == {(3, 1, 2), (4, 1, 2)}


def test_fingerprint_algebra_and_order(spark):
    d = spark.createDataFrame([(1, "p one two three\nq four five six"), (2, "q four five six\np one two three"), (3, "p one two three"), (4, "q four five six"), (5, "unrelated words stand here")], "k long, t string")
    f = fingerprint.fingerprinted(d, ["k"], "t")
    v = {r["k"]: r["v"] for r in f.collect()}
    assert v[1] == v[2] != v[3]
    pair = f.where("k = 3").selectExpr("v as a").crossJoin(f.where("k = 4").selectExpr("v as b")).crossJoin(f.where("k = 1").selectExpr("v as c"))
    r = pair.select(fingerprint.inserted("a", "b").alias("sum"), fingerprint.deleted("c", "b").alias("rest"), fingerprint.likeness("a", "b").alias("far"), fingerprint.likeness("a", "c").alias("near")).first()
    assert r["sum"] == v[1] and r["rest"] == v[3] and r["far"] < 0.35 < r["near"]


@pytest.mark.parametrize("rows_per_chunk", [3, 1000])
def test_fingerprint_query_brute_force(spark, rows_per_chunk):
    rows = [r for r in edge_rows() if r[0] is not None]
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    want = []
    for k, (i, t, _) in enumerate(order):
        t, n = t or "", len(t or "")
        x = order[(k + 1) % len(order)][1] or ""
        want.append((i, n, hashlib.sha256((t[: n - n // 3] + x[: n // 3]).encode()).hexdigest()))
    got = fingerprint.edited_fingerprints(docs(spark, rows), rows_per_chunk).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_license_lookup_by_any_rarity(spark):
    """The ranking of a file's rare words changes no result: every place by brute force, for several made-up frequencies."""
    rng = random.Random(3)
    plain = license_scan.Index({})
    vocabulary = sorted(plain.postings)
    for trial in range(40):
        words = [rng.choice(vocabulary) for _ in range(60)]
        for _ in range(3):
            body = plain.templates[rng.randrange(len(plain.templates))][1]
            at = rng.randrange(60)
            words[at:at] = [w if rng.random() > 0.02 else "x" for w in body]
        found = license_scan.Index({w: rng.randrange(100) for w in vocabulary}).starts(words)
        for n, (_, _, keys, _) in enumerate(plain.templates):
            true = {k for k in range(-60, len(words)) if all(k + at >= 0 and words[k + at : k + at + len(p)] == p for at, p in keys)}
            assert true <= found.get(n, set())
        assert len({plain.scan(" ".join(words)), license_scan.Index({w: rng.randrange(9) for w in vocabulary}).scan(" ".join(words))}) == 1
    whole = " ".join(plain.templates[3][1])
    assert plain.scan(whole)[5:] == ("mit", 1.0) and plain.scan("")[1:] == (0, None, None, "", "", 0.0)
    assert plain.scan(None) == plain.scan("") and plain.scan("under the mit license " * 30000)[1] == 30000


def test_license_edges(spark):
    got = {r["doc_id"]: r for r in license_scan.license_scan(docs(spark, edge_rows())).collect()}
    assert (got[65]["n_base"], got[65]["first_word"], got[65]["base_labels"], got[65]["score"]) == (1, 0, "mit", 1.0)
    assert (got[62]["n_words"], got[62]["labels"], got[62]["first_word"]) == (0, "", None)
    far = [(1, "X Under The MIT license, under the mit-LICENSE. GNU General Public License, version 3", "s")]
    r = license_scan.license_scan(docs(spark, far)).first()
    assert (r["n_base"], r["first_word"], r["last_word"], r["labels"]) == (2, 1, 5, "gpl-3,mit")


def test_mix_edges(spark):
    got = mixing.mix(docs(spark, edge_rows()), block=7).collect()
    assert len(got) == len(edge_rows())
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    for rs in by.values():
        assert sum(r["taken"] for r in rs) == int(rs[0]["target"])


def test_golden_points_and_prefixes(spark):
    """Slots are golden-ratio points in exact integers, far out too; every prefix of the mix holds each source in near its share."""
    ks = [1, 2, 7_000_000_001, 2**38 - 1]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in ks], "k long").select(mixing.golden(F.col("k"))).collect()]
    assert got == [k * mixing.GOLDEN % 2**48 for k in ks]
    quota = {0: 300, 1: 50, 2: 0, 3: 120}
    rows = mixing.schedule(spark, spark.createDataFrame(list(quota.items()), "sid long, quota long")).collect()
    by = {s: sorted((r["slot"], r["rank"]) for r in rows if r["sid"] == s) for s in quota}
    assert all([k for _, k in by[s]] == list(range(q)) for s, q in quota.items())
    order = sorted((r["slot"], r["sid"]) for r in rows)
    total, most = sum(quota.values()), 0.0
    for s, q in quota.items():
        seen = 0
        for n, (_, sid) in enumerate(order[: 2 * total // 3], 1):
            seen += sid == s
            most = max(most, abs(seen - n * q / total))
    assert most < 4
    shuffled = random.Random(0).sample(order, len(order))
    seen = np.cumsum([sid == 0 for _, sid in shuffled]) - np.arange(1, total + 1) * quota[0] / total
    assert np.abs(seen).max() > 4


def test_mixture_covers_what_is_taken(spark):
    """Pieces of the mix: each word range of a document at most twice, ties of doc_id with unlike sizes included."""
    rows = edge_rows() + [(5, "one two three", "s0"), (5, "one", "s0"), (5, None, "s0")]
    placed = mixing.placed_documents(docs(spark, rows))
    pieces = mixing.mixture(placed, block=7).collect()
    size = {r["row"]: r["size"] for r in placed.collect()}
    used = {}
    for r in pieces:
        assert 0 <= r["start"] and r["start"] + r["words"] <= size[r["row"]]
        for k in range(r["start"], r["start"] + r["words"]):
            used[r["row"], k] = used.get((r["row"], k), 0) + 1
    assert max(used.values()) <= mixing.REPEATS
    assert sum(used.values()) == sum(r["taken"] for r in mixing.mix(docs(spark, rows), block=7).collect())
    slots = {}
    for r in pieces:
        slots.setdefault(r["slot"], set()).add(r["sid"])
    assert all(len(s) == 1 for s in slots.values())


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "u", "same"), (2, "u", "same"), (3, None, None), (4, "http://x/\r\nInjected: 1", ""), (5, "u", "é" * 70000), (None, "u", "same"), (2, "u", "same")]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w")).collect()
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got) == sorted([("1", 4, "revisit", 2), ("2", 4, "response", None), ("2", 4, "response", None), ("None", 4, "revisit", 2), ("3", 0, "revisit", 4), ("4", 0, "response", None), ("5", 140000, "response", None)])
    assert {r["payload_digest"] for r in got if r["payload_bytes"] == 4} == {warc.digest(b"same")}


def test_long_records_are_read_in_linear_time():
    import os
    import time

    took = []
    for size in (4 << 20, 32 << 20):
        whole = warc.record(1, "u", os.urandom(size), None)
        began = time.perf_counter()
        ((_, body, _),) = warc.records(whole[i : i + 65_536] for i in range(0, len(whole), 65_536))
        took.append(time.perf_counter() - began)
        assert len(body) == size
    assert took[1] < 40 * took[0] + 0.5


def labelled_rows(n=900):
    rng = random.Random(1)
    good, bad = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)], ["nastyword", "vilething", "scumbagged"]
    return [(k, " ".join(rng.choices(good, k=30) + (rng.choices(bad, k=3) if k % 3 == 0 else [])), "s") for k in range(n)], rng


def labelled(spark, n=900):
    rows, _ = labelled_rows(n)
    return rows, spark.createDataFrame([(k, 1 - int(k % 3 == 0), int(k % 3 == 0)) for k in range(n)], "doc_id long, quality int, toxic int")


def test_toxicity_held_out_and_misspelt(spark):
    rows, labels = labelled(spark)
    extra = [(9000, "worda nastywordd wordb nastyw0rd vilethingg", "s"), (9001, None, "s"), (9002, "", "s"), (None, "plain", "s")]
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs(spark, rows + extra), labels).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 9000]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held]) > 0.95
    assert got[9000]["score"] >= toxicity.THRESHOLD > 0.5 > got[9001]["score"] and got[9001]["score"] == got[9002]["score"]


def test_toxicity_scores_by_a_slow_scorer(spark):
    """Word by word and n-gram by n-gram, with the dense embeddings of a small model."""
    rows, _ = labelled_rows()
    logit, bias = toxicity.train(spark.createDataFrame([(k, int(k % 3 == 0), t) for k, t, _ in rows[:300]], "doc_id long, y int, text string"))
    assert logit
    known = toxicity.WordLogits(logit)
    for text in ("", "worda nastyword wordb", "nastywordd nastyword x-y", "Wordc " * 400):
        words = toxicity.words_of(text)
        slow = bias
        for w in words:
            g = toxicity.grams(w)
            slow += sum(logit.get(x, 0.0) for x in g) / len(g) / (len(words) + toxicity.NEUTRAL)
        at, share = toxicity.bag(text)
        assert abs(slow - bias - sum(logit.get(int(a), 0.0) * float(v) for a, v in zip(at, share))) < 1e-4
        assert abs(slow - bias - sum(known[w] for w in words) / (len(words) + toxicity.NEUTRAL)) < 1e-9


def test_toxicity_repeated_rows_and_one_class(spark):
    rows, labels = labelled(spark, 300)
    one = labels.where("toxic = 0")
    got = toxicity.toxicity(docs(spark, rows[:20] + rows[:20]), one.unionByName(one)).collect()
    assert len(got) == 40 and len({r["score"] for r in got}) == 1 and got[0]["score"] < 0.5
    twice = toxicity.toxicity(docs(spark, rows + rows), labels.unionByName(labels)).collect()
    by = {}
    for r in twice:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(twice) == 600 and all(len(v) == 1 for v in by.values())


def test_quality_held_out(spark):
    rows, labels = labelled(spark)
    got = [r for r in quality.quality(docs(spark, rows + [(9001, None, "s"), (None, "x", "s")]), labels).collect()]
    held = [r for r in got if r["held_out"] and r["doc_id"] < 9000]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 != 0) for r in held]) > 0.85
    ids, x = quality.features("a B c. a | 1")
    v = np.random.default_rng(0).normal(size=(len(quality.STATISTICS) + quality.BUCKETS, 3))
    slow = sum(v[ids[i]] @ v[ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i))
    assert abs(quality.fm(ids, x, 0.0, np.zeros(len(v)), v) - slow) < 1e-9


@pytest.mark.parametrize("run", [
    lambda d, s: license_scan.license_scan(d), lambda d, s: substring_dedup.substring_dedup(d), lambda d, s: suffix_dedup.suffix_dedup(d), lambda d, s: simhash.simhash_groups(d), lambda d, s: mixing.mix(d),
    lambda d, s: fingerprint.edited_fingerprints(d), lambda d, s: toxicity.toxicity(d, s.createDataFrame([], "doc_id long, toxic int")), lambda d, s: quality.quality(d, s.createDataFrame([], "doc_id long, quality int")),
    lambda d, s: decontamination.contaminated(d, s.createDataFrame([], "item_id long, text string")),
])
def test_empty_tables(spark, run):
    assert run(docs(spark, []), spark).count() == 0


def test_empty_pages(spark, tmp_path):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w")).count() == 0


def test_triggers_do_not_depend_on_blocks(monkeypatch):
    """Chunks are hashed in blocks; a window of places across a block's edge is judged as any other."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(0, 700))) for _ in range(40)]
    c = suffix_dedup.Chunk(pa.table({"doc_id": pa.array(range(40), pa.int64()), "text": texts}))
    whole, at = c.triggers(), np.arange(0, len(c.x) - 49, 3)
    named = c.strings(at)
    for block in (1, 40, 977):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        assert all((a == b).all() for a, b in zip(whole, c.triggers(), strict=True))
        assert (named == c.strings(at)).all()
