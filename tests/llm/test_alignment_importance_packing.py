"""Operators 11 to 13 against brute force, with nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillwort.llm import alignment, importance, packing

ROWS = [
    (1, "Hello world, it's a test of 3 tokenizers."), (2, None), (3, ""), (4, " \n two  spaces\n\n and lines \n"), (5, "naïve café — 中文字 😀 Ⅳ ﬁ"), (6, "with ▁ inside"),
    (None, "Hello world, it's a test of 3 tokenizers."), (7, "<|endoftext|> <s> </s> <unk> <0x41>\x00\t\x85x"), (7, "<|endoftext|> <s> </s> <unk> <0x41>\x00\t\x85x"), (8, "the of and " * 4000), (9, "x" * 30000), (10, " "),
    *[(20 + k, f"a text of over twenty words number {k} that goes on and on with the same words and more words until it is long enough for a draw or two {'more ' * k}") for k in range(40)],
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    # Columns named as the operators' own must not matter.
    clash = {c: F.lit("clash") for c in ("chunk", "k", "a", "b", "score", "rank", "n_words", "length", "part", "at", "before", "piece")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(clash).repartition(3)


def plain(rows):
    return sorted(map(tuple, rows), key=str)


def aligned_slowly(rows):
    a_side = Tokenizer.from_file(alignment.TOKENIZER_A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=alignment.TOKENIZER_B)
    spelt = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in spelt} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in spelt)}
    counts, docs = collections.Counter(), []
    for doc, text in rows:
        groups, n = [], [0, 0]
        raw = (" " + (text or "")).encode()
        ids = a_side.encode(raw.decode(), add_special_tokens=False).ids, b_side.encode(text or "")
        parts = [bytes(byte_of[c] for c in a_side.id_to_token(i)) for i in ids[0]], [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if text and b"".join(parts[0]) == raw == b"".join(parts[1]):
            n = [len(ids[0]), len(ids[1])]
            ends = [np.cumsum([len(p) for p in side]) for side in parts]
            cuts = np.intersect1d(*ends)
            for lo, hi in zip(np.r_[0, cuts[:-1]], cuts):
                groups.append(tuple([i for i, e in zip(side, end) if lo < e <= hi] for side, end in zip(ids, ends)) if len(cuts) < 300 else tuple(np.array(side)[(end > lo) & (end <= hi)].tolist() for side, end in zip(ids, ends)))
        links = [(x, y) for g, h in groups for x in g for y in h]
        counts.update(set(links))
        docs.append((doc, *n, groups, links))
    highest = collections.Counter()
    for (x, _), c in counts.items():
        highest[x] = max(highest[x], c)
    text = lambda groups: ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
    return [(d, a, b, len(g), len(l), sum(counts[x] == highest[x[0]] for x in l), sum(counts[x] for x in l), hashlib.sha256(text(g).encode()).hexdigest() if g else "") for d, a, b, g, l in docs]


def test_alignment_equals_slow_alignment(spark, docs):
    got = alignment.align(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert plain(got.collect()) == plain(aligned_slowly(ROWS))
    assert alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0
    assert plain(alignment.align(spark.createDataFrame([(1, None), (2, "")], SCHEMA)).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_exchanges_no_tokens(spark, docs, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 500)
    plans, kept = [], alignment.kept

    def seen(df, *by):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, *by)

    monkeypatch.setattr(alignment, "kept", seen)
    assert plain(alignment.align(docs).collect()) == plain(aligned_slowly(ROWS))
    assert "FlatMapCoGroupsInArrow" in plans[-1]
    assert not re.search(r"Exchange hashpartitioning\(chunk", plans[-1])
    # Tokens are gone once they are aligned.
    folders, bucketed = [], alignment.bucketed
    monkeypatch.setattr(alignment, "bucketed", lambda *a: folders.append(bucketed(*a)) or folders[-1])
    # A chunk beyond the labels is a chunk of its own.
    monkeypatch.setattr(alignment, "labelled", lambda docs: ([0], {0: 0, 1: 1}))
    assert plain(alignment.align(docs).collect()) == plain(aligned_slowly(ROWS))
    assert not spark.catalog.tableExists(folders[0][0]) and not os.path.exists(folders[0][1].removeprefix("file:"))


def test_alignment_aligns_each_spell_of_the_corpus_once(spark, docs, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 500)
    seen, aligned = [], alignment.aligned
    monkeypatch.setattr(alignment, "aligned", lambda spells: seen.append(spells.select(F.sum(F.size("a"))).first()[0]) or aligned(spells))
    assert plain(alignment.align(docs).collect()) == plain(aligned_slowly(ROWS))
    known = alignment.Tokenizers(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    known.learn(sorted({s for r in docs.select("text").collect() for s in known.spells(r["text"])}))
    assert seen == [sum(len(t[0]) // 4 for t in known.values() if t)]


def test_spells_have_the_tokens_of_whole_texts():
    known = alignment.Tokenizers(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    r = random.Random(3)
    letters = [*"aB c\n\n  d9'é中文 \t\r\x0b\x85　.,<|>Σς́", "'s", "'ll", " the", "ing", "<s>", "<|endoftext|>", "\r\n"]
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(1, 14)))
        spells = known.spells(text)
        assert "".join(spells) == " " + text
        known.learn(spells)
        ids = [[t >> alignment.LENGTH for s in spells for t in np.frombuffer(known[s][side], np.int32).tolist()] for side in (0, 1)]
        assert ids == [known.a.encode(" " + text, add_special_tokens=False).ids, known.b.encode(text)]


def resampled_slowly(rows, target, longest, buckets, percent, least):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in rows], target))
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (s.total() + buckets) / ((s[k] + 1) * (t.total() + buckets))))
    out = []
    for doc, text in rows:
        n, f = features(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    draw = percent * len(able) // 100
    place = {id(r): k + 1 for k, r in enumerate(able[:draw])}
    return [(r[0], r[2], r[3], r[4], place.get(id(r))) for r in out]


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (3, 37), (2, 100)])
def test_resampling_equals_slow_resampling(spark, docs, longest, percent):
    target = ["the same words and more", None, "", "Hello, world"]
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.resample(docs, bench, longest=longest, percent=percent, buckets=997)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert plain(got.collect()) == plain(resampled_slowly(ROWS, target, longest, 997, percent, 20))


def test_resampling_of_empty_tables_and_empty_targets(spark, docs):
    none, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "text string")
    assert importance.resample(none, docs).count() == 0
    assert plain(importance.resample(docs, bench).collect()) == plain(resampled_slowly(ROWS, [], 1, 10_000, 10, 20))


def test_tries_are_folded_without_loss():
    trie = importance.Trie(3)
    words = [b"a", b"b", b"a", b"b", b"c"]
    got = collections.Counter(trie.crc[n] for n in trie.walk(words))
    assert got == collections.Counter(zlib.crc32(b" ".join(words[i : i + n])) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def fewest_bins(items, cap):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= cap and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def unpacked(packing_, cap):
    counts = [0] * (cap + 1)
    for pattern, bins in packing_:
        assert sum(length * run for length, run in pattern) <= cap
        for length, run in pattern:
            counts[length] += run * bins
    return counts


def test_bin_completion_is_optimal_on_small_inputs_and_keeps_every_piece():
    r = random.Random(5)
    for _ in range(150):
        cap = r.choice([20, 37, 100])
        items = sorted((r.randint(1, cap) for _ in range(r.randint(0, 11))), reverse=True)
        counts = [items.count(x) for x in range(cap + 1)]
        got = packing.bin_completion(counts)
        assert unpacked(got, cap) == counts
        assert packing.least_bins(np.array(counts)) <= sum(m for _, m in got) == fewest_bins(items, cap)


def test_branch_and_bound_improves_on_best_fit():
    # Best fit decreasing puts 6 and 5 first; two bins of 4 + 4 + 2 and 5 + 3 + 2 need no third one.
    r, better = random.Random(11), 0
    for _ in range(3000):
        cap = 60
        items = [r.choice([11, 13, 17, 19, 23, 29, 31]) for _ in range(r.randint(8, 14))]
        counts = [items.count(x) for x in range(cap + 1)]
        first, got = (sum(m for _, m in p) for p in (packing.best_fit(counts), packing.bin_completion(counts)))
        assert got <= first
        better += got < first
    assert better


def test_packing_equals_whole_text_encoding(spark, docs):
    rows = packing.pack(docs).collect()
    whole = Tokenizer.from_file(packing.TOKENIZER)
    want = []
    for doc, text in ROWS:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(doc, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048)]
    assert plain(tuple(r)[:5] for r in rows) == plain(want)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) == packing.least_bins(np.bincount([w[3] for w in want], minlength=2049))
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_remembered_runs_have_the_tokenizers_ids():
    known, r = packing._Encoded(packing.TOKENIZER), random.Random(1)
    letters = [*"aB cD9 0\n\t\x0b\x0c\r\x00\x1f\x7f.,;-_<|>éßİΣς́中文ǅ①½‍😀가가\xa0 ", "'s", "'VE", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
        runs = text.encode().split()
        known.learn(set(runs))
        assert np.frombuffer(b"".join(map(known.__getitem__, runs)), "<u4").tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


def test_runs_are_encoded_as_they_come_and_stay_right_when_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 7)
    monkeypatch.setattr(packing, "PARTS", 3)
    known, r = packing._Encoded(packing.TOKENIZER), random.Random(2)
    words = ["naïve", "ÜBER", "Hello", "İx", "a1", "it's", "<|endoftext|>", "中文", "é", "x.", "ǅa", "\x00", "ª", "Ⅳ", "ﬁ", "ʰa", "\u0345", "ⓐ", "𝔸"]
    for _ in range(300):
        text = " ".join(r.choice(words) + r.choice(["", ",", r.choice(words)]) for _ in range(20))
        assert np.frombuffer(b"".join(map(known.__getitem__, text.encode().split())), "<u4").tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(known) <= 7 and len(known.parts) <= 3


def test_forgotten_spells_leave_the_common_ones(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    known = alignment.Tokenizers(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    spells = known.spells("one two three four five")
    known.learn(spells)
    first = dict(list(known.items())[:3])
    known.forget()
    assert dict(known) == first and list(first) == spells[:3]
