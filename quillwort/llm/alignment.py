"""Cross-tokenizer alignment as relational steps (operator 11).

Two tokenizers cut the same bytes, space + text.  Offsets where a token of both ends are cuts; cuts divide the tokens into groups; every A and B
token of a group are a link.

* Texts are dealt in *chunks* of about ``CHUNK`` characters.  No token of either vocabulary runs from a character that is not white space into
  a following space or newline, or from a Latin letter into an ASCII mark, and neither tokenizer looks back across such a place.  So a text is the sequence of its
  *spells*, cut there, and its tokens are theirs.  What is claimed of the vocabulary is checked when it is loaded.
* The corpus aligns each distinct spell once: a chunk sends its distinct spells, packed by *part* (a range of hashes), a part tokenizes those that its
  chunks sent, and what is aligned goes back to each of these chunks in a packed row.
* In Spark, for all spells: ``posexplode`` of the tokens of each side, windowed sums of their lengths give the ends, equi-joins
  on (part, spell, end) find the cuts, a running count of the cuts before a token is its group, and a join on (part, spell, group) brings
  each group's tokens together: their products are the links.  All of it reads a table that is
  bucketed by part, so the token arrays are not shuffled.
* A chunk counts how many of its documents hold each linked id pair; Spark adds the counts up by pair and takes the highest of each A id.  The
  counts go back to each chunk by a join on the pair, so a pair that every document holds travels once a chunk.

A document has no tokens, and zeros, if its text is null or empty or if its joined A or B bytes differ from space + text (a
literal U+2581 does that to B).  Null and repeated doc_ids: rows of their own.  Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
import string
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quillwort.llm.common import Key, numbers, planes, shared_dir, slices, table

TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_B = public_tokenizers.path("piece_bpe_32k.model")
#: Characters of texts in a chunk; a longer text is a chunk of its own.
CHUNK = 5 << 20
#: Spells in a row, and in a batch that a task gives to the tokenizers.
SPELLS, BATCH = 500, 4_000
#: Parts of the spells: a quarter of the number of chunks, but this many if there are as many chunks.
PARTS = 24
#: Spells whose tokens a worker keeps from chunk to chunk: the first ones it meets, which are the common ones.
REMEMBERED = 60_000
#: How packed rows are compressed.
ZSTD = pa.Codec("zstd", compression_level=5)
#: A token travels as id * 2**LENGTH + its length in bytes.
LENGTH = 12
#: Letters after which a mark of ASCII begins a spell, if no piece of the second vocabulary holds the two in a row.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SPACE = "▁"
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level spelling: bytes that print stand for themselves, the others for characters from U+0100 on.
_SPELT = {b: chr(b) for b in _VISIBLE} | {b: chr(0x100 + k) for k, b in enumerate(sorted({*range(256)} - {*_VISIBLE}))}
_BYTE_OF = {c: b for b, c in _SPELT.items()}


class Tokenizers(dict):
    """A spell to its tokens of both sides (packed ids and lengths, 32-bit), or None if a side's bytes are not the spell's."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        names = self.a.get_vocab()
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for t, i in names.items():
            self.bytes_a[i] = bytes(_BYTE_OF.get(c, 0) for c in t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.side_a, self.side_b = ((x, np.array([len(t) for t in x], np.int32)) for x in (self.bytes_a, self.bytes_b))
        self.word = re.compile(rf" ?[{LETTERS}]+\Z")
        self.spell = self._cut([p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))])

    @staticmethod
    def _cut(pieces: list[str]) -> re.Pattern:
        if any("\n" in p or re.search(rf"[^{_SPACE}]{_SPACE}", p) for p in pieces):
            raise ValueError("a piece of the second vocabulary runs into white space")
        marks = "".join(re.escape(c) for c in string.punctuation if not any(re.search(f"[{LETTERS}]{re.escape(c)}", p) for p in pieces))
        after = rf"(?![{marks}])" if marks else ""
        return re.compile(rf"\s*+(?:(?:[^\s{LETTERS}]++|[{LETTERS}]++{after})++(?:[^\S \n]\s*+)?+)*+(?:[{LETTERS}]++)?+")

    def spells(self, text: str | None) -> list[str]:
        return [s for s in self.spell.findall(" " + text) if s] if text else []

    def learn(self, spells: list[str]) -> None:
        new = [s for s in spells if s not in self]
        for k in range(0, len(new), BATCH):
            part = new[k : k + BATCH]
            raw = [s.encode() for s in part]
            packed = [self._packed(raw, ids, *side) for ids, side in ((self._ids_a(part, raw), self.side_a), (self._ids_b(part), self.side_b))]
            self.update((s, None if x is None or y is None else (x, y)) for s, x, y in zip(part, *packed))

    def forget(self) -> None:
        """Keeps the first ``REMEMBERED`` spells; a dict gives its room back only when it is cleared."""
        if len(self) > REMEMBERED:
            first = list(itertools.islice(self.items(), REMEMBERED))
            self.clear()
            self.update(first)

    def _ids_a(self, spells: list[str], raw: list[bytes]) -> list[list[int]]:
        """Letters, with or without a space before them, are one part to the tokenizer, so its vocabulary is asked at once."""
        other = [s for s in spells if not self.word.match(s)]
        whole = iter(self.a.encode_batch_fast(other, add_special_tokens=False))
        return [[t.id for t in self.a.model.tokenize(r.decode("latin-1").translate(_SPELT))] if self.word.match(s) else next(whole).ids for s, r in zip(spells, raw)]

    def _ids_b(self, spells: list[str]) -> list[list[int]]:
        # B puts a space before what it is given: that of a spell that has one; else a newline, with which nothing merges, goes between.
        ids = self.b.encode([s[1:] or "\n" if s[0] == " " else "\n" + s for s in spells], num_threads=1)
        return [y[:1] if s == " " else y if s[0] == " " else y[2:] for s, y in zip(spells, ids)]

    @staticmethod
    def _packed(raw: list[bytes], ids: list[list[int]], texts: list[bytes], lengths: np.ndarray) -> list[bytes | None]:
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32)
        blob, ends = (flat << LENGTH | lengths[flat]).tobytes(), (4 * np.cumsum([len(x) for x in ids])).tolist()
        out: list[bytes | None] = [blob[a:b] for a, b in zip([0, *ends], ends)]
        if b"".join(map(texts.__getitem__, flat.tolist())) != b"".join(raw) or any(_SPACE.encode() in r for r in raw):
            out = [x if b"".join(map(texts.__getitem__, i)) == r else None for x, i, r in zip(out, ids, raw)]
        return out


@functools.cache
def _tokenizers(a: str, b: str) -> Tokenizers:
    return Tokenizers(a, b)


class _Numbers(dict):
    """Spells to numbers in order of arrival."""

    def __missing__(self, spell: str) -> int:
        self[spell] = n = len(self)
        return n


def _packed_rows(tokens: list[bytes]) -> pa.Array:
    """A list for each ``SPELLS`` spells: the tokens of all, with the spell's place in the row above bit 32."""
    n = np.array([len(t) // 4 for t in tokens], np.int64)
    place, ends = np.repeat(np.arange(len(tokens)) % SPELLS, n), np.r_[0, np.cumsum(n)]
    values = place << 32 | np.frombuffer(b"".join(tokens), np.int32)
    return pa.ListArray.from_arrays(ends[[*range(0, len(tokens), SPELLS), len(tokens)]].astype(np.int32), pa.array(values))


TEXT = "kind string, chunk long, doc_id long, spells binary, part long, numbers binary, words binary"
PART = "kind string, part long, k int, a array<long>, b array<long>, chunk long, numbers binary, places binary"


def _batch(ddl: str, kind: str, n: int, columns: dict) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(c, types[t]) for c, t in (x.split() for x in ddl.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array([kind] * n) if f.name == "kind" else columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _zipped(*blobs: bytes) -> bytes:
    """Blobs in one, compressed."""
    raw = np.array([len(blobs), *map(len, blobs)], np.int64).tobytes() + b"".join(blobs)
    return np.int64(len(raw)).tobytes() + ZSTD.compress(raw, asbytes=True)


def _unzipped(blob: bytes) -> list[bytes]:
    raw = ZSTD.decompress(blob[8:], int(np.frombuffer(blob[:8], np.int64)[0]), asbytes=True)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    ends = (8 + 8 * n + np.cumsum(np.frombuffer(raw[8 : 8 + 8 * n], np.int64))).tolist()
    return [raw[lo:hi] for lo, hi in zip([8 + 8 * n, *ends], ends)]


def chunked(docs: DataFrame, a: str, b: str, labels: list[int], first: dict[int, int], parts: list[int]) -> DataFrame:
    """Rows of two kinds; a partition's chunks take ``labels`` from ``first`` of its number on.  text: chunk, doc_id and spells (the document's
    numbers of spells, 32-bit); spell: chunk, part, and the numbers and texts (their lengths, and UTF-8) of the chunk's distinct spells of that part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own_part = _tokenizers(a, b), TaskContext.get().partitionId()
        chunks = itertools.chain(labels[first.get(own_part, 0) : first.get(own_part + 1, 0)], itertools.count(own_part + 1 << 40))  # these are no labels: they share a bucket
        chunk, ids, own, at, size = next(chunks), [], [], _Numbers(), 0

        def rows() -> Iterator[pa.RecordBatch]:
            yield _batch(TEXT, "text", len(ids), {"chunk": pa.array([chunk] * len(ids), pa.int64()), "doc_id": pa.array(ids, pa.int64()), "spells": pa.array([planes(x) for x in own], pa.binary())})
            raw = [s.encode() for s in at]
            part = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)) % np.uint64(len(parts))
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(len(parts) + 1, dtype=np.uint64)).tolist()
            numbers_of, words = [], []
            for lo, hi in zip(ends, ends[1:]):
                mine = order[lo:hi]
                texts = [raw[k] for k in mine.tolist()]
                numbers_of.append(_zipped(planes(np.diff(mine, prepend=0))))
                words.append(_zipped(planes(np.fromiter(map(len, texts), np.int32, len(texts))), b"".join(texts)))
            some = [k for k, (lo, hi) in enumerate(zip(ends, ends[1:])) if lo < hi]
            pick = lambda x, t: pa.array([x[k] for k in some], t)
            yield _batch(TEXT, "spell", len(some), {"chunk": pa.array([chunk] * len(some), pa.int64()), "part": pick(parts, pa.int64()), "numbers": pick(numbers_of, pa.binary()), "words": pick(words, pa.binary())})
            pa.default_memory_pool().release_unused()  # a worker lives on beside the next stages

        for batch in slices(batches, 200):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                spells = known.spells(text)
                ids.append(doc)
                own.append(np.fromiter(map(at.__getitem__, spells), np.int32, len(spells)))
                size += len(text or "")
                if size >= CHUNK:
                    yield from rows()
                    chunk, ids, own, at, size = next(chunks), [], [], _Numbers(), 0
        if ids:
            yield from rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TEXT)


def tokenized(sent: DataFrame, a: str, b: str, parts: int) -> DataFrame:
    """Rows of two kinds.  spell: part, k (the first of up to ``SPELLS`` spells) and their tokens a and b, each distinct spell of the part once; place:
    part, chunk, the numbers of the spells that the chunk sent, and which spell of the part each is (-1: it has no tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, at, rows = _tokenizers(a, b), None, _Numbers(), []

        def out() -> Iterator[pa.RecordBatch]:
            spells = [s.decode() for s in at]
            whole, sides = [], ([], [])
            for lo in range(0, len(spells), 40 * SPELLS):
                some = spells[lo : lo + 40 * SPELLS]
                known.learn(some)
                tokens = [known[s] for s in some]
                known.clear()  # no other part has these
                whole += [t is not None for t in tokens]
                for side in (0, 1):
                    sides[side].extend(t[side] for t in tokens if t)
            number = np.where(whole, np.cumsum(whole) - 1, -1).astype(np.int32)
            places = [planes(number[p]) for _, _, p in rows]
            yield _batch(PART, "place", len(rows), {"part": pa.array([part] * len(rows), pa.int64()), "chunk": pa.array([c for c, _, _ in rows], pa.int64()), "numbers": pa.array([n for _, n, _ in rows], pa.binary()), "places": pa.array([_zipped(p) for p in places], pa.binary())})
            for lo in range(0, len(sides[0]), 40 * SPELLS):
                x, y = (side[lo : lo + 40 * SPELLS] for side in sides)
                k = np.arange(lo, lo + len(x), SPELLS, dtype=np.int32)
                yield _batch(PART, "spell", len(k), {"part": pa.array([part] * len(k), pa.int64()), "k": pa.array(k), "a": _packed_rows(x), "b": _packed_rows(y)})
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for of, chunk, numbers_of, words in zip(*(batch.column(c).to_pylist() for c in ("part", "chunk", "numbers", "words"))):
                if of != part and rows:
                    yield from out()
                    at, rows = _Numbers(), []
                part = of
                lengths, raw = _unzipped(words)
                ends = np.cumsum(numbers(lengths)).tolist()
                rows.append((chunk, numbers_of, np.fromiter((at[raw[lo:hi]] for lo, hi in zip([0, *ends], ends)), np.int32, len(ends))))
        if rows:
            yield from out()

    return sent.select("part", "chunk", "numbers", "words").repartition(max(1, parts), "part").sortWithinPartitions("part").mapInArrow(run, PART)


def aligned(spells: DataFrame) -> DataFrame:
    """part, k, groups (as text), n_a, n_b, n_groups and links (A id * 2**32 + B id, as often as linked) of every spell."""
    own = W.partitionBy("part", "k")

    order = own.orderBy("pos")

    def tokens(side: str) -> DataFrame:
        t = spells.select("part", "k", F.posexplode(side).alias("pos", "t")).select("part", (F.col("k") + F.shiftright("t", 32)).cast("int").alias("k"), "pos", F.col("t").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("t"))
        end = F.sum(F.col("t").bitwiseAND(F.lit((1 << LENGTH) - 1))).over(order.rowsBetween(W.unboundedPreceding, 0))
        return t.select("part", "k", "pos", end.cast("int").alias("end"), F.shiftright("t", LENGTH).alias(side))

    def grouped(side: str, other: str) -> DataFrame:
        # Hash joins keep the order of their first side, which the running count needs; the other side is a task's one part.
        ends = tokens(other).select("part", "k", "end", F.lit(1).alias("cut")).hint("shuffle_hash")
        g = F.count("cut").over(order.rowsBetween(W.unboundedPreceding, -1)).cast("int")
        t = tokens(side).join(ends, ["part", "k", "end"], "left").withColumn("g", g)
        return t.groupBy("part", "k", "g").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", side))), lambda x: x[side]).alias(side))

    met = grouped("a", "b").join(grouped("b", "a").hint("shuffle_hash"), ["part", "k", "g"])
    groups = met.groupBy("part", "k").agg(F.array_sort(F.collect_list(F.struct("g", "a", "b"))).alias("gs"))
    listed = lambda x: F.array_join(x.cast("array<string>"), ",")
    links = F.flatten(F.transform("gs", lambda g: F.flatten(F.transform(g["a"], lambda x: F.transform(g["b"], lambda y: F.shiftleft(x.cast("long"), 32) + y)))))
    count = lambda side: F.aggregate("gs", F.lit(0), lambda n, g: n + F.size(g[side])).alias(f"n_{side}")
    return groups.select(
        "part", "k", F.array_join(F.transform("gs", lambda g: F.concat(listed(g["a"]), F.lit("|"), listed(g["b"]))), ";").alias("groups"),
        count("a"), count("b"), F.size("gs").alias("n_groups"), links.alias("links"),
    )


def returned(spells: DataFrame, places: DataFrame) -> DataFrame:
    """chunk, numbers and aligned: what a chunk gets back from a part for the spells that it sent."""

    def back(key: Key, spells: pa.Table, places: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        order = pa.array(np.argsort(spells.column("k").to_numpy(), kind="stable"))
        text = np.array([*spells.column("groups").take(order).to_pylist(), ""], object)  # the last one is that of a spell without tokens
        sizes = [np.r_[spells.column(c).take(order).to_numpy().astype(np.int32), 0] for c in ("n_a", "n_b", "n_groups")]
        links = spells.column("links").take(order).combine_chunks()
        links = links.combine_chunks() if isinstance(links, pa.ChunkedArray) else links
        n_of = np.r_[np.diff(links.offsets.to_numpy()), 0].astype(np.int64)
        start, link = np.cumsum(n_of) - n_of, links.flatten().to_numpy(zero_copy_only=False)
        out = []
        for blob in places.column("places").to_pylist():
            p = numbers(_unzipped(blob)[0])
            mine = link[_ranges(start[p], n_of[p])]
            out.append(_zipped("\n".join(text[p].tolist()).encode(), *(planes(v[p]) for v in sizes), planes(n_of[p]), planes(mine >> 32), planes(mine & 0xFFFFFFFF)))
        return pa.table({"chunk": places.column("chunk"), "numbers": places.column("numbers"), "aligned": pa.array(out, pa.binary())})

    return spells.groupBy("part").cogroup(places.select(F.col("part").alias("of"), "chunk", "numbers", "places").groupBy("of")).applyInArrow(back, "chunk long, numbers binary, aligned binary")


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of start[i] ... start[i] + n[i] - 1, one range after the other."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


MET = "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, spells array<binary>, n_of binary, link binary, pair array<long>, docs array<long>"


def _meet(back: pa.Table, chunk: pa.Table) -> pa.Table:
    """What a chunk's documents get from its aligned spells; pair and docs are its distinct id pairs and how many documents hold each."""
    number, text, got = [], [], [[] for _ in range(6)]
    for numbers_of, blob in zip(back.column("numbers").to_pylist(), back.column("aligned").to_pylist()):
        number.append(np.cumsum(numbers(_unzipped(numbers_of)[0])))
        texts, *rest = _unzipped(blob)
        text += texts.decode().split("\n")
        for x, y in zip(got, rest):
            x.append(numbers(y))
    joined = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    order = np.argsort(joined(number), kind="stable")
    text = [text[k] for k in order.tolist()]
    n_of, a, b = map(joined, got[3:])
    sizes = {c: joined(x)[order] for c, x in zip(("n_a", "n_b", "n_groups"), got)}
    link = (a << 32 | b)[_ranges((np.cumsum(n_of) - n_of)[order], n_of[order])]
    n_of = n_of[order]
    pair, link = np.unique(link, return_inverse=True)
    start, last, held = np.cumsum(n_of) - n_of, np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
    out: dict[str, list] = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "sha", "spells")}
    for blob in chunk.column("spells").to_pylist():
        own = numbers(blob)
        if not sizes["n_a"][own].all():
            own = own[:0]  # a spell without tokens: the text has none
        out["spells"].append(blob if len(own) else b"")
        for c, v in sizes.items():
            out[c].append(int(v[own].sum()))
        out["n_links"].append(int(n_of[own].sum()))
        out["sha"].append(hashlib.sha256(";".join([text[s] for s in own.tolist()]).encode()).hexdigest() if len(own) else "")
        once = np.unique(own)
        mine = link[_ranges(start[once], n_of[once])]
        last[mine] = np.arange(len(mine))
        held[mine[last[mine] == np.arange(len(mine))]] += 1
    lists = pa.list_(pa.int64())
    one = {"chunk": pa.array([chunk.column("of")[0].as_py()], pa.int64()), "doc_id": pa.array([chunk.column("doc_id").to_pylist()], lists)}
    one |= {c: pa.array([v], pa.list_({"sha": pa.string(), "spells": pa.binary()}.get(c, pa.int64()))) for c, v in out.items()}
    return pa.table(one | {"n_of": pa.array([n_of.astype(np.int32).tobytes()], pa.binary()), "link": pa.array([planes(link)], pa.binary()), "pair": pa.array([pair], lists), "docs": pa.array([held], lists)})


def _finish(counts: pa.Table, chunk: pa.Table) -> pa.Table:
    """Rows of the chunk's documents, with sums over links of what came back for its id pairs."""
    pairs, n_of = len(chunk.column("pair")[0]), np.frombuffer(chunk.column("n_of")[0].as_py(), np.int32).astype(np.int64)
    count, best = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    at = counts.column("j").to_numpy()
    count[at], best[at] = counts.column("count").to_numpy(), counts.column("best").to_numpy()
    link = numbers(chunk.column("link")[0].as_py())
    sums = [np.diff(np.r_[0, np.cumsum(v[link])][np.r_[0, np.cumsum(n_of)]]) for v in (best, count)]
    docs = [numbers(x) for x in chunk.column("spells")[0].as_py()]
    flat = {c: pa.array(chunk.column(c)[0].as_py(), pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(flat | {"n_best": pa.array([int(sums[0][d].sum()) for d in docs], pa.int64()), "count_sum": pa.array([int(sums[1][d].sum()) for d in docs], pa.int64()), "groups_sha256": pa.array(chunk.column("sha")[0].as_py(), pa.string())})


def met_chunks(back: DataFrame, texts: DataFrame, chunks: int) -> DataFrame:
    def run(key: Key, a: pa.Table, b: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        return _meet(a, b)

    # As many partitions as the texts have buckets, so that only what came back is exchanged.
    return back.repartition(max(1, chunks), "chunk").groupBy("chunk").cogroup(texts.select(F.col("chunk").alias("of"), "doc_id", "spells").groupBy("of")).applyInArrow(run, MET)


def pair_counts(met: DataFrame) -> DataFrame:
    """pair, count (documents that hold it) and best (1 if no pair of its A id has a higher count)."""
    counts = met.select(F.explode(F.arrays_zip("pair", "docs")).alias("p")).groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.docs").alias("count")).withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))


def kept(df: DataFrame) -> DataFrame:
    """Written in the shared folder and read again."""
    to = shared_dir(df.sparkSession, "align")
    df.write.option("compression", "zstd").parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(to)


def labelled(docs: DataFrame) -> tuple[list[int], dict[int, int]]:
    """Labels of chunks, one for each bucket of hash partitioning into as many buckets, and the place of the first label of each partition of docs.

    A bucket then holds one chunk, never several that happen to meet.  Of 24 numbers a bucket, the least that falls there is its label.
    """
    of = docs.select(F.spark_partition_id().alias("part"), F.length("text").alias("n")).groupBy("part").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    sizes = {r["part"]: r["n"] for r in of.collect()}
    first, n = {}, 0
    for part in range(max(sizes, default=-1) + 1):
        first[part] = n
        n += sizes[part] // CHUNK + 1 if part in sizes else 0
    first[len(first)] = n
    return bucket_labels(docs.sparkSession, n), first


def bucket_labels(spark: SparkSession, n: int) -> list[int]:
    """A number that falls in each of n buckets."""
    found = spark.range(24 * n).groupBy(F.pmod(F.hash("id"), F.lit(max(1, n))).alias("bucket")).agg(F.min("id").alias("label")).collect()
    by = {r["bucket"]: r["label"] for r in found}
    return [by.get(k, 24 * n + k) for k in range(n)]


def bucketed(rows: DataFrame, buckets: int, by: str = "chunk") -> tuple[str, str]:
    """Name and folder of a table of rows, by kind if they have one, and bucketed: what reads it by that column needs no exchange."""
    name, to = f"align_{uuid.uuid4().hex}", shared_dir(rows.sparkSession, "align")
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", to).bucketBy(max(1, buckets), by)
    (writer.partitionBy("kind") if "kind" in rows.columns else writer).saveAsTable(name)
    return name, to


def deleted(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dropped(spark: SparkSession, name: str, folder: str) -> None:
    """Drops the table and its files."""
    spark.sql(f"DROP TABLE {name}")
    deleted(spark, folder)


def align(docs: DataFrame, *, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs(doc_id, text)."""
    spark = docs.sparkSession
    labels, first = labelled(docs)
    chunks = len(labels)
    parts = bucket_labels(spark, max(1, min(chunks, max(PARTS, chunks // 4))))
    tables = [bucketed(chunked(docs, a, b, labels, first, parts), chunks)]
    # All joins here hold (part, k, ...) in their keys: sides that are partitioned by part need no shuffle by all keys.
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        rows = spark.table(tables[0][0])
        tables.append(bucketed(tokenized(rows.where("kind = 'spell'"), a, b, len(parts)), len(parts), "part"))
        deleted(spark, f"{tables[0][1]}/kind=spell")  # they are in their parts now
        own = spark.table(tables[1][0])
        back = kept(returned(aligned(own.where("kind = 'spell'")), own.where("kind = 'place'")))
        dropped(spark, *tables.pop())
        name, _ = bucketed(met_chunks(back, rows.where("kind = 'text'"), chunks), chunks)
        met = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # its files stay: all that follows reads them
    finally:
        spark.conf.set(setting, before)
        for table_of in tables:
            dropped(spark, *table_of)
    for file in back.inputFiles()[:1]:
        deleted(spark, file.rsplit("/", 1)[0])
    counted = met.select(F.col("chunk").alias("of"), F.posexplode("pair").alias("j", "pair")).join(pair_counts(met), "pair").select("of", "j", "count", "best")

    def run(key: Key, counts: pa.Table, chunk: pa.Table) -> pa.Table:
        return _finish(counts, chunk)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return counted.repartition(max(1, chunks), "of").groupBy("of").cogroup(met.groupBy("chunk")).applyInArrow(run, schema)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
