"""Best-fit packing of tokenised documents into sequences, improved by bin-completion branch and bound (operator 13).

A document is its ids and then id 0, cut into pieces of ``CAPACITY`` tokens only if it is longer.  The packing works on the
histogram of piece lengths: at most ``CAPACITY`` numbers, whatever the size of the corpus.

* ``best_fit`` packs the histogram by best fit decreasing, many equal bins at a time, and is the first incumbent.
* ``bin_completion`` branches on the fillings around the largest piece left: only maximal ones that no single swap dominates (a
  piece, or two, for a larger one that also fits; a piece that fills the rest exactly dominates all others).  A filling is
  repeated as often as the counts allow.  A branch ends when the waste so far leaves no room for a better packing, or when its
  bins and the lower bound of the rest reach the incumbent.  The search stops at the lower bound, or after ``BRANCHES`` fillings, a documented
  bound on work: the result is then the best packing found, still with every piece.
* A packing is a list of patterns with multiplicities, a few thousand rows at most.  Spark gives each piece its rank among the
  pieces of its length (counts by partition first, then within a partition), and the rank finds its sequence and offset.

Tokenising: runs of ASCII white space separate the tokenizer's words, so the ids of a text are those of its runs of other
characters, one after another; each run is encoded when it is met and not remembered, and in parts that are remembered, too.

Null text: empty, one piece of length 1.  Repeated rows and null ids: documents of their own.  Empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import checkpointed, slices, table
from quillwort.llm.mixing import running

CAPACITY = 2048
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Fillings that branch and bound tries.
BRANCHES = 20_000
#: Fillings enumerated around one piece, and steps of their enumeration.
WIDTH, STEPS = 24, 2_000
#: Runs of characters, and their parts, whose ids a worker remembers.
REMEMBERED, PARTS = 800_000, 400_000

#: A pattern: (length, how many) pairs in the order in which they stand in a sequence.
Pattern = tuple[tuple[int, int], ...]


def best_fit(counts: list[int]) -> list[tuple[Pattern, int]]:
    """Best fit decreasing of counts[length] pieces into bins of len(counts) - 1 tokens: patterns and how many bins have each."""
    cap = len(counts) - 1
    by_room: list[list[tuple[Pattern, int]]] = [[] for _ in range(cap + 1)]
    for length in range(cap, 0, -1):
        left = counts[length]
        while left:
            room = next((r for r in range(length, cap) if by_room[r]), cap)
            pattern, bins = by_room[room].pop() if by_room[room] else ((), left)
            each = min(room // length, left)
            filled = min(bins, left // each)
            if bins > filled and pattern:
                by_room[room].append((pattern, bins - filled))
            by_room[room - each * length].append(((*pattern, (length, each)), filled))
            left -= each * filled
    return [x for room in by_room for x in room]


def least_bins(counts: np.ndarray) -> int:
    """A lower bound of the number of bins: for every a, pieces over cap - a stand alone, and pieces of a and more fill the rest of the large ones first."""
    cap = len(counts) - 1
    lengths = np.arange(cap + 1)
    n, size = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * lengths)]
    half, a = cap // 2, np.arange(cap // 2 + 1)
    alone, large = n[-1] - n[cap - a + 1], n[cap - a + 1] - n[half + 1]
    room = large * cap - (size[cap - a + 1] - size[half + 1])
    over = size[half + 1] - size[a] - room
    return int((alone + large + np.maximum(0, -(-over // cap))).max())


def fillings(counts: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` with pieces at hand, least waste first; lengths fall within a filling."""
    if room and counts[room]:
        return [(room,)]
    up, stock = np.flatnonzero(counts[: room + 1]).tolist(), counts.tolist()
    have = up[::-1]
    least, found, steps = have[-1] if have else room + 1, [], 0

    def extend(at: int, left: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps
        steps += 1
        if steps > STEPS:
            return
        fits = False
        for k in range(max(at, len(up) - bisect.bisect_right(up, left)), len(have)):
            x = have[k]
            if chosen.count(x) < stock[x]:
                fits = True
                extend(k, left - x, (*chosen, x))
                if steps > STEPS:
                    return
        if not fits and (left < least or all(chosen.count(x) >= stock[x] for x in up[: bisect.bisect_right(up, left)])):
            found.append((left, chosen))

    extend(0, room, ())

    def dominated(left: int, chosen: tuple[int, ...]) -> bool:
        spare = lambda lo, hi: any(stock[x] > chosen.count(x) for x in up[bisect.bisect_left(up, lo) : bisect.bisect_right(up, hi)])
        few = chosen[:8]
        return any(spare(x + 1, x + left) for x in set(few)) or any(spare(few[i] + few[j], few[i] + few[j] + left) for i in range(len(few)) for j in range(i))

    if len(found) > 4 * WIDTH:
        most = sorted(left for left, _ in found)[4 * WIDTH - 1]
        found = [f for f in found if f[0] <= most]
    found.sort(key=lambda f: (f[0], [-x for x in f[1]]))
    kept = [f for f in found[: 4 * WIDTH] if not dominated(*f)][:WIDTH]
    return [chosen for _, chosen in kept or found[:1]] or [()]


def bin_completion(counts: list[int], branches: int = BRANCHES) -> list[tuple[Pattern, int]]:
    """The best packing found: patterns and how many bins have each."""
    cap, start = len(counts) - 1, np.array(counts, np.int64)
    start[0] = 0
    total, bound = int((start * np.arange(cap + 1)).sum()), least_bins(start)
    best = best_fit(start.tolist())
    n_best = sum(m for _, m in best)
    path: list[tuple[tuple[int, ...], int]] = []

    def options(left: np.ndarray, used: int, waste: int) -> Iterator[tuple[np.ndarray, int, int, tuple[int, ...], int]]:
        largest = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[largest] -= 1
        for f in fillings(rest, cap - largest):
            chosen = (largest, *f)
            times = min(int(left[x]) // chosen.count(x) for x in set(chosen))
            then = left.copy()
            for x in chosen:
                then[x] -= times
            yield then, used + times, waste + times * (cap - sum(chosen)), chosen, times

    open_nodes = [options(start, 0, 0)] if n_best > bound else []
    while open_nodes and branches and n_best > bound:
        step = next(open_nodes[-1], None)
        if step is None:
            open_nodes.pop()
            if path:
                path.pop()
            continue
        branches -= 1
        left, used, waste, chosen, times = step
        if waste > (n_best - 1) * cap - total or used + least_bins(left) >= n_best:
            continue
        path.append((chosen, times))
        if left.any():
            open_nodes.append(options(left, used, waste))
            continue
        n_best, best = used, [(tuple((x, c.count(x)) for x in sorted(set(c), reverse=True)), m) for c, m in path]
        path.pop()
    return best


def slots(packing: list[tuple[Pattern, int]]) -> np.ndarray:
    """A row (length, first rank, run, first sequence, offset) for each length of each pattern: rank r of the length stands in sequence
    first sequence + (r - first rank) // run, at the offset + length * ((r - first rank) % run)."""
    rows, taken, sequence = [], {}, 0
    for pattern, bins in packing:
        offset = 0
        for length, run in pattern:
            rows.append((length, taken.get(length, 0), run, sequence, offset))
            taken[length] = taken.get(length, 0) + run * bins
            offset += length * run
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level spelling: bytes that print stand for themselves, the others for characters from U+0100 on.
_SPELT = {b: chr(b) for b in _VISIBLE} | {b: chr(0x100 + k) for k, b in enumerate(sorted({*range(0x100)} - {*_VISIBLE}))}
_PRINTABLE = frozenset(range(0x21, 0x7F))


class _Parts(dict):
    """Parts of runs, which the tokenizer does not split before it looks at its vocabulary, to their ids."""

    def __init__(self, model):
        self.model = model

    def __missing__(self, x: bytes) -> bytes:
        if len(self) >= PARTS:
            self.clear()
        self[x] = ids = array("I", [t.id for t in self.model.tokenize(x.decode("latin-1").translate(_SPELT))]).tobytes()
        return ids


class _Encoded(dict):
    """UTF-8 runs of other than white space to their ids, as little-endian 32-bit bytes; remembered by a worker from task to task.

    Runs are lower-cased and split here as the tokenizer does it, so that its vocabulary is asked for few distinct parts.  For every
    character beyond ASCII the tokenizer is asked once how it lower-cases and splits it; a run with a character on which it differs, or that is
    not in NFC or may hold a special token, goes to the tokenizer whole.
    """

    ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")  # fixed value: the tokenizer's own pattern, for lower-case ASCII
    LETTERS = regex.compile(r"\p{L}+")
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")  # fixed value: the tokenizer's own pattern

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts = _Parts(self.model)
        self.lower = {c: chr(c).lower() for c in _PRINTABLE}
        self.known = {chr(c) for c in _PRINTABLE}

    def agrees(self, text: str) -> bool:
        for c in () if self.known.issuperset(text) else set(text) - self.known:
            low = self.tokenizer.normalizer.normalize_str(c)
            split = [x.encode().decode("latin-1").translate(_SPELT) for x in self.SPLIT.findall(f"a{low}.")]
            if unicodedata.category(c) == "Cn" or [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{low}.")] != split:
                return False
            if low.isalpha() != bool(self.LETTERS.fullmatch(low)):
                return False
            self.lower[ord(c)] = low
            self.known.add(c)
        return unicodedata.is_normalized("NFC", text)

    def __missing__(self, r: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        if r.isalpha():  # of bytes: ASCII letters
            ids = self.parts[r.lower()]
        elif b"<|" in r:
            ids = self.whole(r)
        elif _PRINTABLE.issuperset(r):
            ids = b"".join([self.parts[x] for x in self.ASCII.findall(r.lower())])
        elif self.agrees(text := r.decode()):
            low = text.translate(self.lower)
            ids = self.parts[low.encode()] if low.isalpha() else b"".join([self.parts[x.encode()] for x in self.SPLIT.findall(low)])
        else:
            ids = self.whole(r)
        self[r] = ids
        return ids

    def whole(self, r: bytes) -> bytes:
        return array("I", self.tokenizer.encode(r.decode(), add_special_tokens=False).ids).tobytes()

    def learn(self, runs: set[bytes]) -> None:
        for r in runs:
            self[r]


@functools.cache
def _encoded(path: str) -> _Encoded:
    return _Encoded(path)


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of docs(doc_id, text)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _encoded(tokenizer)
        for b in slices(batches, 200):
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                blob = b"".join(map(ids.__getitem__, (text or b"").split())) + bytes(4)
                for k, at in enumerate(range(0, len(blob), 4 * capacity)):
                    part = blob[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int32() if k == 1 else pa.int64()) for k in range(5)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def placed(cut: DataFrame, packing: list[tuple[Pattern, int]]) -> DataFrame:
    """The pieces with sequence_id and offset; ``cut`` is a kept table, so that ranks stay the same when a task runs again."""
    at = slots(packing)
    high = 1 << 44  # ranks of one length; lengths are below 2**19

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = at[:, 0] * high + at[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("before").to_numpy()
            row = at[np.searchsorted(starts, length * high + rank, side="right") - 1]
            k = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(row[:, 3] + k // row[:, 2]), pa.array(row[:, 4] + length * (k % row[:, 2]))], names=[*b.schema.names[:5], "sequence_id", "offset"])

    kept = cut.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
    ranked = running(kept, "length", "part", [F.col("at")], F.lit(1).cast("long"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("before").cast("long").alias("before")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, *, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut = checkpointed(pieces(docs, tokenizer, capacity))
    counts = [0] * (capacity + 1)
    for r in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    return placed(cut, bin_completion(counts))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
