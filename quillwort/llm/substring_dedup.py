"""Substring dedup by recompression (operator 6).

Contract: words are runs of ``[^\\x20\\x09-\\x0D]``; a window is ``WINDOW`` = 20 consecutive words of one document; each
word covered by a window whose word sequence also starts earlier (smaller doc_id, or same document and earlier) goes.

Recompression.  Every word has a global 64-bit name.  In each of ``ROUNDS`` rounds, names split into a left and a right
half by a hash bit, and a left name followed by a right one is replaced by the pair's name, which is a hash of both:
the same pair gets the same name in every task without a dictionary to build.  Equal neighbours fall into the same half,
so a run never pairs inside; all its inner places carry one name and one context and are sent once.  A round can change
a window's parse only at its edge symbols: after two rounds (symbols of up to 4 words) at most 3 words at each end of a
window depend on what surrounds it, so equal windows have equal symbols starting at places 3 to 13, one in any 4 places.
The symbol of least hash there is the window's anchor, and its 10-word context lies inside the window.  Hence equal
windows share an anchor context, wherever they stand:

1. every chunk sends its distinct anchor contexts; those found in two or more chunks come back (candidates only);
2. the windows around these are named by 128 bits, distinct by chunk; names that an earlier chunk has come back;
3. the chunk drops the words of such windows, and of those repeated within the chunk itself.

Texts are shuffled once (the exchange by chunk is the same in all three steps and is reused).  No count of partners or
occurrences is capped; a passage that a third of all documents share is sent once a chunk.

Null text: no words.  Null id: after all others.  Rows of equal id: ordered by text, each a document.  Empty tables
give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quillwort.llm.common import NAMES, PACKED_DDL, Key, buckets_of, by_bucket, coarse, covered, id_chunk, in_sorted, minimal_places, mixed, ordered_rows, packed, received_keys, send_keys, shared_keys, table, to_chunks, unpacked

WINDOW = 20
ROUNDS = 2
#: Words at either end of a window whose symbols may depend on what surrounds it: 2**ROUNDS - 1.
EDGE = 2**ROUNDS - 1
#: A symbol that starts here at the latest ends before the right edge: symbols have up to 2**ROUNDS words.
REACH = WINDOW - EDGE - 2**ROUNDS - EDGE + 1
#: Words of an anchor's context: from EDGE before it, inside the window for every anchor place.
CONTEXT = WINDOW - REACH + 1
ROWS_PER_CHUNK = 1500
_B = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)]
PAIR = np.dtype([("a", "<u8"), ("b", "<u8")])


def recompressed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and names of the symbols of a word-name sequence after ROUNDS rounds of pairing."""
    start, name = np.arange(len(x)), x
    for r in range(ROUNDS):
        left = (mixed(name, r + 1) >> np.uint64(63)).astype(bool)
        pair = left[:-1] & ~left[1:]
        at = np.flatnonzero(pair)
        name = name.copy()
        name[at] = mixed(name[at] * _B[0] + name[at + 1], 7)
        keep = np.r_[True, ~pair] if len(name) else np.zeros(0, bool)
        start, name = start[keep], name[keep]
    return start, name


def hashed(x: np.ndarray, at: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of x[a : a + n] for each a."""
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = h * base + x[at + k]
    return mixed(h, n)


def windows(x: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of all x[i : i + n]."""
    m = len(x) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h *= base
        h += x[k : k + m]
    return mixed(h, n)


class Chunk:
    """The word names of a chunk's documents, end to end."""

    def __init__(self, t: pa.Table):
        self.ids, self.texts, self.order = ordered_rows(t)
        parts = [NAMES.array(s.split()) for s in self.texts]
        self.x = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.lens = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(self.lens)
        self.starts = self.ends - self.lens

    def room(self) -> np.ndarray:
        """For each place, the words up to the end of its document."""
        return np.repeat(self.ends, self.lens) - np.arange(len(self.x))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors and the hashes of their contexts, which lie in one document."""
        start, name = recompressed(self.x)
        v = np.full(len(self.x), 2**32 - 1, np.uint32)
        v[start] = mixed(name, 11) >> np.uint64(33)
        p = np.flatnonzero(minimal_places(v, REACH))
        since, room = p - np.repeat(self.starts, self.lens)[p], self.room()[p]
        p = p[(since >= EDGE) & (room >= CONTEXT - EDGE)]
        return p, hashed(self.x, p - EDGE, CONTEXT, _B[0])

    def names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which places start a window, and two hashes of each."""
        a, b = windows(self.x, WINDOW, _B[0]), windows(mixed(self.x, 3), WINDOW, _B[1])
        return self.room()[: len(a)] >= WINDOW, a, b


def _send_anchors(n_buckets: int):
    def send(key: Key, t: pa.Table) -> pa.Table:
        return send_keys(key[0].as_py(), Chunk(t).anchors()[1], n_buckets)

    return send


def _send_windows(n_buckets: int):
    def send(key: Key, t: pa.Table, back: pa.Table) -> pa.Table:
        c = Chunk(t)
        p, k = c.anchors()
        p = p[in_sorted(coarse(k), received_keys(back))]
        ok, a, b = c.names()
        # An anchor at p has its context in the windows that start up to EDGE + REACH - 1 before it; mark them all.
        near = covered(np.maximum(p - EDGE - REACH + 1, 0), REACH, len(c.x))[: len(a)] & ok if len(p) else np.zeros(len(a), bool)
        w = np.empty(int(near.sum()), PAIR)
        w["a"], w["b"] = a[near], b[near]
        w = np.unique(w)
        return packed([(g, key[0].as_py(), w[at].tobytes()) for g, at in by_bucket(np.ascontiguousarray(w["a"]), n_buckets)])

    return send


def _earlier_windows(key: Key, t: pa.Table) -> pa.Table:
    """Reducer: names that an earlier chunk sent too go back to each later chunk."""
    w, chunk = unpacked(t, PAIR)
    order = np.lexsort((chunk, w["b"], w["a"]))
    w, chunk = w[order], chunk[order]
    later = np.r_[False, (w["a"][1:] == w["a"][:-1]) & (w["b"][1:] == w["b"][:-1])] if len(w) else np.zeros(0, bool)
    return to_chunks(key[0].as_py(), chunk[later], w[later])


def _cut(with_text: bool, carry: tuple[str, ...]):
    def cut(key: Key, t: pa.Table, back: pa.Table) -> pa.Table:
        c = Chunk(t)
        ok, a, b = c.names()
        gone = np.zeros(len(a), bool)
        if len(a):
            # Repeats within the chunk: every place but the first of each name, in document order.
            at = np.flatnonzero(ok)
            order = at[np.argsort(a[at], kind="stable")]
            same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
            gone[order[1:][same]] = True
            w = np.sort(unpacked(back, PAIR)[0], order=("a", "b"))
            if len(w):
                i = np.searchsorted(w["a"], a)
                i[i == len(w)] = 0
                gone |= ok & (w["a"][i] == a) & (w["b"][i] == b)
        drop = covered(np.flatnonzero(gone), WINDOW, len(c.x))
        kept = []
        for s, lo, hi in zip(c.texts, c.starts, c.ends):
            words = s.split()
            kept.append(b" ".join(compress(words, ~drop[lo:hi]) if drop[lo:hi].any() else words))
        removed = np.r_[0, np.cumsum(drop)]
        cols = {
            "doc_id": pa.array(c.ids, pa.int64()), "n_words": pa.array(c.lens, pa.int64()), "n_removed": pa.array((removed[c.ends] - removed[c.starts]).astype(np.int64), pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        }
        cols |= {"kept_text": pa.array(kept, pa.binary()).cast(pa.string())} if with_text else {}
        return pa.table(cols | {name: t.column(name).take(pa.array(c.order, pa.int64())) for name in carry})

    return cut


def substring_dedup(docs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, with_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text of every row of ``docs``(doc_id, text), with the
    row's own ``carry`` columns."""
    spark = docs.sparkSession
    n = buckets_of(spark)
    own = [c for c in carry if c != "text"]
    chunked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", *own, id_chunk(docs, "doc_id", rows_per_chunk).alias("chunk"))
    sent = chunked.groupBy("chunk").applyInArrow(_send_anchors(n), PACKED_DDL)
    shared = sent.groupBy("bucket").applyInArrow(shared_keys, PACKED_DDL)
    named = chunked.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_send_windows(n), PACKED_DDL)
    earlier = named.groupBy("bucket").applyInArrow(_earlier_windows, PACKED_DDL)
    schema = StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    schema = StructType([*schema.fields, *(docs.schema[c] for c in carry)])
    return chunked.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(_cut(with_text, carry), schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM p WHERE i + 19 <= len(w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS i FROM dup),
per AS (
  SELECT p.doc_id, count(gone.i) AS n_removed, coalesce(string_agg(CASE WHEN gone.i IS NULL THEN p.w[p.i] END, ' ' ORDER BY p.i), '') AS kept
  FROM p LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.i = p.i GROUP BY p.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(per.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(per.kept, '')) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)
"""
