"""Exact byte-level substring dedup by prefix-free parsing (operator 7).

Contract: every text is its UTF-8 bytes; each byte covered by a ``LENGTH`` = 50 byte string that also starts in a
document with a smaller doc_id goes.  Matches never cross documents and are judged on the input.

Prefix-free parsing cuts a text where a rolling hash triggers, collects the distinct phrases in a dictionary, and gets
the order of all text suffixes from the dictionary's suffixes and the parse.  Here:

* Trigger: the rolling hash of the ``TRIGGER`` = 24 bytes from a place is the least of some 27 places in a row.  Every
  50-byte string then holds a whole trigger at a place that depends on the string alone, so equal strings share one.
* Dictionary: a trigger with all bytes that any 50-byte string around it can reach (26 on either side) is a dictionary
  phrase.  Each chunk of documents sends its distinct triggers; only those of two or more chunks go on, and only
  their distinct phrases are sent, compressed.
* Suffix order: a reducer sorts the dictionary's suffixes, each to a depth of 50 bytes (all that the contract asks for),
  by trigger, offset and hash, and compares the bytes of neighbours.  The answer finds its way back to a chunk's phrase by
  a 64-bit name of the phrase's bytes.
* Parse: which chunk has which phrase.  Chunks are ascending ranges of doc_id, so the order of a suffix's chunks is the
  corpus order; a phrase's bit mask of suffixes seen in an earlier chunk goes back.  Order within a chunk is local.

The text is shuffled once, by chunk, and that exchange is reused.  Copies of a phrase cost one row a chunk.

Null text: no bytes.  Null id: after all others.  Rows of equal id are one place in the order: neither removes the
other's bytes, as neither id is smaller.  Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from quillwort.llm.common import PACKED_DDL, Key, buckets_of, by_bucket, coarse, covered, id_chunk, in_sorted, minimal_places, mixed, ordered_docs, packed, received_keys, send_keys, shared_keys, table, to_chunks, unpacked

LENGTH = 50
TRIGGER = 24
#: Places at which a 50-byte string can hold a trigger, and so the strings that hold one trigger.
REACH = LENGTH - TRIGGER + 1
#: Bytes of a dictionary phrase: those of all strings around its trigger.
PHRASE = LENGTH + REACH - 1
ROWS_PER_CHUNK = 500
SLICE = 20_000
#: Bytes hashed at a time.
BLOCK = 1 << 19
#: Buckets of both exchanges for each shuffle partition: a bucket must fit in a Python worker.
BUCKETS = 4
_B = 0x9E3779B97F4A7C15
ENTRY = np.dtype([("key", "<u8"), ("lo", "u1"), ("hi", "u1"), ("bytes", "u1", (PHRASE,))])
MASK = np.dtype([("name", "<u8"), ("mask", "<u4")])


def rolling(x: np.ndarray, n: int, axis: int = 0) -> np.ndarray:
    """Polynomial hash of every n bytes in a row along the axis, by doubling."""
    take = lambda a, lo, hi: a[lo:hi] if axis == 0 else a[:, lo:hi]
    done, have, block, size = None, 0, x.astype(np.uint64) + np.uint64(1), 1
    while True:
        if n & size:
            if done is None:
                done, have = block, size
            else:  # the smaller part stands first
                m = x.shape[axis] - have - size + 1
                done = take(done, 0, m) * np.uint64(pow(_B, size, 2**64)) + take(block, have, have + m)
                have += size
        if have == n:
            return mixed(done, n)
        m = block.shape[axis] - size
        block = take(block, 0, m) * np.uint64(pow(_B, size, 2**64)) + take(block, size, size + m)
        size *= 2


def phrase_names(phrases: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    h = key + (lo.astype(np.uint64) << np.uint64(8)) + hi
    words = np.zeros((len(phrases), -(-PHRASE // 8) * 8), np.uint8)
    words[:, :PHRASE] = phrases
    for col in words.view(np.uint64).T:
        h = mixed(h ^ col, 1) * np.uint64(_B)
    return h


class Chunk:
    """A chunk's documents as bytes, end to end, with PHRASE zero bytes before and after all."""

    def __init__(self, t: pa.Table):
        self.ids, self.texts = ordered_docs(t)
        self.lens = np.array([len(s) for s in self.texts], np.int64)
        self.ends = np.cumsum(self.lens)
        self.starts = self.ends - self.lens
        self.x = np.frombuffer(b"".join(self.texts), np.uint8)
        doc = np.arange(len(self.ids))
        # Rows of equal id share a rank: neither is earlier than the other.
        new = np.array([k == 0 or self.ids[k] != self.ids[k - 1] for k in doc], bool)
        self.rank = np.cumsum(new) if len(doc) else doc

    def triggers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, keys and document numbers of the triggers that lie in one document of LENGTH bytes or more."""
        if len(self.x) < LENGTH:
            return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        n, places, keys = len(self.x) - TRIGGER + 1, [], []
        for lo in range(0, n, BLOCK):  # with the places on either side that share a window with one of the block
            at, hi = max(0, lo - REACH + 1), min(n, lo + BLOCK)
            v = rolling(self.x[at : min(n, hi + REACH - 1) + TRIGGER - 1], TRIGGER)
            p = np.flatnonzero(minimal_places((v >> np.uint64(33)).astype(np.uint32), REACH))
            p = p[(p >= lo - at) & (p < hi - at)]
            places.append(p + at)
            keys.append(v[p])
        p, k = np.concatenate(places), np.concatenate(keys)
        doc = np.searchsorted(self.ends, p, side="right")
        ok = (p + TRIGGER <= self.ends[doc]) & (self.lens[doc] >= LENGTH)
        return p[ok], k[ok], doc[ok]

    def strings(self, s: np.ndarray) -> np.ndarray:
        """Hashes of the LENGTH-byte strings at ascending places."""
        out = np.zeros(len(s), np.uint64)
        for lo in range(0, len(self.x), BLOCK):
            a, b = np.searchsorted(s, (lo, lo + BLOCK))
            if a < b:
                out[a:b] = rolling(self.x[lo : lo + BLOCK + LENGTH - 1], LENGTH)[s[a:b] - lo]
        return out

    def phrases(self, p: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes p - 26 to p + 50 of each trigger, zero outside its document, and the range of strings that lie inside."""
        lo = np.clip(self.starts[doc] - (p - REACH + 1), 0, REACH)
        hi = np.clip(self.ends[doc] - LENGTH - (p - REACH + 1) + 1, 0, REACH)
        at = (p - REACH + 1)[:, None] + np.arange(PHRASE)
        out = self.x[np.clip(at, 0, max(0, len(self.x) - 1))]
        out[(at < self.starts[doc][:, None]) | (at >= self.ends[doc][:, None])] = 0
        return out, lo.astype(np.uint8), hi.astype(np.uint8)


def _send_triggers(n_buckets: int):
    def send(key: Key, t: pa.Table) -> pa.Table:
        return send_keys(key[0].as_py(), Chunk(t).triggers()[1], n_buckets)

    return send


def _send_phrases(n_buckets: int):
    def send(key: Key, t: pa.Table, back: pa.Table) -> pa.Table:
        c = Chunk(t)
        p, k, doc = c.triggers()
        hit = in_sorted(coarse(k), received_keys(back))
        p, k, doc = p[hit], k[hit], doc[hit]
        kept, seen = [], np.zeros(0, np.uint64)
        for i in range(0, len(p), SLICE):
            s = slice(i, i + SLICE)
            ph, lo, hi = c.phrases(p[s], doc[s])
            name, first = np.unique(phrase_names(ph, k[s], lo, hi), return_index=True)
            first = first[~in_sorted(name, seen)]
            seen = np.union1d(seen, name)
            e = np.empty(len(first), ENTRY)
            e["key"], e["lo"], e["hi"], e["bytes"] = k[s][first], lo[first], hi[first], ph[first]
            kept.append(e)
        e = np.concatenate(kept) if kept else np.zeros(0, ENTRY)
        z = zstandard.ZstdCompressor(level=1)
        return packed([(b, key[0].as_py(), z.compress(e[at].tobytes())) for b, at in by_bucket(np.ascontiguousarray(e["key"]), n_buckets)])

    return send


def _masks(e: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """For phrases sorted by key and chunk: the bit mask of the 50-byte strings that an earlier chunk has too."""
    mask = np.zeros(len(e), np.uint32)
    group = np.cumsum(np.r_[True, e["key"][1:] != e["key"][:-1]])
    h = np.ascontiguousarray(rolling(e["bytes"], LENGTH, axis=1).T)
    for j in range(REACH):
        at = np.flatnonzero((e["lo"] <= j) & (j < e["hi"]))
        o = at[np.lexsort((chunk[at], h[j][at], group[at]))]
        if len(o) < 2:
            continue
        same = (group[o][1:] == group[o][:-1]) & (h[j][o][1:] == h[j][o][:-1])
        q = np.flatnonzero(same)  # no hash decides
        same[q] = (e["bytes"][o[q]][:, j : j + LENGTH] == e["bytes"][o[q + 1]][:, j : j + LENGTH]).all(1)
        head = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(o)), 0))
        mask[o[chunk[o] > chunk[o[head]]]] |= np.uint32(1 << j)
    return mask


def _earlier_suffixes(key: Key, t: pa.Table) -> pa.Table:
    """Reducer: sorts the 50-byte suffixes of the bucket's dictionary; a phrase's mask has the strings of earlier chunks."""
    z = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(z.decompress(b), ENTRY) for b in t.column("blob").to_pylist()]
    chunk = np.repeat(np.asarray(t.column("chunk").to_pylist(), np.int64), [len(p) for p in parts])
    e = np.concatenate(parts) if parts else np.zeros(0, ENTRY)
    order = np.lexsort((chunk, e["key"]))
    e, chunk = e[order], chunk[order]
    mask = np.zeros(len(e), np.uint32)
    heads = np.flatnonzero(np.r_[True, e["key"][1:] != e["key"][:-1]]) if len(e) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(e):  # whole keys, about SLICE phrases at a time
        nxt = np.searchsorted(heads, lo + SLICE)
        hi = int(heads[nxt]) if nxt < len(heads) else len(e)
        mask[lo:hi] = _masks(e[lo:hi], chunk[lo:hi])
        lo = hi
    some = np.flatnonzero(mask)
    out = np.empty(len(some), MASK)
    out["mask"] = mask[some]
    for i in range(0, len(some), SLICE):
        s = some[i : i + SLICE]
        out["name"][i : i + SLICE] = phrase_names(e["bytes"][s], e["key"][s], e["lo"][s], e["hi"][s])
    return to_chunks(key[0].as_py(), chunk[some], out)


def _local(c: Chunk, p: np.ndarray, k: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Starts of strings that also start in a document of the same chunk with a smaller id."""
    order = np.argsort(k, kind="stable")
    kk, rr = k[order], c.rank[doc[order]]
    same = np.r_[False, kk[1:] == kk[:-1]]
    head = np.maximum.accumulate(np.where(~same, np.arange(len(kk)), 0))
    last = np.flatnonzero(np.r_[~same[1:], True])
    tail = last[np.searchsorted(last, np.arange(len(kk)))]
    hit = order[rr[head] != rr[tail]]  # documents are in order, so the ranks of a key ascend
    near = covered(np.maximum(p[hit] - REACH + 1, 0), REACH, len(c.x))
    s = np.flatnonzero(near)
    d = np.searchsorted(c.ends, s, side="right")
    ok = s + LENGTH <= c.ends[d]
    s, d = s[ok], d[ok]
    h = c.strings(s)
    o = np.argsort(h, kind="stable")
    eq = np.r_[False, h[o][1:] == h[o][:-1]]
    q = np.flatnonzero(eq)
    for i in range(0, len(q), SLICE):
        a, b = s[o[q[i : i + SLICE]]], s[o[q[i : i + SLICE] - 1]]
        eq[q[i : i + SLICE]] = (c.x[a[:, None] + np.arange(LENGTH)] == c.x[b[:, None] + np.arange(LENGTH)]).all(1)
    first = np.maximum.accumulate(np.where(~eq, np.arange(len(o)), 0))
    return s[o[c.rank[d[o]] > c.rank[d[o[first]]]]]


def _cut(with_text: bool):
    def cut(key: Key, t: pa.Table, back: pa.Table) -> pa.Table:
        c = Chunk(t)
        p, k, doc = c.triggers()
        gone = np.zeros(len(c.x), bool)
        if len(p):
            gone[_local(c, p, k, doc)] = True
        m = np.sort(unpacked(back, MASK)[0], order="name")
        for i in range(0, len(p) if len(m) else 0, SLICE):
            s = slice(i, i + SLICE)
            name = phrase_names(*(lambda ph, lo, hi: (ph, k[s], lo, hi))(*c.phrases(p[s], doc[s])))
            at = np.searchsorted(m["name"], name)
            at[at == len(m)] = 0
            mask = np.where(m["name"][at] == name, m["mask"][at], np.uint32(0))
            for j in range(REACH):
                hit = p[s][(mask >> np.uint32(j)) & np.uint32(1) == 1]
                gone[hit - REACH + 1 + j] = True
        drop = covered(np.flatnonzero(gone), LENGTH, len(c.x))
        opens = drop & ~np.r_[False, drop[:-1]]
        opens[c.starts[c.lens > 0]] = drop[c.starts[c.lens > 0]]  # runs end with their document
        count = lambda v: (lambda s: s[c.ends] - s[c.starts])(np.r_[0, np.cumsum(v)]).astype(np.int64)
        removed = count(drop)
        kept = [s if not r else c.x[lo:hi][~drop[lo:hi]].tobytes() for s, r, lo, hi in zip(c.texts, removed, c.starts, c.ends)]
        cols = {
            "doc_id": pa.array(c.ids, pa.int64()), "n_bytes": pa.array(c.lens, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(count(opens), pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(s).hexdigest() for s in kept], pa.string()),
        }
        return pa.table(cols | ({"kept_bytes": pa.array(kept, pa.binary())} if with_text else {}))

    return cut


def suffix_dedup(docs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_bytes of every row of ``docs``(doc_id, text)."""
    n = buckets_of(docs.sparkSession) * BUCKETS
    chunked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").withColumn("chunk", id_chunk(docs, "doc_id", rows_per_chunk))
    sent = chunked.groupBy("chunk").applyInArrow(_send_triggers(n), PACKED_DDL)
    shared = sent.groupBy("bucket").applyInArrow(shared_keys, PACKED_DDL)
    phrases = chunked.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_send_phrases(n), PACKED_DDL)
    earlier = phrases.groupBy("bucket").applyInArrow(_earlier_suffixes, PACKED_DDL)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text
    return chunked.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(_cut(with_text), schema)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), with_text=False)


OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM d),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS b FROM p WHERE 2 * i + 100 <= length(h)),
g AS (SELECT b, min(doc_id) AS f FROM s GROUP BY b HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT s.doc_id, s.i FROM s JOIN g ON s.b = g.b WHERE g.f < s.doc_id),
near AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit),
gone AS (SELECT doc_id, unnest(range(CASE WHEN before IS NULL OR before + 50 <= i THEN i ELSE before + 50 END, i + 50)) AS i, FROM near),
spans AS (SELECT doc_id, count(*) AS n_spans FROM near WHERE before IS NULL OR before + 50 < i GROUP BY doc_id),
per AS (
  SELECT p.doc_id, count(gone.i) AS n_removed, coalesce(string_agg(CASE WHEN gone.i IS NULL THEN substr(p.h, 2 * p.i + 1, 2) END, '' ORDER BY p.i), '') AS kept
  FROM p SEMI JOIN spans ON spans.doc_id = p.doc_id LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.i = p.i GROUP BY p.doc_id)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(per.n_removed, 0)::BIGINT AS n_removed,
  coalesce(spans.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(per.kept, d.h))) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN spans USING (doc_id)
"""
