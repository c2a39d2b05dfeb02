"""Quality classifier: a factorisation machine (operator 10).

Features of a whole text: hashed words (share of the text's words, square-rooted), statistics of its structure, and its
length as metadata.  The machine adds to a linear model the interaction of every pair of features, with weights of low
rank: sum over i < j of <v_i, v_j> x_i x_j, which is half of sum over f of (sum of v_if x_i)^2 - sum of (v_if x_i)^2, so a
score takes time linear in the features present.  Linear weights and factors are trained together by full-batch Adam.

Training: labelled rows whose crc32 of doc_id as text, mod 5, is not 0; at most ``PER_CLASS`` rows of each label, chosen
by hash of doc_id.  That bound on the sample is the only one; every text is scored whole.  Label, lang, source and
doc_id are no inputs of a score.

Null and empty texts score by their (zero) statistics.  Null doc_id: never learnt from, held_out false.  No labels, or of
one class only: the score is the smoothed share of label 1.  Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import table
from quillwort.llm.toxicity import Adam, fold, labelled_sample, segment_sums

BUCKETS = 1 << 13
RANK = 6
EPOCHS = 60
PER_CLASS = 1000
THRESHOLD = 0.3
STATISTICS = ("length", "word_length", "distinct", "upper", "digit", "punctuation", "symbol", "bar", "line", "repeat", "top", "blank", "long_line")
_KIND = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"()-", b"!@#$%^&*+=~<>{}[]_/\\?", b"|", b"\n", b" \t\r"), 1):
    _KIND[list(_chars)] = _k


class Hashed(dict):
    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = v = len(STATISTICS) + zlib.crc32(word) % BUCKETS
        return v


HASHED = Hashed()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text; the statistics come first."""
    raw = (text or "").encode()
    words = raw.lower().split()
    n, size = max(1, len(words)), max(1, len(raw))
    counts = Counter(words)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8) / size
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    stats = [
        np.log1p(len(words)) / 10, min(3.0, size / n / 10), len(counts) / n, *kinds[1:6], min(1.0, kinds[6] * 10), repeats / n,
        max(counts.values(), default=0) / n, kinds[7], np.log1p(max(map(len, raw.split(b"\n")))) / 10,
    ]
    ids = np.fromiter(map(HASHED.__getitem__, counts), np.int64, len(counts))
    x = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)) / n)
    return np.r_[np.arange(len(STATISTICS)), ids], np.r_[stats, x]


def fm(ids: np.ndarray, x: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray) -> float:
    vx = v[ids] * x[:, None]
    s = vx.sum(0)
    return float(w0 + w[ids] @ x + 0.5 * (s @ s - (vx * vx).sum()))


def train(sample: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    n = len(STATISTICS) + BUCKETS
    y = np.array([r[0] for r in sample], np.float64)
    if len(set(y.tolist())) < 2:
        return float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else 0.0), np.zeros(n), np.zeros((n, RANK))
    d = np.repeat(np.arange(len(sample)), [len(r[1]) for r in sample])
    i, x = np.concatenate([r[1] for r in sample]), np.concatenate([r[2] for r in sample])
    rng = np.random.default_rng(10)
    w0, w, v = np.zeros(1), np.zeros((n, 1)), rng.normal(0, 0.05, (n, RANK))
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    adam = Adam(w0, w, v, rate=0.05)
    for _ in range(EPOCHS):
        vx = v[i] * x[:, None]
        s = segment_sums(d, len(y), vx)
        z = w0 + segment_sums(d, len(y), np.c_[w[i, 0] * x, (vx * vx).sum(1)]) @ np.array([1.0, -0.5]) + 0.5 * (s * s).sum(1)
        e = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight
        g = segment_sums(i, n, np.c_[e[d] * x, (e[d] * x)[:, None] * (s[d] - vx)])
        adam.step(np.array([e.sum()]), g[:, :1] + 1e-5 * w, g[:, 1:] + 1e-4 * v)
    return float(w0[0]), w[:, 0], v


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``(doc_id, text)."""

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fs = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([f[0] for f in fs], pa.list_(pa.int64())), pa.array([f[1] for f in fs], pa.list_(pa.float64()))], names=["doc_id", "y", "ids", "x"])

    got = labelled_sample(docs, labels, "quality", fold("doc_id", 5) != 0, PER_CLASS).mapInArrow(featured, "doc_id long, y int, ids array<long>, x array<double>").toArrow()
    rows = sorted(zip(got.column("doc_id").to_pylist(), got.column("y").to_pylist(), range(got.num_rows)))
    ids, xs = got.column("ids"), got.column("x")
    w0, w, v = train([(y, ids[k].values.to_numpy(), xs[k].values.to_numpy()) for _, y, k in rows])
    w, v = w.astype(np.float32), v.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.array([fm(*features(t), w0, w, v) for t in b.column("text").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))), pa.float64())], names=["doc_id", "score"])

    scored = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
