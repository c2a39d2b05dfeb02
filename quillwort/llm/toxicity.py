"""Toxicity classifier on subword bags (operator 2).

A word's vector is the mean of the embeddings of its hashed character n-grams (3 to 6, with word marks) and of itself; a
text's vector is the mean over all its words; a linear softmax gives two class probabilities.  A misspelling or an
inflection that was never seen shares most n-grams with a word that was.

Embeddings and softmax are trained together, in numpy, on standardised bags, by accelerated proximal gradient steps in two
turns: with a group penalty on each n-gram's embedding, which leaves only n-grams with evidence in many texts (a rare word
of one toxic text is no evidence), and then, those n-grams alone, with a small ridge.  The penalty follows from the
sizes of the two classes, so that it means the same at every size of the sample.  All words of the sample take part.

Training: labelled rows of the training folds only (crc32 of doc_id as text, mod 3, is not 1), at most ``PER_CLASS``
rows of each label, chosen by hash of doc_id: the only bound.  Every text is scored whole.  Label, lang, source and
doc_id are no inputs of a score.  Sums by n-gram are made in the tasks; only n-grams whose sums differ between the
classes reach the driver.

As mean and softmax are linear, a word adds a fixed amount to the logit; a task remembers these amounts by word, up to a
bound, so scoring costs one look-up a word.  The model that tasks receive is one number for each n-gram kept.

Null and empty texts score by the intercept.  Null doc_id: never learnt from, held_out false.  A doc_id with several
label rows is learnt from once a row.  No labels at all, or of one class: the score is the smoothed share of label 1.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillwort.llm.common import checkpointed, table, slices

BUCKETS = 1 << 20
DIM = 4
STEPS = 300
PER_CLASS = 1500
THRESHOLD = 0.7
#: Words of no weight that join every text, so that two or three words alone decide little.
NEUTRAL = 10
#: The group penalty, in standard errors of the difference of the two classes' means.
PENALTY = 3.0
#: N-grams whose first gradient is below this share of the penalty are left out at once.
SCREEN = 0.7
RIDGE = 1e-3
#: Weight of the empty text as a clean one.
EMPTY = 0.2
WORD = re.compile(r"[^\W_]+(?:['-][^\W_]+)*")


def fold(doc_id: str | Column, k: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % k if isinstance(doc_id, str) else F.crc32(doc_id.cast("string").cast("binary")) % k


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(word: str) -> list[int]:
    w = f"<{word}>"
    out = [zlib.crc32(w.encode(), 1) % BUCKETS]
    for n in (3, 4, 5, 6):
        out += [zlib.crc32(w[i : i + n].encode(), n) % BUCKETS for i in range(len(w) - n + 1)]
    return out


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and shares of a text's n-grams: each word's n-grams share equally in the word, the words in the text."""
    counts = Counter(words_of(text))
    n = sum(counts.values()) + NEUTRAL
    g = [grams(w) for w in counts]
    if not g:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at, place = np.unique(np.concatenate(g), return_inverse=True)
    share = np.bincount(place, np.repeat([c / len(x) / n for c, x in zip(counts.values(), g)], [len(x) for x in g]))
    return at.astype(np.int32), share.astype(np.float32)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int) -> DataFrame:
    """(y, text) of at most per_class labelled rows of each class that ``train`` admits, chosen by hash of doc_id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(train & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    ranked = lambda y: rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    chosen = ranked(0).unionByName(ranked(1))  # at most 2 * per_class ids: that bounds the broadcast
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")


def bags(sample: DataFrame) -> DataFrame:
    """doc_id, y, and the bag (``at``, ``share``) of every text of the sample, kept in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [bag(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([g for g, _ in got], pa.list_(pa.int32())), pa.array([v for _, v in got], pa.list_(pa.float32()))], names=["doc_id", "y", "at", "share"])

    return checkpointed(sample.mapInArrow(run, "doc_id long, y int, at array<int>, share array<float>"))


def sums(found: DataFrame) -> DataFrame:
    """at, and of each class the sums of shares and of their squares (s0, s1, q0, q1), as integers: sums that do not depend on order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, BUCKETS), np.int64)
        for b in batches:
            for y, at, share in zip(b.column("y").to_pylist(), b.column("at"), b.column("share")):
                at, share = at.values.to_numpy(), share.values.to_numpy().astype(np.float64)
                total[y, at] += np.round(share * 2.0**40).astype(np.int64)
                total[2 + y, at] += np.round(share * share * 2.0**48).astype(np.int64)
        some = np.flatnonzero(total[0] + total[1])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(v[some]) for v in total)], names=["at", "s0", "s1", "q0", "q1"])

    # The sample is bounded, so a few tasks add it up; each sends a row for each bucket at most.
    parts = found.coalesce(4).mapInArrow(run, "at long, s0 long, s1 long, q0 long, q1 long")
    return parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("s0", "s1", "q0", "q1")])


def evident(found: DataFrame, n0: int, n1: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that pass the screen, ascending, and their spreads."""
    mean = lambda c, n, scale: F.col(c) / F.lit(2.0 * scale * n)
    m0, m1 = mean("s0", n0, 2.0**40), mean("s1", n1, 2.0**40)
    spread = F.sqrt(F.greatest(mean("q0", n0, 2.0**48) + mean("q1", n1, 2.0**48) - (m0 + m1) * (m0 + m1), F.lit(1e-18)))
    kept = sums(found).select("at", spread.alias("spread"), (F.abs(m0 - m1) / 2).alias("slope")).where(F.col("slope") > SCREEN * group_penalty(n0, n1) * F.col("spread"))
    got = kept.select("at", "spread").orderBy("at").toArrow()
    return got.column("at").to_numpy(), got.column("spread").to_numpy()


def group_penalty(n0: int, n1: int) -> float:
    return PENALTY * 0.25 * float(np.sqrt(1 / n1 + 1 / n0))


def design(found: DataFrame, columns: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sample's standardised bags over the columns only, and the labels, in a fixed order of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place, value = [], []
            for at, share in zip(b.column("at"), b.column("share")):
                at, share = at.values.to_numpy(), share.values.to_numpy()
                p = np.searchsorted(columns, at)
                p[p == len(columns)] = 0
                held = columns[p] == at
                place.append(p[held].astype(np.int32))
                value.append((share[held] / spread[p[held]]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(place, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], names=["doc_id", "y", "place", "value"])

    got = found.mapInArrow(run, "doc_id long, y int, place array<int>, value array<float>").toArrow()
    place, value = got.column("place"), got.column("value")
    order = sorted(zip(got.column("doc_id").to_pylist(), got.column("y").to_pylist(), range(got.num_rows)), key=lambda r: (r[0], r[1], value[r[2]].values.to_numpy().tobytes()))
    x = np.zeros((len(order), len(columns)), np.float32)
    for row, (_, _, k) in enumerate(order):
        x[row, place[k].values.to_numpy()] = value[k].values.to_numpy()
    return x, np.array([y for _, y, _ in order], np.int64)


class Adam:
    def __init__(self, *params: np.ndarray, rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, *grads: np.ndarray) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)


def segment_sums(rows: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """Sums of value rows by row number (ascending or not), into n rows."""
    return np.stack([np.bincount(rows, values[:, j], n) for j in range(values.shape[1])], axis=1)


class Descent:
    """Full-batch training of embeddings (one row for each column of x) and softmax together."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.x, self.weight, self.target = x, weight.astype(np.float32), np.eye(2, dtype=np.float32)[y]
        rng = np.random.default_rng(2)
        self.embedding = np.zeros((x.shape[1], DIM), np.float32)
        self.softmax = self.normed(rng.normal(0, 1, (DIM, 2)).astype(np.float32))
        self.bias = np.zeros(2, np.float32)

    @staticmethod
    def normed(w: np.ndarray) -> np.ndarray:
        """The softmax's scale is fixed: else it could grow to evade the penalty on the embeddings."""
        w = w - w.mean(1, keepdims=True)
        return w / np.linalg.norm(w[:, 1] - w[:, 0])

    def step_size(self) -> float:
        v, size = np.random.default_rng(3).normal(size=self.x.shape[1]).astype(np.float32), 0.0
        for _ in range(20):  # the largest eigenvalue, by power iteration
            v = self.x.T @ (self.weight * (self.x @ v))
            size = float(np.linalg.norm(v))
            v /= size or 1.0
        return 1 / (0.25 * size + 0.05)

    def run(self, penalty: float, ridge: float) -> None:
        rate, t, ahead = self.step_size(), 1.0, self.embedding.copy()
        for _ in range(STEPS):
            mean = self.x @ ahead
            z = mean @ self.softmax + self.bias
            p = np.exp(z - z.max(1, keepdims=True))
            dz = (p / p.sum(1, keepdims=True) - self.target) * self.weight[:, None]
            nxt = ahead - rate * (self.x.T @ (dz @ self.softmax.T) + ridge * ahead)
            nxt *= np.maximum(0, 1 - rate * penalty / np.maximum(np.linalg.norm(nxt, axis=1, keepdims=True), 1e-12))
            t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            ahead = nxt + np.float32((before - 1) / t) * (nxt - self.embedding)
            self.embedding = nxt
            self.softmax = self.normed(self.softmax - 0.1 * (mean.T @ dz))
            empty = 1 / (1 + np.exp(self.bias[0] - self.bias[1]))  # the empty text is clean
            self.bias -= dz.sum(0) + EMPTY * np.array([-empty, empty], np.float32)

    def kept(self, columns: np.ndarray) -> None:
        self.x, self.embedding = np.ascontiguousarray(self.x[:, columns]), self.embedding[columns]


def train(sample: DataFrame) -> tuple[dict[int, float], float]:
    """The logit of each n-gram bucket that is kept, and the intercept, from a sample(doc_id, y, text).

    Sums by bucket are made in the tasks; the driver receives the columns that pass the screen.
    """
    found = bags(sample)
    count = {r["y"]: r["n"] for r in found.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = count.get(0, 0), count.get(1, 0)
    if not n0 or not n1:
        return {}, float(np.log((n1 + 0.5) / (n0 + 0.5)) if n0 + n1 else -3.0)
    columns, spread = evident(found, n0, n1)
    if not len(columns):
        return {}, 0.0
    x, y = design(found, columns, spread)
    d = Descent(x, y, np.where(y == 1, 0.5 / n1, 0.5 / n0))
    d.run(group_penalty(n0, n1), 0.0)
    some = np.flatnonzero(np.linalg.norm(d.embedding, axis=1))
    d.kept(some)
    d.run(0.0, RIDGE)
    logit = (d.embedding @ (d.softmax[:, 1] - d.softmax[:, 0])).astype(np.float64) / spread[some]
    return dict(zip(columns[some].tolist(), logit.tolist())), float(d.bias[1] - d.bias[0])


class WordLogits(dict):
    """A word's part of the logit, remembered up to a bound."""

    LIMIT = 300_000

    def __init__(self, by_gram: dict[int, float]):
        super().__init__()
        self.by_gram = by_gram

    def __missing__(self, word: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        g = grams(word)
        self[word] = v = sum(self.by_gram[x] for x in g if x in self.by_gram) / len(g)
        return v


def scored(docs: DataFrame, labels: DataFrame, with_text: bool = True) -> DataFrame:
    """The columns of every row of ``docs`` (all, or all but the text) and its score."""
    by_gram, bias = train(labelled_sample(docs, labels, "toxic", fold("doc_id", 3) != 1, PER_CLASS))
    schema = docs.schema if with_text else docs.drop("text").schema
    columns = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordLogits(by_gram)
        for b in slices(batches):
            scores = []
            for t in b.column("text").to_pylist():
                ws = words_of(t)
                z = bias + (sum(map(known.__getitem__, ws)) / (len(ws) + NEUTRAL))
                scores.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            yield pa.RecordBatch.from_arrays([*map(b.column, columns), pa.array(scores, pa.float64())], names=[*columns, "score"])

    return docs.mapInArrow(run, StructType([*schema.fields, StructField("score", DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``(doc_id, text)."""
    got = scored(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), labels, with_text=False)
    return got.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
