"""SimHash near-dedup of the pipeline: operator 8 on 5-word shingles, with similarities counted on the texts.

A-Z lower-cased; words are runs of ``[^\\x20\\x09-\\x0D]``; a text is the set of its 5-word shingles (fewer words: the whole
sequence; none: the empty set).  Two texts are linked if their sets' Jaccard similarity is 0.8 or more; of every component
of links one row stays: the least doc_id (null last), then the least hash of the row.

Which texts are compared:

* SimHash: operator 8's fingerprints, pivot table, links within its 2 bits and components, over these shingles; every text
  meets the first text of its component.
* At a similarity of 0.8 fingerprints differ in about 10 bits and often in 15, a radius at which pivot distances discard hardly
  a pair (README has the figures).  So texts meet by rare shingles, too.  With o common shingles, the similarity is 0.8 or more
  if and only if 9 * o >= 4 * (n1 + n2), so in any one global order the first common shingle stands in the first fifth of both
  sets.  Frequent shingles come last in the order: each has the count of its bucket of hashes over *all* texts, of which there are
  ``BUCKETS``.  The order decides how many texts meet, not which are linked.
* In ``ROUNDS`` rounds a text meets the least and the greatest text of each of these shingles, by component so far: that with most
  shingles in common and that with the nearest fingerprint.  This joins large groups of copies by a few meetings a text.
* In up to ``NEAREST`` rounds, until one finds nothing, each text meets the nearest one, by parities (below), of those in other components that
  share one of these shingles.  So a group of edited copies, which are alike to their model but hardly to each other, becomes one component.
* Then *every* two texts that share one of these shingles and stand in different components are compared (``crossing``).  So no link
  between two components is lost, whatever the texts: only pairs that are joined already are left out.  Shingles with the same least and the
  same greatest text make one group (``groups_of``), so that texts with many shingles in common meet once; a group's texts are cut into
  blocks of ``BLOCK``, and each two blocks meet in a task of their own.  A pair goes on to its texts unless counts of shingles or parities rule it out:
  of a set, bit k tells whether the number of shingles of residue k is odd, so two sets differ in at least as many
  shingles as bits, and sets that are alike in (n1 + n2) / 9 at most.  Both tests are exact.

Shingles are named by 64-bit hashes and sets by 128-bit ones; the similarity of a candidate is counted on its texts.  Null text: as
empty.  Empty tables give empty results; other columns, whatever their names, are kept as they are.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import NAMES, Key, checkpointed, in_sorted, mixed, numbers, planes, sized, slices
from quillwort.llm.simhash import LINKS, components, links, majority, pivot_table

SHINGLE = 5
#: Differing bits of 64 beyond which a text's few meetings in a round do not count.
RADIUS = 24
#: Buckets of shingle hashes that are counted over all texts, and in how many rows the counts travel.
BUCKETS, ROWS = 1 << 21, 64
#: From what count on a bucket is frequent, and how many are remembered, highest counts first.
OFTEN = 3
FREQUENT = 200_000
#: Partners that are compared with a text in one group.
GROUP = 100
#: Rounds in which texts meet a few others by shingles, before all of different components do.
ROUNDS = 1
#: Rounds in which a text meets the nearest one of another component.
NEAREST = 2
#: Texts of a shingle that meet in one task.
BLOCK = 400
#: Pairs that a task holds at a time, beside those of one group.
PAIRS = 50_000
#: Most bits of a set's parities.
PARITIES = 1 << 15
#: Rows of two or three numbers are broadcast up to so many, counted first.
BROADCAST_ROWS = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """The set of a text's shingle hashes, ascending."""
    x = NAMES.array((text or "").encode().lower().split())  # bytes.lower() changes A-Z only
    if not len(x):
        return x
    width = min(SHINGLE, len(x))
    h = np.zeros(len(x) - width + 1, np.uint64)
    for k in range(width):
        h = h * _BASE + x[k : k + len(h)]
    return np.unique(mixed(h, width))


def name_of(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def parities(s: np.ndarray) -> bytes:
    """Bit k of a bit a shingle or more, a power of two: whether the number of hashes of residue k is odd."""
    width = 64
    while width < min(len(s), PARITIES):
        width *= 2
    return np.packbits((np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    return 9 * int(in_sorted(a, b).sum()) >= 4 * (len(a) + len(b))


def bucket_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64)


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of hashes that stand out, and how many shingles of all texts fall in each.  Totals are merged by Spark, each row a range of buckets."""
    width = BUCKETS // ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in slices(batches):
            total += np.bincount(np.concatenate([bucket_of(shingles(t)) for t in b.column("text").to_pylist()] or [np.zeros(0, np.int64)]), minlength=BUCKETS)
        for row in range(ROWS):
            part = total[row * width : (row + 1) * width]
            at = np.flatnonzero(part)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([at.astype(np.uint16 if width <= 1 << 16 else np.uint32).tobytes()]), pa.array([planes(part[at])])], names=["row", "at", "n"])

    def merged(key: Key, t: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for at, n in zip(t.column("at").to_pylist(), t.column("n").to_pylist()):
            total[np.frombuffer(at, np.uint16 if width <= 1 << 16 else np.uint32)] += numbers(n)
        usual = total.mean()
        at = np.flatnonzero((total >= OFTEN) & (total > usual + 4 * usual**0.5))
        return pa.table({"bucket": pa.array(key[0].as_py() * width + at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "row long, at binary, n binary").groupBy("row").applyInArrow(merged, "bucket long, n long")
    got = rows.orderBy(F.desc("n"), "bucket").limit(FREQUENT).toArrow()
    return got.column("bucket").to_numpy(), got.column("n").to_numpy()


def named(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, tie, name (of the text's set), fp (its fingerprint), n (its size), bits (its parities) and prefix (the first fifth of its
    shingles in the global order) of every row of docs(doc_id, tie, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(BUCKETS, np.int64)
        often[hot[0]] = hot[1]

        def prefix(s: np.ndarray) -> np.ndarray:
            return s[np.argsort(often[bucket_of(s)], kind="stable")][: len(s) // 5 + 1].view(np.int64)  # s is ascending

        for b in slices(batches):
            name, fp, n, bits, first = [], [], [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t)
                name.append(name_of(s))
                bits.append(parities(s))
                fp.append(majority(s))
                n.append(len(s))
                first.append(prefix(s))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("tie"), pa.array(name, pa.binary()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(n, pa.int32()), pa.array(bits, pa.binary()), pa.array(first, pa.list_(pa.int64()))],
                names=["doc_id", "tie", "name", "fp", "n", "bits", "prefix"],
            )

    return docs.select("doc_id", "tie", "text").mapInArrow(run, "doc_id long, tie long, name binary, fp long, n int, bits binary, prefix array<long>")


@contextlib.contextmanager
def few_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Only what is marked is broadcast.  On small tables Spark would turn every join of every round into a broadcast, each of which
    takes memory and a thread of the driver, more than the rows themselves."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def bounded(df: DataFrame) -> DataFrame:
    """Marked for a broadcast if it has few enough rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _enough(common: Column, n1: Column, n2: Column) -> Column:
    """False only if sets with so many common prefix shingles cannot be alike: up to the lesser of the prefixes' last
    shingles all common ones are counted, and beyond it at most the rest of that set can be common."""
    rest = lambda n: n - F.floor(n / F.lit(5)) - 1
    return 9 * (common + F.greatest(rest(n1), rest(n2))) >= 4 * (n1 + n2)


def verified(pairs: DataFrame, first: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose texts are alike.  ``first`` has the row (doc_id, tie) of each set, ``rows`` the texts."""
    n = pairs.count()
    if not n:
        return pairs.select("a", "b")
    pairs = sized(pairs, LINKS, n)
    parts = checkpointed(pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(GROUP)).cast("int").alias("parts")))
    members = pairs.join(bounded(parts), "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("sid"))
    heads = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("sid"))
    met = bounded(checkpointed(members.unionByName(heads)))
    wanted = checkpointed(first.select("sid", F.col("first.doc_id").alias("_id"), F.col("first.tie").alias("_tie")).join(met, "sid"))
    texts = rows.join(bounded(wanted), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))).select("a", "part", "sid", "text")

    def compare(t: pa.Table) -> pa.Table:
        sid, text = t.column("sid").to_pylist(), t.column("text").to_pylist()
        a = t.column("a")[0].as_py()
        if a not in sid:
            raise ValueError("a group without its first text")
        own = shingles(text[sid.index(a)])
        near = sorted({i for i, x in zip(sid, text) if i != a and alike(own, shingles(x))})
        return pa.table({"a": pa.array([a] * len(near), pa.int64()), "b": pa.array(near, pa.int64())})

    return texts.groupBy("a", "part").applyInArrow(compare, "a long, b long")


def simhash_meetings(sets: DataFrame) -> DataFrame:
    """(a, b): every set b of sets(sid, fp) with the first set of its SimHash component."""
    pivoted = checkpointed(pivot_table(sets.groupBy("fp").agg(F.min("sid").alias("least"))))
    roots = checkpointed(components(links(pivoted)))
    rooted = pivoted.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")).select("fp", "least", "root")
    first = rooted.groupBy("root").agg(F.min("least").alias("a"))
    return sets.join(rooted.join(first, "root").select("fp", "a"), "fp").where("sid <> a").select("a", F.col("sid").alias("b"))


def shared_postings(prefixes: DataFrame) -> DataFrame:
    """(token, lo, hi, sid) of the prefix shingles that two or more sets have, and the least and the greatest of these."""
    postings = prefixes.select("sid", F.explode("prefix").alias("token"))
    ends = postings.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo < hi")
    return sized(checkpointed(postings.join(ends, "token").select("token", "lo", "hi", "sid")), LINKS)


def shingle_meetings(sets: DataFrame, shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): every set b with the best of the ends of its tokens; the ends are the least and the greatest by component, and
    meet sets of other components only."""
    side = lambda k: sets.select(*[F.col(c).alias(f"{c}{k}") for c in ("sid", "fp", "n")])
    rooted = shared.join(roots, "sid", "left").withColumn("at", F.struct(F.coalesce("root", "sid").alias("root"), "sid")).select("token", "at")
    ends = rooted.groupBy("token").agg(F.min("at").alias("rep"), F.max("at").alias("top")).where("rep.root < top.root")
    other = F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("rep").alias("at")), F.struct(F.lit(1).alias("end"), F.col("top").alias("at")))).alias("o")
    met = rooted.join(ends, "token").select("at", other).where("at.root <> o.at.root").select(F.col("at.sid").alias("sid2"), "o.end", F.col("o.at.sid").alias("sid1"))
    common = met.groupBy("sid1", "sid2", "end").agg(F.count("*").alias("common")).join(side(1), "sid1").join(side(2), "sid2")
    unlike = F.bit_count(F.col("fp1").bitwiseXOR(F.col("fp2")))
    able = common.where(_enough(F.col("common"), F.col("n1"), F.col("n2")) & (unlike <= RADIUS))
    best = able.groupBy("sid2", "end").agg(F.max(F.struct("common", "sid1")).alias("m"), F.min(F.struct(unlike.alias("unlike"), "sid1")).alias("f"))
    return best.select(F.explode(F.array("m.sid1", "f.sid1")).alias("a"), F.col("sid2").alias("b"))


def _unlike(n: np.ndarray, bits: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many parities of the sets a[k] and b[k] differ, at the lesser width of the two."""
    width = np.array([len(x) for x in bits])
    least, out = np.minimum(width[a], width[b]), np.zeros(len(a), np.int64)
    for w in np.unique(least):
        at = least == w
        folded = {}
        for k in np.unique(np.r_[a[at], b[at]]).tolist():
            x = np.frombuffer(bits[k], np.uint64)
            while x.nbytes > w:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            folded[k] = x
        out[at] = [int(np.bitwise_count(folded[i] ^ folded[j]).sum()) for i, j in zip(a[at].tolist(), b[at].tolist())] if at.sum() < 64 else _distances(folded, a[at], b[at])
    return out


def _distances(folded: dict[int, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    place = {k: i for i, k in enumerate(folded)}
    rows = np.stack(list(folded.values()))
    left, right = (np.fromiter((place[k] for k in x.tolist()), np.int64, len(x)) for x in (a, b))
    return np.concatenate([np.bitwise_count(rows[left[k : k + 10_000]] ^ rows[right[k : k + 10_000]]).sum(1, dtype=np.int64) for k in range(0, len(left), 10_000)])


def _able(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of a group (lo, hi, i, j) that stand in different components and can be alike, and in how many parities they differ."""
    sid, root, n, own, i, j = (t.column(c).to_numpy() for c in ("sid", "root", "n", "own", "i", "j"))
    if len(sid) < 2 or (root == root[0]).all():
        return sid[:0], sid[:0], sid[:0]
    ok = (root[:, None] != root) & (5 * np.minimum(n[:, None], n) >= 4 * np.maximum(n[:, None], n))
    # In the task of blocks i < j a set of i meets one of j; within a block each two meet once.
    ok &= ((own == i)[:, None] & (own == j)) if i[0] < j[0] else np.triu(np.ones(ok.shape, bool), 1)
    a, b = np.nonzero(ok)
    far = _unlike(n, t.column("bits").to_pylist(), a, b) if len(a) else np.zeros(0, np.int64)
    near = 9 * far <= n[a] + n[b]
    return sid[a][near], sid[b][near], far[near]


def _distinct(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once."""
    order = np.lexsort((b, a))
    a, b, far = a[order], b[order], far[order]
    first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return a[first], b[first], far[first]


def _nearest(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of each set, from either side, the nearest."""
    a, b, far = np.r_[a, b], np.r_[b, a], np.r_[far, far]
    order = np.lexsort((b, far, a))
    a, b, far = a[order], b[order], far[order]
    first = np.r_[True, a[1:] != a[:-1]] if len(a) else np.zeros(0, bool)
    return a[first], b[first], far[first]


def groups_of(shared: DataFrame) -> DataFrame:
    """(lo, hi, sid): the sets of the shingles whose least set is lo and greatest is hi, each once.

    Near copies have many prefix shingles in common, most of them with the same ends: they meet in one group, not once a shingle.
    Every two sets that share a shingle share a group; others in it are told apart by what tells apart those of one shingle.
    """
    return sized(checkpointed(shared.select("lo", "hi", "sid").distinct()), LINKS)


def crossing(sets: DataFrame, groups: DataFrame, roots: DataFrame, nearest: bool = False) -> DataFrame:
    """(a, b): all sets of different components that share a group and can be alike; ``nearest``: only the nearest b of each a."""
    rooted = groups.join(roots, "sid", "left").select("lo", "hi", "sid", F.coalesce("root", "sid").alias("root"))
    several = rooted.groupBy("lo", "hi").agg(F.min("root").alias("first"), F.max("root").alias("last"), F.count("*").alias("m")).where("first < last")
    blocks = several.select("lo", "hi", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    rows = rooted.join(blocks, ["lo", "hi"]).join(sets.select("sid", "n", "bits"), "sid").withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lo", "hi", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sid", "root", "n", "bits"
    )

    def once(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        a, b, far = (np.concatenate([f[k] for f in found]) for k in range(3))
        return _nearest(a, b, far) if nearest else _distinct(np.minimum(a, b), np.maximum(a, b), far)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        out = lambda f: pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in f], names=["a", "b", "far"])
        for t in _each(batches):
            found.append(_able(t))
            size += len(found[-1][0])
            if size > PAIRS:  # what a task finds again does not go on again
                found = [once(found)]
                if len(found[0][0]) > PAIRS // 2:
                    yield out(found.pop())
                size = sum(len(f[0]) for f in found)
        if size:
            yield out(once(found))

    pairs = met.repartition("lo", "hi", "i", "j").sortWithinPartitions("lo", "hi", "i", "j").mapInArrow(run, "a long, b long, far long")
    return pairs.groupBy("a").agg(F.min(F.struct("far", "b")).alias("m")).select("a", "m.b") if nearest else pairs.select("a", "b").distinct()


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups of rows sorted by (lo, hi, i, j), one after the other."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b] if rest is None else [*rest.to_batches(), b])
        if t.num_rows:
            key = [t.column(c).to_numpy() for c in ("lo", "hi", "i", "j")]
            cuts = [0, *(np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in key])) + 1).tolist()]
            yield from (t.slice(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:]))
            rest = t.slice(cuts[-1])
    if rest is not None:
        yield rest


def near_groups(first: DataFrame, prefixes: DataFrame, rows: DataFrame) -> DataFrame:
    """sid and root of the sets that are linked to another."""
    sets = first.where("n > 0").select("sid", "fp", "n", "bits")
    ordered = lambda pairs: checkpointed(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rooted = lambda edges: bounded(components(edges).select(F.col("fp").alias("sid"), "root"))

    def joined(roots: DataFrame, pairs: DataFrame) -> DataFrame:
        """Components so far stand for the links they come from, so a round's few links are joined to stars, not to all links again."""
        found = checkpointed(verified(pairs, first, rows))
        return roots if found.isEmpty() else rooted(roots.select(F.col("root").alias("a"), F.col("sid").alias("b")).unionByName(found))

    roots = rooted(verified(ordered(simhash_meetings(sets)), first, rows))
    shared = shared_postings(prefixes)
    groups = groups_of(shared)
    for _ in range(ROUNDS):
        roots = joined(roots, ordered(shingle_meetings(sets, shared, roots)))
    for _ in range(NEAREST):
        before, roots = roots, joined(roots, ordered(crossing(sets, groups, roots, nearest=True)))
        if roots is before:
            break
    return joined(roots, checkpointed(crossing(sets, groups, roots)))


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row, all columns, of each component of near copies."""
    unused = "_" * (1 + max(len(c) for c in docs.columns))
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(unused, F.xxhash64(*docs.columns))
    narrow = rows.select("doc_id", F.col(unused).alias("tie"), "text")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    with few_broadcasts(docs.sparkSession):
        sets = checkpointed(named(narrow, frequent(docs)))
        first = checkpointed(sets.groupBy("name").agg(*[F.first(c).alias(c) for c in ("fp", "n", "bits")], F.min(at).alias("first"))).withColumn("sid", F.monotonically_increasing_id())
        # Of sets with many copies, one row's prefix goes on.
        prefixes = sets.join(first.select("sid", "name", "first"), "name").where(at == F.col("first")).select("sid", "prefix").dropDuplicates(["sid"])
        roots = near_groups(first, prefixes, narrow)
    kept = first.join(roots, "sid", "left").groupBy(F.coalesce("root", "sid").alias("root")).agg(F.min("first").alias("first"))
    # Null ids need columns of their own, so that one exchange of the texts does for the join and for rows equal in all columns, which are one row here.
    key = [unused + c for c in ("id", "none", "tie")]
    named_by = lambda df, doc_id, tie: df.withColumns(dict(zip(key, (F.coalesce(doc_id, F.lit(0).cast("long")), doc_id.isNull(), tie))))
    kept = named_by(kept, F.col("first.doc_id"), F.col("first.tie")).select(*key)
    return named_by(rows, F.col("doc_id"), F.col(unused)).join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns)
