from pyspark.sql import functions as F

from quillwort.llm import fingerprint


def test_likeness_of_a_phrase_repeated_70000_times(spark):
    """Lanes of over 2**15 equal units do not wrap."""
    d = spark.range(3).select(F.col("id").alias("k"), F.expr("repeat('one two three\\n', element_at(array(70000, 65536, 43690), cast(id + 1 as int)))").alias("t"))
    v = {r["k"]: r["v"] for r in fingerprint.fingerprinted(d, ["k"], "t").collect()}
    assert [v[k]["n"] for k in range(3)] == [70000, 65536, 43690]
    f = fingerprint.fingerprinted(d, ["k"], "t").groupBy().agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(c) for k, c in enumerate("abc")])
    r = f.select(fingerprint.likeness("a", "b").alias("ab"), fingerprint.likeness("b", "c").alias("bc")).first()
    want = lambda m, n: 1 - (m - n) ** 2 / (m * m + n * n)
    assert abs(r["ab"] - want(70000, 65536)) < 1e-9 and abs(r["bc"] - want(65536, 43690)) < 1e-9
