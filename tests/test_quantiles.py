import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelwise.functions import prefix
from parcelwise.functions.prefix import bucketed, positions, running_totals
from parcelwise.functions import quantiles
from parcelwise.functions.quantiles import average_ranks, column_quantiles, exact_quantiles, hash_sample


@pytest.fixture(scope="module")
def skewed(spark):
    """Big enough for brackets; a third of all rows is one value."""
    rng = np.random.default_rng(1)
    x = np.concatenate([np.zeros(20_000), rng.normal(size=25_000), rng.integers(0, 50, 15_000)])
    y = rng.exponential(size=3_000)
    pdf = pd.DataFrame({"k": ["x"] * len(x) + ["y"] * len(y), "v": np.concatenate([x, y])})
    return spark.createDataFrame(pdf).repartition(7).persist(), x, y


def test_exact_quantiles(skewed):
    df, x, y = skewed
    probs = [0.5, 0.0, 0.05, 0.25, 0.3333, 0.5, 1.0, 0.9, 0.99]  # any order
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    for key, data in (("x", x), ("y", y)):
        assert got[key]["n"] == len(data)
        np.testing.assert_allclose(got[key]["quantiles"], np.quantile(data, probs), rtol=0, atol=1e-12)


def test_running_totals_and_ranks(skewed):
    df, x, y = skewed
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    for descending in (False, True):
        out = running_totals(counts, ["k"], "v", ["c"], descending=descending).toPandas()
        for key, data in (("x", x), ("y", y)):
            part = out[out.k == key].sort_values("v", ascending=not descending)
            assert (part.c.cumsum() == part.cum_c).all() and part.cum_c.iloc[-1] == len(data)
    ranks = average_ranks(df, ["k"], "v").toPandas()
    want = pd.Series(x).rank()
    merged = pd.DataFrame({"v": x, "want": want}).merge(ranks[ranks.k == "x"], on="v")
    assert np.allclose(merged.want, merged.avg_rank)


def test_hash_sample(spark):
    df = spark.range(30_000).withColumn("s", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    take = lambda: hash_sample(df, "id", lambda n: F.ceil(n * 0.1), 0.1, 7, ["s"])
    first, second = take().collect(), take().collect()
    assert sorted(first) == sorted(second)
    assert {s: sum(r["s"] == s for r in first) for s in "ab"} == {"a": 1000, "b": 2000}
    assert len({r["id"] for r in first}) == 3000
    other = hash_sample(df, "id", lambda n: F.ceil(n * 0.1), 0.1, 8, ["s"]).collect()
    assert sorted(first) != sorted(other)


def test_buckets_are_bounded_whatever_the_values(spark):
    """Skewed and many distinct values, in several rounds of refinement."""
    rng = np.random.default_rng(3)
    x = np.unique(np.concatenate([rng.exponential(1e-6, 40_000), rng.normal(1e6, 1e-3, 30_000), -(10.0 ** rng.uniform(-300, 300, 20_000)), [np.inf, -np.inf]]))
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "v": x, "n": rng.integers(1, 9, len(x))})).repartition(5)
    sizes = bucketed(df, ["k"], "v", 100, steps=4).groupBy("_bucket").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
    out = running_totals(df, ["k"], "v", ["n"], rows=500).toPandas().sort_values("v")
    assert len(out) == len(x) and (out.n.cumsum() == out.cum_n).all()


def test_one_value_that_fills_a_bucket_ends_the_refinement(spark):
    df = spark.range(5000).select(F.lit("a").alias("k"), F.when(F.col("id") < 4900, 1.0).otherwise(F.col("id").cast("double")).alias("v"))
    for sign in (1, -1):
        got = bucketed(df.withColumn("v", F.col("v") * sign), ["k"], "v", 10, steps=2).groupBy("_bucket").agg(F.count("v").alias("n"), F.countDistinct("v").alias("d")).collect()
        assert sum(r["n"] for r in got) == 5000 and all(r["n"] <= 10 or r["d"] == 1 for r in got)


def test_positions(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).cast("string").alias("s")).unionByName(spark.createDataFrame([(None,)], "s string"))
    got = {r["s"]: r["p"] for r in positions(df.repartition(6), [F.col("s").asc_nulls_last()], "p").collect()}
    want = sorted(got, key=lambda s: (s is None, s or ""))
    assert [got[s] for s in want] == list(range(1, 2002))
    assert prefix.BUCKET_ROWS >= 1 << 16


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 900])
def test_quantiles_of_few_values(spark, n):
    x = np.round(np.random.default_rng(n).normal(size=n), 1)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(spark.createDataFrame(pd.DataFrame({"k": "a", "v": x})), ["k"], "v", probs).first()
    np.testing.assert_allclose(got["quantiles"], np.quantile(x, probs), rtol=0, atol=1e-12)


@pytest.mark.parametrize("cells", [None, 300])
def test_column_quantiles(spark, cells, monkeypatch):
    """Ties, negative numbers, one value, gaps, no value at all, and keys; also where tasks hold a few rows only."""
    if cells:
        monkeypatch.setattr(quantiles, "CHUNK_ROWS", cells)
    rng, n = np.random.default_rng(3), 4000
    x = pd.DataFrame({"m": rng.choice(["a", "b", "c"], n), "v": rng.normal(size=n) * 10.0 ** rng.integers(-9, 9, n), "t": rng.integers(-3, 4, n).astype(float), "one": 7.0})
    x["gap"] = np.where(rng.random(n) < 0.7, np.nan, rng.exponential(size=n))
    x["none"] = np.nan
    names, probs = ["v", "t", "one", "gap", "none"], [0.5, 0.0, 0.05, 0.25, 0.5, 0.99, 1.0]
    df = spark.createDataFrame(x).withColumn("v", F.when(F.rand(1) > 2, 0.0).otherwise(F.col("v"))).repartition(4)
    got = {r["feature"]: r for r in column_quantiles(df, names, probs).collect()}
    assert set(got) == {"v", "t", "one", "gap"}
    for f, r in got.items():
        known = x[f].dropna()
        assert r["n"] == len(known)
        np.testing.assert_allclose(r["quantiles"], np.quantile(known, probs), rtol=1e-12, atol=1e-300)
    by = column_quantiles(df.unionByName(df.limit(3).withColumn("m", F.lit(None).cast("string"))), names, [0.5, 0.9], ["m"]).collect()
    assert len(by) == 12
    for r in by:
        known = x[r["feature"]][x["m"] == r["m"]].dropna()
        assert r["n"] == len(known)
        np.testing.assert_allclose(r["quantiles"], np.quantile(known, [0.5, 0.9]), rtol=1e-12)
    plan = column_quantiles(df, names, probs)._jdf.queryExecution().analyzed().toString()
    assert "Expand" not in plan and "Unpivot" not in plan
