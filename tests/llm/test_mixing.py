import random

import pytest
from pyspark.sql import functions as F

from parcelwise.llm import mixing as M

SCHEMA = "doc_id long, source string, text string, target double, size long, key string"


def level(sizes, weights=(5, 2, 1), share=1.5, ceiling=2.0):
    """Targets by handing out the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), dict.fromkeys(order, 0.0)
    while open_:
        total = sum(w[s] for s in open_)
        got = {s: left * w[s] / total for s in open_}
        full = {s for s in open_ if got[s] >= ceiling * sizes[s]}
        if not full:
            return target | got
        for s in full:
            target[s] = ceiling * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def documents(seed=1, n=900):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "b", "c", "d", None, "é", "z"] + ["hot"] * 6), " ".join(["w"] * min(int(rng.paretovariate(0.9) * 5), 3000))) for k in range(n)]
    return rows + [(None, "a", None), (7, "b", ""), (7, "b", ""), (8, "none", None)]


@pytest.mark.parametrize("block", [50_000, 40])
def test_mix_meets_targets_and_balances_documents(spark, block):
    rows = documents()
    docs = spark.createDataFrame([(*r, 1.0, 1, "clash") for r in rows], SCHEMA)
    got = M.mix_sources(docs, block=block).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["source"] or "", r["size"]) for r in got) == sorted((a is None, a, b or "", len((c or "").split())) for a, b, c in rows)
    sizes, taken, count, copies = {}, {}, {}, {}
    for r in got:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["copies"] * r["size"]
        copies[s] = copies.get(s, 0) + r["copies"]
        count[s] = count.get(s, 0) + 1
        assert 0 <= r["copies"] <= 2
    want = level(sizes)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.01 * t + 3, (s, taken[s], t)
        assert abs(copies[s] - count[s] * (t / sizes[s] if sizes[s] else 0)) <= 4


def test_reruns_and_other_layouts_agree(spark):
    docs = spark.createDataFrame([(*r, 1.0, 1, "clash") for r in documents(3)], SCHEMA)
    key = lambda df: sorted(map(str, df.collect()))
    first = key(M.mix_sources(docs, block=50))
    assert first == key(M.mix_sources(docs.repartition(7, "text").orderBy(F.desc("doc_id")), block=50))
    assert first != key(M.mix_sources(docs, block=50, seed=43))


def test_flight_keeps_both_sums_and_probabilities_are_expectations():
    rng = random.Random(5)
    sizes = [rng.randrange(1, 400) for _ in range(60)]
    probs = [rng.random() for _ in sizes]
    mean = [0.0] * 60
    for run in range(1500):
        keys = [rng.getrandbits(63) for _ in sizes]
        out = M.flight(sizes, probs, keys)
        assert sum(0 < p < 1 for p in out) <= 2
        assert sum(out) == pytest.approx(sum(probs), abs=1e-6)
        assert sum(z * p for z, p in zip(sizes, out)) == pytest.approx(sum(z * p for z, p in zip(sizes, probs)), abs=1e-3)
        assert set(M.landing(sizes, out)) <= {0.0, 1.0}
        mean = [m + p / 1500 for m, p in zip(mean, out)]
    assert max(abs(m - p) for m, p in zip(mean, probs)) < 0.06


def test_landing_takes_the_nearest_subset():
    rng = random.Random(8)
    sizes, probs = [rng.randrange(1, 500) for _ in range(9)], [rng.random() for _ in range(9)]
    out = M.landing(sizes, probs)
    want = sum(z * p for z, p in zip(sizes, probs))
    assert abs(sum(z * p for z, p in zip(sizes, out)) - want) < 20 and abs(sum(out) - sum(probs)) < 3
    few = M.settle_source([2000, 900, 500, 300, 200, 100], [0.5] * 6, [1, 2, 3, 4, 5, 6])
    assert sum(z * p for z, p in zip([2000, 900, 500, 300, 200, 100], few)) == 2000


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 3, "d": 5}, {"a": 0, None: 4}, {"x": 9}, {"a": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in M.source_targets(rows).collect()}
    assert got == pytest.approx(level(sizes))


def test_empty_table_and_given_lengths(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert M.mix_sources(docs).collect() == []
    docs = spark.createDataFrame([(k, "s", "x", 0.0, 10, "") for k in range(8)], SCHEMA)
    assert {r["size"] for r in M.mix_sources(docs, size=F.col("size")).collect()} == {10}
    with pytest.raises(ValueError):
        M.source_targets(docs, share=3.0)
