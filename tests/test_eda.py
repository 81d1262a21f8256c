import numpy as np
import pandas as pd
import pytest

from parcelwise.functions.quantiles import average_ranks
from parcelwise.operators import drift as D
from parcelwise.operators import eda as E
from parcelwise.plans import report as RP


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"feat_a": np.arange(1, 201.0), "feat_b": rng.normal(50, 10, 200), "feat_c": rng.normal(30, 5, 200)})
    pdf.loc[:19, "feat_c"] = np.nan
    pdf.loc[20, "feat_c"], pdf.loc[21, "feat_c"] = 999, -999
    pdf["flat"] = 7.0
    pdf["y"] = (rng.random(200) < 0.2).astype(int)
    # NaN stands for a missing value here; Spark tables hold NULL.
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).to_dict("records"), "feat_a double, feat_b double, feat_c double, flat double, y int")
    return pdf, df.persist()


FEATS = ["feat_a", "feat_b", "feat_c", "flat", "unknown"]


def test_descriptive(sample):
    pdf, df = sample
    got = E.descriptive_stats(df, FEATS).toPandas().set_index("feature_name")
    assert set(got.index) == {"feat_a", "feat_b", "feat_c", "flat"}
    assert got["mean"]["feat_a"] == 100.5 and abs(got["skew"]["feat_a"]) < 1e-9
    for f in ("feat_a", "feat_b", "feat_c"):
        s = pdf[f].dropna()
        want = [len(s), s.mean(), s.median(), s.std(), s.skew(), s.kurtosis(), s.min(), s.max(), *s.quantile([0.05, 0.25, 0.5, 0.75, 0.95])]
        np.testing.assert_allclose(got.loc[f].astype(float).to_numpy(), want, rtol=1e-9, atol=1e-9)


def test_empty_feature(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "e double, x double")
    row = E.descriptive_stats(df, ["e", "x"]).filter("feature_name = 'e'").first()
    assert row["count"] == 0 and row["mean"] is None and row["p50"] is None
    assert E.outlier_stats(df, ["e"]).first()["iqr_outlier_count"] == 0


def test_missing(spark, sample):
    _, df = sample
    got = {r["feature_name"]: r for r in E.missing_stats(df, FEATS).collect()}
    assert got["feat_c"]["missing_count"] == 20 and got["feat_c"]["missing_pct"] == 0.1 and not got["feat_a"]["has_inf"]
    inf = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "x double")
    row = E.missing_stats(inf, ["x"]).first()
    assert row["has_inf"] and row["missing_count"] == 1
    co = spark.createDataFrame([(None, None, 1.0), (None, None, 2.0), (None, None, None), (1.0, 1.0, 1.0)], "a double, b double, c double")
    pats = E.missing_patterns(co, ["a", "b", "c"]).collect()
    assert [(p["affected_columns"], p["row_count"], p["pct_of_total"]) for p in pats] == [("a,b", 2, 0.5), ("a,b,c", 1, 0.25)]


def test_outliers(sample):
    _, df = sample
    got = {r["feature_name"]: r for r in E.outlier_stats(df, FEATS).collect()}
    assert got["flat"]["iqr_lower"] is None and got["flat"]["iqr_outlier_count"] == 0
    assert got["feat_c"]["iqr_outlier_count"] >= 2 and got["feat_c"]["zscore_outlier_count"] == 2


def test_correlation(sample):
    pdf, df = sample
    names = ["feat_a", "feat_b", "feat_c", "flat"]
    for method in ("pearson", "spearman"):
        got = E.correlation_matrix(df, names, method).toPandas().pivot(index="feature_a", columns="feature_b", values="correlation")
        want = pdf[names].corr(method=method)
        np.testing.assert_allclose(got.loc[names, names].astype(float), want, atol=1e-9)


def test_high_correlations(spark):
    m = spark.createDataFrame([("a", "b", 0.85), ("c", "a", -0.95), ("a", "c", -0.95), ("b", "c", 0.8), ("b", "a", 0.85), ("a", "a", 1.0)], "feature_a string, feature_b string, correlation double")
    assert [tuple(r) for r in E.high_correlations(m, 0.8).collect()] == [("a", "c", -0.95), ("a", "b", 0.85), ("b", "c", 0.8)]


def test_target(sample):
    pdf, df = sample
    dist = E.class_distribution(df, "y").first()
    assert dist["positive_count"] == pdf.y.sum() and dist["churn_rate"] == round(pdf.y.mean(), 6)
    p = {r["feature_name"]: r for r in E.point_biserial_p(df, FEATS, "y").collect()}
    assert p["feat_b"]["correlation"] == pytest.approx(pdf.feat_b.corr(pdf.y), abs=1e-6) and 0 <= p["feat_b"]["p_value"] <= 1
    iv = {r["feature_name"]: r["iv"] for r in E.all_iv(df, FEATS, "y").collect()}
    assert iv["flat"] == 0.0
    for f in ("feat_a", "feat_c"):
        ok = pdf[f].notna()
        g = pdf.y[ok].groupby(pd.qcut(pdf[f][ok], 10, duplicates="drop"), observed=True).agg(["sum", "count"])
        e, n = g["sum"], g["count"] - g["sum"]
        de, dn = (e + 0.5) / (e.sum() + 0.5 * len(g)), (n + 0.5) / (n.sum() + 0.5 * len(g))
        assert iv[f] == pytest.approx(((dn - de) * np.log(dn / de)).sum(), abs=1e-6)


def psi_of(train, cur):
    edges = np.unique(np.quantile(train, np.linspace(0, 1, 11)))
    t, c = np.histogram(train, edges)[0], np.histogram(cur, edges)[0]
    pt, pc = (np.clip(v / v.sum(), 1e-8, 1) for v in (t, c))
    return np.sum((pc - pt) * np.log(pc / pt)), np.max(np.abs(np.cumsum(pt) - np.cumsum(pc)))


def test_drift(spark):
    rng = np.random.default_rng(5)
    train, cur = rng.normal(0, 1, 3000).round(2), rng.normal(0.5, 1, 2000).round(2)
    a = spark.createDataFrame(pd.DataFrame({"x": train, "flat": 1.0, "gone": train}))
    b = spark.createDataFrame(pd.DataFrame({"x": cur, "flat": 1.0}))
    got = {r["feature_name"]: r for r in D.feature_drift(b, D.numeric_profile(a, ["x", "flat", "gone"])).collect()}
    psi, ks = psi_of(train, cur)
    assert got["x"]["psi"] == pytest.approx(psi) and got["x"]["ks_stat"] == pytest.approx(ks) and got["x"]["psi"] >= 0
    assert got["flat"]["psi"] == 0.0 and got["flat"]["severity"] == "OK"
    assert got["gone"]["severity"] == "ALERT" and got["gone"]["psi"] is None and "missing_in_current" in got["gone"]["details_json"]
    far = spark.createDataFrame(pd.DataFrame({"x": [1e6, 2e6]}))
    out = D.stability(D.counts_on_profile(far, D.numeric_profile(a, ["x"]))).first()
    assert out["psi"] == float("inf")
    clamped = D.counts_on_profile(far, D.numeric_profile(a, ["x"]), clamp=True).agg({"cur_count": "sum"}).first()[0]
    assert clamped == 2


def test_monthly_and_trends(spark):
    rng = np.random.default_rng(9)
    frames = [pd.DataFrame({"m": str(2501 + k), "feat_a": rng.normal(100 + 5 * k, 10, 150), "still": 1.0}) for k in range(4)]
    df = spark.createDataFrame(pd.concat(frames)).persist()
    drift = D.monthly_drift(df, ["feat_a"], "m").toPandas()
    assert drift.comparison_month.tolist() and len(drift) == 3
    psi, _ = psi_of(frames[0].feat_a, frames[3].feat_a)
    assert drift.set_index("comparison_month").psi["2504"] == pytest.approx(psi, abs=1e-6)
    trend = {r["feature_name"]: r for r in E.feature_trends_p(df, ["feat_a", "still"], "m").collect()}
    med = [f.feat_a.median() for f in frames]
    assert trend["feat_a"]["slope"] == pytest.approx(np.polyfit(range(4), med, 1)[0], abs=1e-7) and trend["feat_a"]["is_trending"]
    assert trend["still"]["p_value"] == 1.0 and not trend["still"]["is_trending"]
    few = E.feature_trends_p(df.filter("m < '2503'"), ["feat_a"], "m").first()
    assert few["slope"] is None and few["n_months"] == 2


def test_report(spark, sample, tmp_path):
    _, df = sample
    rep = RP.eda_report(df, FEATS, target="y")
    summary = {r["metric"]: r["value"] for r in RP.report_summary(rep).collect()}
    assert summary["n_features_analysed"] == 4 and "strong_iv_features" in summary
    for _ in range(2):
        RP.persist_report(rep, "r1", str(tmp_path))
    RP.persist_report(rep, "r2", str(tmp_path))
    stored = RP.read_report(spark, str(tmp_path), "feature_stats")
    assert stored.count() == 8 and RP.read_report(spark, str(tmp_path), "temporal_drift") is None


def test_baseline(spark, sample):
    _, df = sample
    stats = E.descriptive_stats(df, ["feat_a"])
    diff = E.compare_to_baseline(stats, E.load_baseline(E.baseline_rows(stats, "r"))).toPandas()
    assert len(diff) == 12 and (diff.delta == 0).all()


def test_spearman_of_columns_with_their_own_nulls(spark):
    rng = np.random.default_rng(11)
    n = 400
    pdf = pd.DataFrame({c: np.round(rng.normal(size=n), 1) for c in "abcdef"})
    pdf["b"] = np.round(pdf.a + rng.normal(size=n), 1)
    pdf.loc[rng.random(n) < 0.3, "c"] = np.nan
    pdf.loc[pdf.c.isna(), "d"] = np.nan
    pdf.loc[rng.random(n) < 0.6, "e"] = np.nan
    pdf["zero"], pdf["none"] = np.where(rng.random(n) < 0.95, 0.0, 1.0), np.nan
    pdf["flat"] = 3.0
    names = list(pdf.columns)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in names)).repartition(5)
    assert E.null_classes(df, names) == [[0, 1, 5, 6, 8], [2, 3], [4], [7]]
    want = pdf.corr("spearman")
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in E.correlation_matrix(df, names, "spearman").collect()}
    assert len(got) == len(names) ** 2
    for a in names:
        for b in names:
            w = want.loc[a, b]
            assert (got[a, b] is None) if np.isnan(w) else abs(got[a, b] - w) < 1e-9, (a, b)


def test_spearman_shuffles_do_not_grow_with_the_columns(spark):
    rng = np.random.default_rng(2)

    def exchanges(k):
        x = rng.normal(size=(50, k))
        rows = [[None if (i + j) % 7 == 0 else float(v) for j, v in enumerate(r)] for i, r in enumerate(x)]
        df = spark.createDataFrame(rows, ", ".join(f"f{i} double" for i in range(k)))
        plan = E.correlation_matrix(df, [f"f{i}" for i in range(k)], "spearman")._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange ")

    assert exchanges(9) <= exchanges(3) + 2


def test_spearman_ranks_each_known_cell_once(spark, monkeypatch):
    rows = [[None if (i + j) % 3 == 0 else float(i * (j + 1) % 11) for j in range(3)] + [float(i % 5)] for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    seen = []

    def spy(long, *rest):
        seen.append(long.count())
        return average_ranks(long, *rest)

    monkeypatch.setattr(E, "average_ranks", spy)
    E.correlation_matrix(df, list("abcd"), "spearman").collect()
    assert seen == [sum(v is not None for r in rows for v in r)]


def test_bins_of_wide_rows(spark):
    inf, nan = float("inf"), float("nan")
    cells = [(1, 0.0), (1, -0.0), (1, 0.5), (1, 1.0), (1, 2.0), (2, 2.5), (2, -1.0), (2, None), (2, nan), (2, inf), (2, 1.5)]
    df = spark.createDataFrame([(m, x, "7" if m == 1 else "no number") for m, x in cells], "m int, x double, t string").repartition(3)
    edges = spark.createDataFrame([("x", [0.0, 1.0, 2.0]), ("t", [6.0, 8.0]), ("gone", [0.0, 1.0])], "feature string, edges array<double>")

    def counts(**how):
        return {tuple(r[:-1]): r[-1] for r in D.bin_counts(df, edges, **how).collect()}

    assert counts() == {("x", 0): 3, ("x", 1): 3, ("t", 0): 5}
    assert counts(clamp=True) == {("x", 0): 4, ("x", 1): 4, ("t", 0): 5}
    assert counts(keys=["m"]) == {(1, "x", 0): 3, (1, "x", 1): 2, (1, "t", 0): 5, (2, "x", 1): 1}
    assert D.bin_counts(df.limit(0), edges, ["m"]).count() == 0


def test_monthly_drift_stores_no_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(pd.DataFrame({"m": np.repeat(["2501", "2502", "2503"], 400), "x": rng.normal(size=1200).round(2), "y": rng.normal(size=1200).round(2)}))
    stored, cut = [], D.cut
    monkeypatch.setattr(D, "cut", lambda frame: stored.append(cut(frame)) or stored[-1])
    got = D.monthly_drift(df, ["x", "y"], "m").collect()
    assert len(got) == 4 and all(r["psi"] is not None for r in got)
    assert stored and max(f.count() for f in stored) <= 20  # bins of the profile
