import numpy as np
import pytest

from parcelwise.operators import drift as D
from parcelwise.operators import evaluate as V
from parcelwise.sources.upsert import insert_if_absent, merge_by_key

DDL = "label int, churn_probability double"


def frame(spark, y, p):
    return spark.createDataFrame(list(zip(y, p)), DDL)


def test_threshold(spark):
    t = lambda y, p: V.best_threshold_fbeta(frame(spark, y, p)).first()[0]
    assert t([0, 0, 0, 1, 1, 1], [0.1, 0.2, 0.3, 0.7, 0.8, 0.9]) == 0.7
    assert t([1, 1], [0.4, 0.6]) == 0.4
    assert t([0, 1], [0.2, 0.8]) == 0.8
    assert t([], []) == 0.5


def test_evaluate(spark):
    rng = np.random.default_rng(2)
    y = (rng.random(3000) < 0.3).astype(int)
    p = np.clip(y * 0.2 + rng.random(3000), 0, 1).round(2)
    got = V.evaluate(frame(spark, y.tolist(), p.tolist())).first()
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(pos_ > neg).mean() + 0.5 * (pos_ == neg).mean() for pos_ in pos])
    assert got["roc_auc"] == pytest.approx(auc)
    ap, prev = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / y.sum()
        ap += (recall - prev) * y[hit].mean()
        prev = recall
    assert got["pr_auc"] == pytest.approx(ap)
    assert (got["n_eval"], got["n_pos"]) == (3000, y.sum())
    empty = V.evaluate(frame(spark, [], [])).first()
    assert empty["threshold"] == 1.0 and empty["n_eval"] == 0 and empty["f05"] == 0.0
    one = V.evaluate(frame(spark, [0, 0], [0.1, 0.2])).first()
    assert one["roc_auc"] == 0.0 and one["pr_auc"] == 0.0


def test_gates(spark):
    def gate(ddl, *row):
        return V.guardrail(spark.createDataFrame([row], ddl)).first()

    assert gate("f05 double, pr_auc double", 0.10, 0.05)["passed"]
    bad = gate("f05 double, pr_auc double", 0.05, 0.01)
    assert not bad["passed"] and "F0.5" in bad["reason"] and "PR-AUC" in bad["reason"]
    assert not gate("other int", 1)["passed"]
    assert gate("f2 double, roc_auc double", 0.2, 0.6)["passed"]
    rows = V.accept_reject(spark.createDataFrame([(0.5, None), (0.5, 0.4), (0.5, 0.5), (0.5 + 5e-7, 0.5)], "new_f05 double, prev_f05 double")).collect()
    assert [r["accepted"] for r in rows] == [True, True, False, False]
    assert rows[0]["accept_rule"] == "accepted_no_previous" and rows[2]["accept_rule"].startswith("rejected")


def test_score_stats_and_reasons(spark):
    df = spark.createDataFrame([(0.1, 0, 10.0), (0.3, 0, 20.0), (0.5, 0, 20.0), (0.7, 1, 30.0), (0.9, 1, 20.0)], "churn_probability double, churn_flag int, feat_a double")
    s = D.score_stats(df).first()
    assert s["mean"] == pytest.approx(0.5) and s["p50"] == 0.5 and s["p90"] == pytest.approx(0.82) and s["risk_ratio"] == 0.4
    r = V.reasons(df, ["feat_a", "nope"]).orderBy("feat_a").collect()
    assert r[0]["reason_1"] == "Low feat_a" and r[-1]["reason_1"] == "High feat_a" and r[0]["reason_2"] == "Feature: nope"
    assert V.reasons(df, []).columns == df.columns
    t = V.top_percent_threshold(df, 0.2, 20.0).first()["threshold_used"]
    assert t == pytest.approx(0.74)
    assert V.top_percent_threshold(df, 0.95, 20.0).first()["threshold_used"] == 0.95


def test_anomaly(spark):
    rows = [(1, m, v) for m, v in enumerate([0.1, 0.11, 0.1, 0.09, 0.1, 0.5, None, 0.1])]
    out = D.risk_ratio_anomaly(spark.createDataFrame(rows, "horizon int, window_end int, risk_ratio double")).orderBy("window_end").collect()
    assert [r["is_anomaly"] for r in out] == [False] * 5 + [True, False, False]
    assert "over last 5" in out[5]["anomaly_reason"]


def test_backtest(spark):
    pred = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "cms_code_enc string, churn_flag int")
    lab = spark.createDataFrame([("a", 1), ("c", 1)], "cms_code_enc string, churned int")
    m = D.precision_in_list(pred, lab).first()
    assert (m["active_cnt"], m["list_size"], m["churn_true_total"], m["churn_true_in_list"]) == (3, 2, 2, 1)
    assert m["precision_in_list"] == m["recall_in_list"] == m["f1_in_list"] == 0.5
    none = D.precision_in_list(pred.filter("churn_flag = 0"), lab).first()
    assert none["precision_in_list"] is None and none["f1_in_list"] is None
    assert D.precision_in_list(pred.limit(0), lab).first()["churn_true_total"] == 0


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(2, "x", None), (3, "y", 9)], "k int, s string, n int")
    assert sorted(map(tuple, merge_by_key(old, new, ["k"]).collect())) == [(1, "a", 1), (2, "x", None), (3, "y", 9)]
    assert sorted(map(tuple, merge_by_key(old, new, ["k"], ["s"]).collect())) == [(1, "a", 1), (2, "x", 2), (3, "y", 9)]
    assert sorted(map(tuple, insert_if_absent(old, new, ["k"]).collect())) == [(1, "a", 1), (2, "b", 2), (3, "y", 9)]


def test_config_history(spark):
    h = spark.createDataFrame([(2501, 2, True, 0.1), (2502, 2, False, 0.2), (2503, 1, True, 0.3), (2504, 2, True, 0.4)], "as_of_month int, horizon int, is_accepted boolean, metric_f05 double")
    assert V.latest_config(h, 2).first()[0] == 2504
    assert V.latest_config(h, 2, accepted=True, skip=1).first()[0] == 2501
    ok = spark.createDataFrame([(2502, 2, 0.9, None)], "as_of_month int, horizon int, metric_f05 double, guardrail_warning string")
    assert V.update_metrics(h, ok).filter("as_of_month = 2502").first()["metric_f05"] == 0.9
    with pytest.raises(Exception, match="Guardrail failed"):
        V.update_metrics(h, ok.fillna("low")).collect()
