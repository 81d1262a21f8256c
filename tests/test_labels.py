import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import labels as L
from parcelwise.operators import prototype as PR
from parcelwise.schemas import MODEL_FEATURES

ID = "cms_code_enc"


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], f"{ID} string")


@pytest.fixture(scope="module")
def active(spark):
    rows = [(f"c{i}", -1.0 if i % 2 else 1.0, i, 10.0, 5.0 if i % 3 else 10.0, 0.9 if i < 25 else 0.1, float(i), float(i * i)) for i in range(50)]
    return spark.createDataFrame(rows, f"{ID} string, delta_ewma double, recency_days int, item_avg double, item_last double, sim_score double, feat_0 double, feat_1 double")


def test_pseudo_labels(spark, active):
    out = L.pseudo_labels(active, ids(spark, ["c1", "c2"]), ids(spark, ["c2", "c3"])).toPandas().set_index(ID)
    assert len(out) == 50
    assert out.label_source["c1"] == "confirmed" and out.label_source["c2"] == out.label_source["c3"] == "confirmed_eval"
    assert out.label_source["c4"] == "reliable_neg"  # recent and rising
    assert out.label_source["c5"] == "pseudo_churn"  # similar, falling, below the mean
    assert out.label_source["c9"] == "pu_unlabeled"  # falling, but the last month is at the mean
    assert out.label_source["c49"] == "pu_unlabeled"


def test_weights_and_smoothing(spark):
    df = spark.createDataFrame([(s,) for s in ("confirmed", "pseudo_churn", "reliable_neg", "pu_unlabeled", "confirmed_eval")], "label_source string")
    rows = {r["label_source"]: r for r in L.weights_and_smoothing(df, 0.07, 0.0, 0.1).collect()}
    assert [rows[s]["sample_weight"] for s in ("confirmed", "pseudo_churn", "reliable_neg", "pu_unlabeled", "confirmed_eval")] == [1.0, 0.5, 0.8, 0.07, 0.0]
    assert rows["pseudo_churn"]["y_smooth"] == pytest.approx(0.95) and rows["reliable_neg"]["y_smooth"] == pytest.approx(0.05)
    assert rows["confirmed"]["y_smooth"] == 1.0


def test_split_confirmed(spark):
    ten = ids(spark, [f"x{i}" for i in range(10)])
    a, b = (L.split_confirmed(ten, 0.2, 42).orderBy(ID).collect() for _ in range(2))
    assert a == b and sum(r["is_holdout"] for r in a) == 2
    assert sum(r["is_holdout"] for r in L.split_confirmed(ids(spark, ["x"]), 0.5, 1).collect()) == 0
    assert sum(r["is_holdout"] for r in L.split_confirmed(ids(spark, ["x", "y"]), 0.9, 1).collect()) == 1
    assert sum(r["is_holdout"] for r in L.split_confirmed(ten, 0.0, 1).collect()) == 0


def test_leaky_names():
    assert len(MODEL_FEATURES) == len(set(MODEL_FEATURES)) == 66
    L.reject_leaky_features(MODEL_FEATURES)
    with pytest.raises(ValueError, match="leak the label"):
        L.reject_leaky_features(["item_sum", "y_raw"])


def test_final_dataset(spark, active):
    labelled = L.weights_and_smoothing(L.pseudo_labels(active, ids(spark, ["c1"]), ids(spark, ["c3"])), 0.05)
    history = spark.createDataFrame([("c1", 100.0, 1), ("c1", 50.0, 0)], f"{ID} string, feat_0 double, y_raw int")
    holdout = ids(spark, ["c3"])
    ds = L.final_dataset(labelled, history, holdout, ["feat_0", "feat_1"])
    split = ds.active.toPandas()
    assert split[split[ID] == "c3"]._dataset_split.item() == "eval"
    assert (split._dataset_split == "eval").sum() > 1
    train = ds.train.toPandas()
    assert len(train) == (split._dataset_split == "train").sum() + 2
    assert train.feat_0.mean() == pytest.approx(0, abs=1e-9) and train.feat_0.std(ddof=0) == pytest.approx(1)
    hist = train[(train[ID] == "c1")].y.tolist()
    assert 0.0 in hist  # history keeps its own label although c1 is confirmed
    report = L.sanity_report(ds, holdout).toPandas().set_index("check_no")
    assert report[report.critical].passed.all()
    L.raise_on_failure(L.sanity_report(ds, holdout))
    with pytest.raises(ValueError, match="null_weights"):
        ds.train = ds.train.withColumn("w", F.when(F.col(ID) != "c5", F.col("w")))
        L.raise_on_failure(L.sanity_report(ds, holdout))


def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    s = L.fit_scaler(df, ["a", "b"])
    assert s.values == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert [tuple(r) for r in L.apply_scaler(df, s).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_eval_sample_without_strata(spark):
    df = spark.createDataFrame([(f"c{i}", 1.0 if i == 0 else 0.0) for i in range(11)], f"{ID} string, y_label double")
    assert L.sample_eval(df, 0.2).count() == 3  # one lonely class: no strata
    assert L.sample_eval(df.limit(1), 0.2).count() == 0


def test_prototype(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 2)) @ np.array([[2.0, 0.3], [0.0, 1.0]]) + [10, -5]
    pdf = pd.DataFrame(x, columns=["item_sum", "item_avg"]).assign(**{ID: [f"c{i}" for i in range(40)]})
    df = spark.createDataFrame(pdf)
    proto = PR.fit_prototype(df, ids(spark, [f"c{i}" for i in range(30)]), 0.01)
    member = x[:30]
    inv = np.linalg.inv(np.cov(member.T) + 0.01 * np.eye(2))
    np.testing.assert_allclose(proto.mu, member.mean(0))
    np.testing.assert_allclose(proto.sigma_inv, inv, rtol=1e-8)
    d2 = np.einsum("ij,jk,ik->i", member - member.mean(0), inv, member - member.mean(0))
    assert proto.sigma2 == pytest.approx(np.median(d2))
    got = PR.similarity_scores(df, proto).orderBy(ID).toPandas()
    all_d2 = np.einsum("ij,jk,ik->i", x - proto.mu, inv, x - proto.mu)
    want = pd.Series(np.exp(-all_d2 / (2 * proto.sigma2)), index=pdf[ID]).sort_index()
    np.testing.assert_allclose(got.sim_score, want, rtol=1e-9)
    assert not PR.fit_prototype(df, ids(spark, ["c1"]), 0.01)
    assert PR.similarity_scores(df, PR.EMPTY).agg(F.max("sim_score")).first()[0] == 0.0
    cache = PR.save_prototype(spark, None, proto, 2501, 2)
    cache = PR.save_prototype(spark, cache, proto, 2503, 2)
    assert PR.load_latest_prototype(cache, 2, 2505).n_confirmed == 30
    assert not PR.load_latest_prototype(cache, 2, 2507) and not PR.load_latest_prototype(cache, 1)
