"""A sample of the catalogue against DuckDB, and the modelling run, at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.inputs import HISTORY, T_OBS, inputs
from check import table
from parcelwise.operators import model as M
from parcelwise.plans import churn, dataset

SF = "/root/testdata/sf0.001"
SAMPLE = ["window_features", "customer_lifetime", "lifetime_asof_all", "training_windows", "split_confirmed", "all_iv", "psi", "evaluate", "typed_shipments", "risk_summary"]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_check_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in cur.description], cur.fetchall())


def test_entry_and_names(spark):
    assert entry.entry(spark).limit(5).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_churn_run(spark, tmp_path):
    i = inputs(spark, SF)
    run = {"t_obs": "2001-07-01", "data_start": HISTORY, "settings": {"prototype": {"min_samples": 2}}}
    ids = i.table("customer").selectExpr("concat(case when c_custkey % 5 = 0 then 'T' else 'C' end, lpad(cast(c_custkey as string), 8, '0')) as cms_code_enc").filter("substr(cms_code_enc, 9, 1) in ('1', '4')")
    ds = dataset.prepare_dataset(i.customer_month, i.info, i.features, ids, i.months, window_size=3, **run)
    assert ds.metadata["w_star"] == 3 and T_OBS > run["t_obs"]
    assert ds.metadata["prototype_cache"].filter("run_month = 107 and horizon = 2").count() == 1
    quick = {"booster": {"maxIter": 2, "maxDepth": 2}, "limits": {"min_f05": 0.0, "min_pr_auc": 0.0}}
    out = churn.run_churn(ds, **quick, bundle_path=str(tmp_path / "b"))
    assert out["status"] == "SUCCESS" and out["accept_rule"] == "accepted_no_previous"
    p = out["scored"].selectExpr("min(churn_probability) a", "max(churn_probability) b").first()
    assert 0 <= p["a"] <= p["b"] <= 1 and out["risk"].count() >= 1
    assert out["drift"].count() == len(ds.features)
    _, meta = M.load_bundle(str(tmp_path / "b"), spark)
    assert meta["threshold"] == out["metrics"]["threshold"]
    again = churn.run_churn(ds, **quick, prev_f05=1.0, previous_bundle=str(tmp_path / "b"))
    assert again["status"] == "REJECTED"
    strict = churn.run_churn(ds, booster=quick["booster"], limits={"min_f05": 1.1})
    assert strict["status"] == "GUARDRAIL_FAILED" and "scored" not in strict
    assert churn.config_row(out, ds).first()["best_k"] == 3
    with pytest.raises(Exception, match="maxDepth"):
        M.train_churn_model(ds, maxDepth=-1)
    with pytest.raises(ValueError, match="alpha_ewma"):
        dataset.merged_settings({"history": {"alpha_ewma": 1.5}})
    assert dataset.candidate_sizes(i.features, i.months, 4) == [4, 5, 6]
