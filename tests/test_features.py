"""Window features against a plain per-window computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import features as X
from parcelwise.operators import rollup as R
from parcelwise.plans import windows as P

START, END = "2025-01-01", "2025-06-30"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 900
    # One customer has a third of all rows.
    who = np.where(rng.random(n) < 0.34, "T0", [f"C{i}" for i in rng.integers(1, 12, n)])
    days = rng.integers(0, 181, n)
    hours = rng.choice([0, 0, 13], n)
    sent = pd.Timestamp(START) + pd.to_timedelta(days, "D") + pd.to_timedelta(hours, "h")
    flag = lambda p: (rng.random(n) < p).astype(int)
    pdf = pd.DataFrame(
        {
            "cms_code_enc": who, "item_code": [f"i{k}" for k in range(n)], "service_code": rng.choice(list("CEMPRULQ"), n),
            "weight_kg": rng.integers(1, 40, n) / 4, "total_fee": rng.integers(1, 900, n), "is_domestic": flag(0.7),
            "rec_province_code": rng.integers(0, 4, n), "rec_district_code": rng.integers(0, 4, n), "rec_commune_code": rng.integers(0, 4, n),
            "region": rng.choice(["a", "b"], n), "sending_time": sent, "delay_day": rng.integers(0, 2, n) * rng.integers(0, 5, n),
            "done": flag(0.8), "rec_success": flag(0.8), "refunded": flag(0.1), "no_accepted": flag(0.1), "lost_order": flag(0.05),
            "total_complaint": flag(0.1), "order_score": np.where(rng.random(n) < 0.2, np.nan, rng.integers(1, 6, n)),
        }
    )
    df = spark.createDataFrame(pdf)
    df = df.withColumn("sending_time", F.col("sending_time").cast("timestamp_ntz")).withColumn("order_score", F.nanvl("order_score", F.lit(None)))
    cpl = pd.DataFrame({"cms_code_enc": rng.choice([f"C{i}" for i in range(1, 8)], 200), "complaint_code": rng.choice([114, 115, 116], 200),
                        "create_complaint_date": pd.Timestamp(START) + pd.to_timedelta(rng.integers(0, 181, 200), "D") + pd.to_timedelta(rng.choice([0, 9], 200), "h")})
    complaints = spark.createDataFrame(cpl).withColumn("create_complaint_date", F.col("create_complaint_date").cast("timestamp_ntz"))
    return pdf, df, cpl, complaints


@pytest.fixture(scope="module")
def built(spark, data):
    _, df, _, complaints = data
    specs = P.specs_between(spark, START, END, [2, 3])
    monthly = R.monthly_rollup(df, START, END, with_days=True)
    return X.window_features(monthly, complaints, specs, 3).toPandas()


def test_window_features_brute_force(data, built):
    pdf, _, cpl, _ = data
    stage = pdf[pdf.sending_time <= pd.Timestamp(END)]
    seen = 0
    for size in (2, 3):
        for end in range(size, 7):
            lo, hi = pd.Timestamp(2025, end - size + 1, 1), pd.Timestamp(2025, end, 1) + pd.offsets.MonthEnd(0)
            part = built[(built.window_size == size) & (built.window_end == f"25{end:02d}")].set_index("cms_code_enc")
            month = stage.sending_time.dt.month
            rows = stage[(month >= end - size + 1) & (month <= end)]
            assert set(part.index) == set(rows.cms_code_enc)
            for who, g in rows.groupby("cms_code_enc"):
                got = part.loc[who]
                per = g.groupby(g.sending_time.dt.month).agg(n=("item_code", "count"), fee=("total_fee", "sum"), w=("weight_kg", "mean"), sc=("order_score", "mean"))
                per["sc"] = per.sc.fillna(0)
                assert got.item_sum == len(g) and got.revenue_sum == g.total_fee.sum()
                assert got.item_median == per.n.median() and got.item_std == pytest.approx(per.n.std(ddof=0))
                assert got.weight_sum == pytest.approx(per.w.sum())
                assert got.item_max_month == 2500 + per.n.idxmax() and got.revenue_min_month == 2500 + per.fee.idxmin()
                assert got.order_max_month == 2500 + per.sc.idxmax()
                for k in range(size):
                    suffix = "last" if k == 0 else f"{k}m_ago"
                    assert got[f"item_{suffix}"] == per.n.get(end - k, 0)
                exact = pdf[(pdf.cms_code_enc == who) & (pdf.sending_time >= lo) & (pdf.sending_time <= hi)]
                assert got.active_days == exact.sending_time.dt.date.nunique()
                if len(exact):
                    assert got.recency == (hi.date() - exact.sending_time.max().date()).days
                x = 2500 + per.index.to_numpy()
                slope = np.polyfit(x, per.n, 1)[0] if len(per) > 1 else 0.0
                assert got.item_slope == pytest.approx(slope, abs=1e-6)
                c = cpl[(cpl.cms_code_enc == who) & (cpl.create_complaint_date >= lo) & (cpl.create_complaint_date <= hi)].complaint_code.value_counts()
                assert got.complaint_diversity == len(c)
                if len(c):
                    assert got.most_common_complaint == min(c[c == c.max()].index)
                seen += 1
    assert seen > 80


def test_windows_alone_equal_windows_together(spark, data, built):
    _, df, _, complaints = data
    alone = P.specs_between(spark, START, END, [3]).filter("window_end = '2504'")
    monthly = R.monthly_rollup(df, START, END, with_days=True)
    one = X.window_features(monthly, complaints, alone, 3).toPandas().sort_values("cms_code_enc").reset_index(drop=True)
    many = built[(built.window_size == 3) & (built.window_end == "2504")].sort_values("cms_code_enc").reset_index(drop=True)
    pd.testing.assert_frame_equal(one, many[one.columns], check_exact=False, check_dtype=False)


def test_asof_all_equals_single(spark, data):
    _, df, _, _ = data
    cm = R.monthly_rollup(df, START, END)
    specs = P.specs_between(spark, START, END, [2])
    every = X.lifetime_asof_all(cm, specs, START).filter("lifetime_asof_date = date'2025-04-30'")
    one = X.lifetime_asof(cm, START, "2025-04-30")
    a, b = (d.toPandas().sort_values("cms_code_enc").reset_index(drop=True) for d in (every, one))
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=False, check_dtype=False)


def test_flagship_plan(spark, data):
    """Two shuffles for the shipments: customer-month, then customer."""
    _, df, _, complaints = data
    specs = P.specs_between(spark, START, END, [2, 3])
    base = X.window_base(R.monthly_rollup(df, START, END, with_days=True), specs, 3)
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Cartesian" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_ewma_literals(spark):
    df = spark.createDataFrame([(20.0, 10.0)], "item_last double, item_1m_ago double")
    row = X.ewma(df, 2, 0.3, ["item"]).first()
    assert row["ewma_item"] == pytest.approx(13.0) and row["ewma"] == row["ewma_item"]
    df = spark.createDataFrame([(300.0, 200.0, 100.0)], "revenue_t double, revenue_1m_ago double, revenue_2m_ago double")
    row = X.ewma(df, 3, 0.5, ["revenue"]).first()
    assert row["ewma_revenue"] == pytest.approx(225.0) and row["delta_ewma_revenue"] == pytest.approx(75.0)
    row = X.ewma(spark.createDataFrame([(7.0,)], "item_last double"), 3, 0.5, ["item", "delay"]).first()
    assert (row["ewma_item"], row["delta_ewma_item"], row["ewma_delay"]) == (7.0, 0.0, 0.0)
    df = spark.createDataFrame([(4.0, 2.0)], "order_score_last double, order_score_1m_ago double")
    assert X.ewma(df, 2, 0.5, ["order"]).first()["ewma_order"] == 3.0
    assert X.ewma(df, 2, 0.5, ["order"], order_parity=True).first()["ewma_order"] == 0.0


def test_month_plan_sizes(spark):
    def sizes(end, low, high):
        bounds = spark.sql(f"select date'2025-01-15' start_date, date'{end}' end_date")
        plan = P.month_plan(bounds, low, high)
        return [r["window_size"] for r in plan.filter("kind = 'size'").orderBy("window_size").collect()]

    assert sizes("2025-08-20", 3, None) == [3, 4, 5, 6]
    assert sizes("2025-08-20", 3, 4) == [3, 4]
    assert sizes("2025-04-20", 3, None) == []
    assert sizes("2025-01-20", 3, None) == [1]


def test_windows_are_grouped_by_numbers(spark, data):
    """The window's texts and dates are no part of the grouping of many copied rows."""
    _, df, _, _ = data
    specs = P.specs_between(spark, START, END, [2, 3])
    base = X.window_base(R.monthly_rollup(df, START, END, with_days=True), specs, 3)
    plan = base._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate [" in line and "window_size" in line)
    keys = grouped.split("Aggregate [")[1].split("]")[0]
    assert "end_idx" in keys and not any(c in keys for c in ("window_start", "window_end", "start_date", "end_date"))
    assert set(specs.columns) <= set(base.columns) | {"start_idx"}
