"""The sizes that the catalogue's window search covers, on tables of its own."""

import datetime as dt

from catalog import q_models
from catalog.inputs import Inputs
from parcelwise.operators import features as X
from parcelwise.operators import walkforward as WF
from parcelwise.schemas import MODEL_FEATURES


def tables(spark, folder, months):
    """Fifteen customers; a third of them ships each month, the others every second or third one."""
    orders, lines = [], []
    for m in range(months):
        for c in range(1, 16):
            if m % (c % 3 + 1) == 0:
                key, day = len(orders) + 1, dt.datetime(1995 + m // 12, m % 12 + 1, 1 + c)
                orders.append((key, c, "O", "1-URGENT" if c % 2 else "5-LOW", day))
                lines.append((key, 10 + c, 1, c % 6 + 1, float(c), 10.5 * c + m, 0.01 * (c % 3), "R" if c == 4 else "N", "F", day))
    frames = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "supplier": ([(1, 1)], "s_suppkey long, s_nationkey long"),
        "nation": ([(1, 1)], "n_nationkey long, n_regionkey long"),
        "region": ([(1, "ASIA")], "r_regionkey long, r_name string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_search_covers_every_size_the_months_allow(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path, 14)
    i, given = Inputs(spark, str(tmp_path), keep=False), []

    def folds(rows):
        given.append(rows)
        return spark.createDataFrame([(w, 0.5 + w / 100) for w in (3, 4, 7)], "window_size int, auc double")

    monkeypatch.setattr(WF, "walk_forward_auc", folds)
    got = {r["window_size"]: r["n_folds"] for r in q_models.QUERIES["search_window"](i).collect()}
    assert got == {3: 1, 4: 1, 5: 0, 6: 0, 7: 1, 8: 0}  # 14 months - horizon 2 - 5 windows + 1
    assert q_models.QUERIES["best_window"](i).first()["w_star"] == 7
    assert len(given) == 1
    # Ends: a full window before, the horizon and the newest month after.
    months = {r["_W"]: r["n"] for r in given[0].select("_W", "_end_month").distinct().groupBy("_W").count().withColumnRenamed("count", "n").collect()}
    assert months == {w: 12 - w for w in range(3, 9)}
    # The sizes of the feature table are the same rows either way.
    same = q_models.search_rows(i).filter("_W = 5")
    assert same.count() > 0 and same.exceptAll(given[0].filter("_W = 5")).count() == 0 == given[0].filter("_W = 5").exceptAll(same).count()


def test_partitions_of_customers_grow_with_the_files(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path, 6)
    i = Inputs(spark, str(tmp_path), keep=False)
    usual = X.COPIES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert X.customer_parts(i.monthly) == usual
    few = i.sized.exceptAll(i.sized.limit(0)).collect()
    monkeypatch.setattr(X, "PART_BYTES", 200)
    parts = X.customer_parts(i.monthly)
    assert usual < parts < X.MOST_PARTS and X.customer_parts(spark.range(9)) == usual
    monkeypatch.setattr(X, "MOST_PARTS", usual + 3)
    assert X.customer_parts(i.monthly) == usual + 3
    again = Inputs(spark, str(tmp_path), keep=False).sized
    plan = again._jdf.queryExecution().executedPlan().toString()
    # Both sides of the feature join come in the same number of partitions and are not shuffled again.
    assert plan.count(f", {usual + 3}), REPARTITION_BY_NUM") == 2
    assert sorted(map(str, again.collect())) == sorted(map(str, few))


def test_windows_of_one_size_equal_those_of_the_feature_table(spark, tmp_path):
    tables(spark, tmp_path, 8)
    i = Inputs(spark, str(tmp_path), keep=False)
    names = ["cms_code_enc", "window_end", *[f for f in MODEL_FEATURES if f in i.sized.columns], "item_2m_ago", "item_max_month"]
    assert "item_3m_ago" not in i.sized.columns  # no months that the size does not have
    want = i.features.filter("window_size = 3").select(names).collect()
    assert want and sorted(map(str, i.sized.select(names).collect())) == sorted(map(str, want))
