"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

The exploratory and drift queries read a stored feature table, as a monthly run
does; writing it is timed as ``write_window_tables``. Nothing is cached between
queries. Each number is the median of ``$BENCH_RUNS`` (3) runs to a no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from catalog.inputs import MAX_SIZE, T_OBS, W, Inputs
from parcelwise.operators import drift as D
from parcelwise.operators import eda as E
from parcelwise.operators import features as X
from parcelwise.operators import rollup as R
from parcelwise.session import local_session
from parcelwise.sources import tables as TB

# The months and features of the first measurements, so that rounds compare.
FLOOR, LAST = "1999-01-01", "2001-07-31"
EDA_FEATURES = (
    "item_sum item_avg revenue_avg complaint_avg weight_avg pct_delay pct_refund order_score_avg "
    "active_days recency frequency known_delay known_ratio"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=8)
    out = tempfile.mkdtemp(prefix="parcelwise-bench-")
    i = Inputs(spark, sf_dir, keep=False, first=FLOOR, last=LAST)
    stored = Inputs(spark, sf_dir, keep=False, first=FLOOR, last=LAST)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def table():
        if "features" not in stored.__dict__:
            stored.__dict__["features"] = TB.read_windows(spark, f"{out}/windows")
        return stored

    def drift():
        eda = table().eda
        profile = D.numeric_profile(eda.filter("window_end <> '0107'"), EDA_FEATURES)
        return D.feature_drift(eda.filter("window_end = '0107'").select("cms_code_enc", *EDA_FEATURES), profile)

    specs = i.specs
    monthly = R.monthly_rollup(i.shipments, FLOOR, LAST, with_days=True)
    work = {
        "monthly_rollup": lambda: noop(R.monthly_rollup(i.shipments, FLOOR, LAST)),
        "window_features": lambda: noop(X.window_features(monthly, i.complaints, specs, MAX_SIZE)),
        "write_window_tables": lambda: TB.write_window_tables(i.features, f"{out}/windows"),
        "customer_lifetime": lambda: noop(X.customer_lifetime(i.customer_month, i.info, i.shipments, FLOOR, T_OBS)),
        "lifetime_asof_all": lambda: noop(X.lifetime_asof_all(i.customer_month, specs, FLOOR)),
        "ewma": lambda: noop(X.ewma(table().features.filter(f"window_size = {W}"), W, 0.3)),
        "descriptive_stats": lambda: noop(E.descriptive_stats(table().eda, EDA_FEATURES)),
        "correlation_matrix": lambda: noop(E.correlation_matrix(table().eda, EDA_FEATURES)),
        "all_iv": lambda: noop(E.all_iv(table().eda, EDA_FEATURES, "target")),
        "feature_drift": lambda: noop(drift()),
    }
    times: dict[str, float] = {}
    for name, run in work.items():
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    spark.stop()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
