"""Prototype of confirmed churners and similarity to it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.functions.quantiles import exact_quantiles
from parcelwise.operators.eda import gram_sums
from parcelwise.operators.labels import feature_projection
from parcelwise.schemas import CUSTOMER, MODEL_FEATURES

PROTOTYPE_DDL = "mu array<double>, sigma_inv array<array<double>>, sigma2 double, features array<string>, n_confirmed bigint"


@dataclass
class Prototype:
    """Mean, inverse covariance and typical squared distance. Empty without features."""

    mu: np.ndarray
    sigma_inv: np.ndarray
    sigma2: float
    features: list[str]
    n_confirmed: int

    def __bool__(self) -> bool:
        return bool(self.features)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row of arrays, for a table."""
        row = (self.mu.tolist(), self.sigma_inv.tolist(), float(self.sigma2), self.features, self.n_confirmed)
        return spark.createDataFrame([row], PROTOTYPE_DDL)


EMPTY = Prototype(np.zeros(0), np.zeros((0, 0)), 1.0, [], 0)


def from_row(row) -> Prototype:
    return Prototype(np.array(row["mu"]), np.array(row["sigma_inv"]), row["sigma2"], list(row["features"]), row["n_confirmed"])


def prototype_moments(rows: DataFrame, features: list[str]) -> DataFrame:
    """Means and sample covariances ``(feature_a, feature_b, n, mean_a, cov)`` of complete rows."""
    sums = gram_sums(rows, features)
    names = F.array(*[F.lit(f) for f in features])
    n = F.col("n")
    return sums.select(
        F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"), "i", "j", "n",
        F.try_divide(F.col("sx"), n).alias("mean_a"),
        F.try_divide(F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n), n - 1).alias("cov"),
    )


def fit_prototype(df: DataFrame, ids: DataFrame, sigma_reg: float = 0.01, min_samples: int = 10, features: list[str] | None = None) -> Prototype:
    """Fit on the rows of the given ids; empty below ``min_samples`` rows.

    Sums are distributed; only the D x D moments reach the driver, where the
    matrix is inverted (pseudo-inverse when singular).
    """
    names = [f for f in (features or MODEL_FEATURES) if f in df.columns]
    members = feature_projection(df.join(ids.select(CUSTOMER).distinct(), CUSTOMER, "left_semi"), names, [F.col(CUSTOMER)]).persist()
    # Shifting by the mean keeps the products small.
    means = members.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in names]).first()
    if means["n"] < min_samples:
        return EMPTY
    mu = np.array([means[f] for f in names])
    centred = members.select(*[(F.col(f) - F.lit(float(m))).alias(f) for f, m in zip(names, mu)])
    sigma = np.zeros((len(names), len(names)))
    for r in prototype_moments(centred, names).select("i", "j", "cov").collect():  # D x D rows
        sigma[r["i"], r["j"]] = r["cov"]
    sigma += sigma_reg * np.eye(len(names))
    try:
        inverse = np.linalg.inv(sigma)
    except np.linalg.LinAlgError:
        inverse = np.linalg.pinv(sigma)
    proto = Prototype(mu, inverse, 1.0, names, means["n"])
    d2 = members.select(F.lit(1).alias("k"), squared_distance(proto).alias("d2"))
    proto.sigma2 = exact_quantiles(d2, ["k"], "d2", [0.5]).first()["quantiles"][0]
    members.unpersist()
    return proto


def squared_distance(proto: Prototype) -> Column:
    """Squared Mahalanobis distance to the prototype, by Arrow batches."""
    mu, inverse = proto.mu, proto.sigma_inv

    @F.pandas_udf("double")
    def run(x: pd.DataFrame) -> pd.Series:
        diff = x.to_numpy(dtype=float) - mu
        return pd.Series(np.maximum(0.0, np.einsum("ij,jk,ik->i", diff, inverse, diff, optimize=True)))

    return run(F.struct(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in proto.features]))


def similarity_scores(df: DataFrame, proto: Prototype) -> DataFrame:
    """Add ``sim_score`` in 0..1; 0 for an empty prototype."""
    if not proto:
        return df.withColumn("sim_score", F.lit(0.0))
    return df.withColumn("sim_score", C.similarity(squared_distance(proto), F.lit(float(proto.sigma2))))


def save_prototype(spark: SparkSession, cache: DataFrame | None, proto: Prototype, run_month: int, horizon: int) -> DataFrame:
    """The cache with this prototype merged in by ``(run_month, horizon)``."""
    from parcelwise.sources.upsert import merge_by_key

    row = proto.frame(spark).withColumns({"run_month": F.lit(run_month), "horizon": F.lit(horizon)})
    return row if cache is None else merge_by_key(cache, row, ["run_month", "horizon"])


def load_latest_prototype(cache: DataFrame, horizon: int, current_month: int | None = None, max_age: int = 3) -> Prototype:
    """Newest prototype of a horizon; empty when none or older than ``max_age`` months."""
    rows = cache.filter(F.col("horizon") == horizon).orderBy(F.col("run_month").desc()).limit(1)
    if current_month is not None:
        rows = rows.filter(C.yymm_diff(F.lit(current_month), F.col("run_month")) <= max_age)
    row = rows.first()
    return EMPTY if row is None else from_row(row)
