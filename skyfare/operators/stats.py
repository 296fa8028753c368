"""Correlation and regression metrics, each one aggregation pass with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """Pearson r for every ordered pair of ``cols``, long form (col_a, col_b, r).

    All pairs come from a single ``agg``; the one-row result is unpivoted with
    ``stack``, so nothing is collected.
    """
    cols = list(cols)
    pairs = [(a, b) for a in cols for b in cols]
    aggs = [F.round(F.corr(a, b), digits).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    stack_args = ", ".join(f"'{a}', '{b}', _r{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack_args}) AS (col_a, col_b, r)")


def residuals(df: DataFrame, label: str, prediction: str, out: str = "residual") -> DataFrame:
    return df.withColumn(out, F.col(label) - F.col(prediction))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n, rmse, r2 (1 - SSE/SST with SST = n * population variance).

    Without rows rmse is null; with a constant label r2 is null.
    """
    err = F.col(label) - F.col(prediction)
    n = F.count(F.lit(1))
    sse = F.sum(err * err)
    return df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        n.alias("n"),
        F.sqrt(F.try_divide(sse, n)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, F.var_pop(label) * n)).alias("r2"))


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return regression_metrics(df, label, prediction).select("rmse")


def r2(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return regression_metrics(df, label, prediction).select("r2")


def prediction_bounds(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Smallest and largest value over both the predictions and the true values."""
    return df.agg(F.least(F.min(label), F.min(prediction)).alias("low"),
                  F.greatest(F.max(label), F.max(prediction)).alias("high"))
