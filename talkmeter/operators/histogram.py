"""Cumulative bucket histograms and quantiles read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound_name(bound: float) -> str:
    return f"{bound:g}"


def bucket_columns(value: Column, bounds: list[float]) -> list[Column]:
    """``value <= bound`` counts, one per bound, and the ``+Inf`` count."""
    counts = [F.count_if(value <= bound).alias(f"le_{i}") for i, bound in enumerate(bounds)]
    return [*counts, F.count(value).alias("le_inf")]


def wide_histogram(
    df: DataFrame, groups: list[Column | str], value: Column, bounds: list[float]
) -> DataFrame:
    """One row per group with its cumulative counts, sum and count."""
    observed = df.withColumn("_value", value).filter(F.col("_value").isNotNull())
    return observed.groupBy(*groups).agg(
        *bucket_columns(F.col("_value"), bounds), F.sum("_value").alias("total")
    )


def long_histogram(
    df: DataFrame, groups: list[str], value: Column, bounds: list[float]
) -> DataFrame:
    """(groups, le, cumulative_count, value_sum, value_count)."""
    wide = wide_histogram(df, groups, value, bounds)
    buckets = F.array(
        *[
            F.struct(F.lit(bound_name(b)).alias("le"), F.col(f"le_{i}").alias("n"))
            for i, b in enumerate(bounds)
        ],
        F.struct(F.lit("+Inf").alias("le"), F.col("le_inf").alias("n")),
    )
    return wide.select(
        *groups,
        F.explode(buckets).alias("bucket"),
        F.col("total").cast("double").alias("value_sum"),
        F.col("le_inf").alias("value_count"),
    ).select(
        *groups,
        F.col("bucket.le").alias("le"),
        F.col("bucket.n").alias("cumulative_count"),
        "value_sum",
        "value_count",
    )


def quantile(q: float, bounds: list[float]) -> Column:
    """Quantile of a wide histogram row, linear inside the bucket.

    The first bucket starts at 0; a rank beyond the last finite bound gives
    that bound.
    """
    rank = F.col("le_inf") * F.lit(q)
    estimate = F
    for i, bound in enumerate(bounds):
        lower = F.lit(float(bounds[i - 1])) if i else F.lit(0.0)
        below = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.nullif(F.col(f"le_{i}") - below, F.lit(0))
        value = lower + (F.lit(float(bound)) - lower) * (rank - below) / inside
        estimate = estimate.when(F.col(f"le_{i}") >= rank, value)
    return estimate.otherwise(F.lit(float(bounds[-1])))
