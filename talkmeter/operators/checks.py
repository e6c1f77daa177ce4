"""Data-quality checks; a check returns failing rows, an empty result passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmeter.functions.casting import cast_as
from talkmeter.session import new_run_folder


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; NULL keys are left to ``not_null``."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count()
    return counts.filter("count > 1").select(
        F.col(key).cast("string").alias("key"), F.col("count").alias("rows")
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: (column, failing)."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counted.unpivot([], columns, "column", "failing")


def unexpected_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Values outside the accepted list with their counts; NULL passes."""
    return (
        df.filter(~F.col(column).isin(accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def rates_out_of_range(drift: DataFrame, column: str = "outcome_agreement_rate") -> DataFrame:
    """Rows whose rate is no proportion."""
    outside = (F.col(column) < 0) | (F.col(column) > 1)
    return drift.filter(outside).select("validation_run_id", "prompt_version", column)


def cast_losses(raw: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Values that are present as text but lost by the staging cast, per column."""
    lost = [
        F.count_if(F.col(name).isNotNull() & cast_as(name, kind).isNull()).alias(name)
        for name, kind in kinds.items()
        if kind != "text"
    ]
    names = [name for name, kind in kinds.items() if kind != "text"]
    return raw.agg(*lost).unpivot([], names, "column", "failing")


def table_report(
    table: str,
    df: DataFrame,
    unique: list[str] = (),
    not_null: list[str] = (),
    accepted: dict[str, list[str]] | None = None,
) -> DataFrame:
    """All checks of one table as (check, table, column, failing).

    One pass over the table: rows fold per value of the first unique key, which
    combines on the map side, and those folds sum up to all results. The fold of the
    NULL key counts that key's NULLs, so it needs no count of its own. Further
    unique keys cost a pass each.
    """
    folded_key = unique[0] if unique else None
    failing = {("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null if c != folded_key}
    failing |= {
        ("accepted_values", c): F.count_if(~F.col(c).isin(values))
        for c, values in (accepted or {}).items()
    }
    names = [f"failing_{i}" for i in range(len(failing))]
    counts = [count.alias(name) for name, count in zip(names, failing.values())]
    results = {label: F.coalesce(F.sum(name), F.lit(0)) for label, name in zip(failing, names)}
    if unique:
        folded = df.groupBy(F.col(unique[0]).alias("key")).agg(F.count("*").alias("rows"), *counts)
        repeated = F.count_if(F.col("key").isNotNull() & (F.col("rows") > 1))
        results[("unique", unique[0])] = repeated
        if unique[0] in not_null:
            missing = F.sum(F.when(F.col("key").isNull(), F.col("rows")))
            results[("not_null", unique[0])] = F.coalesce(missing, F.lit(0))
    else:
        folded = df.agg(*counts)
    rows = folded.agg(
        F.array(
            *[
                F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"),
                         total.alias("failing"))
                for (check, column), total in results.items()
            ]
        ).alias("results")
    ).select(F.inline("results"))
    for key in unique[1:]:
        repeated = duplicate_keys(df, key).agg(F.count("*").alias("failing"))
        rows = rows.unionByName(
            repeated.select(F.lit("unique").alias("check"), F.lit(key).alias("column"), "failing")
        )
    return rows.select("check", F.lit(table).alias("table"), "column", "failing")


def report(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


class GateFailed(RuntimeError):
    """Raised when a gate that must be empty returned rows."""


def require_empty(failing: DataFrame, gate: str) -> None:
    """Stop the job if a gate has failing rows; all of them are written to the shared folder.

    The error names how many there are and where they lie.
    """
    folder = new_run_folder(failing.sparkSession, f"gate-{gate}")
    failing.write.parquet(folder)
    count = failing.sparkSession.read.schema(failing.schema).parquet(folder).count()
    if count:
        raise GateFailed(f"{gate}: {count} failing rows in {folder}")
