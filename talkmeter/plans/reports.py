"""Reports over the outcome fact.

Everything folds to a few rows inside Spark; only those leave it. Corpus-wide
values (span, limits) enter as scalar subqueries, not as joins.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from talkmeter import vocabulary as V
from talkmeter.functions import labels
from talkmeter.functions.text import split_ids


# --- reading -----------------------------------------------------------------


def load_classified(fact: DataFrame) -> DataFrame:
    return fact.filter("is_classified")


def derived(fact: DataFrame) -> DataFrame:
    """Tier and gate decision next to each outcome."""
    return fact.withColumns(
        {
            "outcome_tier": labels.outcome_tier(F.col("outcome")),
            "gate_decision": labels.gate_decision(F.col("outcome")),
        }
    )


def time_axis(fact: DataFrame) -> tuple[str | None, bool]:
    """The best time column of the schema and whether it is the fallback."""
    for name in V.TIME_AXES:
        if name in fact.columns:
            return name, name == V.FALLBACK_AXIS
    return None, False


def has_costs(fact: DataFrame) -> bool:
    return "total_cost_usd" in fact.columns


# --- corpus ---------------------------------------------------------------------


def corpus_census(typed: DataFrame) -> DataFrame:
    """Conversations per type and whether the type is classifiable."""
    return (
        typed.groupBy("conversation_type")
        .agg(F.count("*").alias("conversations"))
        .withColumn("is_classifiable", F.col("conversation_type").isin(V.CLASSIFIABLE_TYPES))
    )


def classification_coverage(fact: DataFrame) -> DataFrame:
    done = F.count_if("is_classified")
    return fact.agg(
        F.count("*").alias("classifiable"),
        done.alias("classified"),
        (F.count("*") - done).alias("backlog"),
        labels.rate(done, F.count("*")).alias("coverage"),
    )


def outcome_distribution(rows: DataFrame) -> DataFrame:
    """Rows per type and outcome, most frequent first; no outcome is ``error``."""
    return (
        rows.groupBy("conversation_type", F.coalesce("outcome", F.lit("error")).alias("outcome"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "conversation_type", "outcome")
    )


def tier_counts(classified: DataFrame) -> DataFrame:
    tier = labels.outcome_tier(F.col("outcome")).alias("tier")
    return classified.groupBy(tier).agg(F.count("*").alias("count"))


def tier_shares(rows: DataFrame, prefix: str = "") -> list[Column]:
    tier = labels.outcome_tier(F.col("outcome"))
    return [F.avg((tier == name).cast("double")).alias(f"{prefix}{name}") for name in V.TIERS]


def tier_rates(classified: DataFrame) -> DataFrame:
    success, failure, inconclusive = tier_shares(classified)
    return classified.agg(
        F.count("*").alias("classified"),
        success.alias("success_rate"),
        failure.alias("failure_rate"),
        inconclusive.alias("inconclusive_rate"),
    )


def rubric_means(classified: DataFrame) -> DataFrame:
    means = classified.agg(*[F.avg(name).alias(name) for name in V.RUBRIC])
    return means.unpivot([], V.RUBRIC, "dimension", "avg_score")


def dev_ack_rate(classified: DataFrame) -> DataFrame:
    """Share of acknowledged rows among SQL types; NULL flags are left out."""
    return classified.filter(F.col("conversation_type").isin(V.SQL_TYPES)).agg(
        F.avg(F.col("flag_dev_acknowledged").cast("double")).alias("ack_rate"),
        F.count("*").alias("conversations"),
    )


# --- cost ---------------------------------------------------------------------------


def mean_cost() -> Column:
    """Mean from the exact decimal sum, so it does not depend on row order."""
    cost = F.col("total_cost_usd")
    return labels.rate(F.sum(cost), F.count(cost))


def cost_concentration(classified: DataFrame) -> DataFrame:
    """Share of cost against share of conversations per type.

    The window spans the handful of type rows, not the fact.
    """
    per_type = classified.groupBy("conversation_type").agg(
        F.sum("total_cost_usd").alias("total_cost"),
        F.count("total_cost_usd").alias("count"),
    )
    corpus = W.partitionBy(F.lit(0))
    shares = per_type.withColumns(
        {
            "pct_of_cost": labels.rate(F.col("total_cost"), F.sum("total_cost").over(corpus)),
            "pct_of_count": labels.rate(F.col("count"), F.sum("count").over(corpus)),
        }
    )
    return shares.withColumns(
        {
            "total_cost": F.col("total_cost").cast("double"),
            "imbalance": F.col("pct_of_cost") - F.col("pct_of_count"),
        }
    )


def worst_concentration(classified: DataFrame) -> DataFrame:
    ranked = cost_concentration(classified).orderBy(F.desc("imbalance"), "conversation_type")
    return ranked.limit(1)


def cost_limits(classified: DataFrame, sigmas: float = V.OUTLIER_SIGMAS) -> DataFrame:
    cost = F.col("total_cost_usd").cast("double")
    return classified.agg(
        mean_cost().alias("mean_cost"),
        (mean_cost() + sigmas * F.stddev_samp(cost)).alias("threshold"),
    )


def cost_outliers(classified: DataFrame, sigmas: float = V.OUTLIER_SIGMAS) -> DataFrame:
    """Conversations above mean + 2 sample deviations, dearest first."""
    limit = cost_limits(classified, sigmas).select("threshold").scalar()
    above = classified.filter(F.col("total_cost_usd").cast("double") > limit)
    return above.orderBy(F.desc("total_cost_usd"), "conversation_id").select(
        "conversation_id", "conversation_type", "outcome", "total_cost_usd", "run_count"
    )


def cost_outlier_stats(classified: DataFrame, sigmas: float = V.OUTLIER_SIGMAS) -> DataFrame:
    limits = cost_limits(classified, sigmas)
    above = cost_outliers(classified, sigmas).agg(F.count("*"))
    return limits.withColumn("above_threshold", above.scalar())


# --- trends -----------------------------------------------------------------------------


def span_days(classified: DataFrame, axis: str) -> DataFrame:
    seconds = F.unix_timestamp(F.max(axis).cast("timestamp")) - F.unix_timestamp(
        F.min(axis).cast("timestamp")
    )
    return classified.agg(F.floor(seconds / 86400).alias("span_days"))


def period_granularity(classified: DataFrame, axis: str) -> DataFrame:
    """Span of the corpus and the granularity that fits it."""
    short = F.col("span_days") < V.MONTHLY_UNDER_DAYS
    return span_days(classified, axis).withColumn(
        "granularity", F.when(short, "monthly").otherwise("weekly")
    )


def period_start(classified: DataFrame, axis: str, granularity: str | None = None) -> Column:
    """Start of the week (Monday) or month; by default whichever suits the span."""
    week = F.date_trunc("week", axis).cast("timestamp_ntz")
    month = F.date_trunc("month", axis).cast("timestamp_ntz")
    if granularity == "weekly":
        return week
    if granularity == "monthly":
        return month
    short = period_granularity(classified, axis).select(F.col("granularity") == "monthly").scalar()
    return F.when(short, month).otherwise(week)


def with_period(classified: DataFrame, granularity: str | None = None) -> DataFrame:
    axis, _ = time_axis(classified)
    if axis is None:
        raise ValueError(f"no time column, tried {V.TIME_AXES}")
    dated = classified.filter(F.col(axis).isNotNull())
    return dated.withColumn("period", period_start(classified, axis, granularity))


def outcome_mix_by_period(classified: DataFrame, granularity: str | None = None) -> DataFrame:
    """Tier counts and shares per period; totals sum over at most three rows."""
    tier = labels.outcome_tier(F.col("outcome")).alias("outcome_tier")
    counts = (
        with_period(classified, granularity)
        .groupBy("period", tier)
        .agg(F.count("*").alias("count"))
    )
    total = F.sum("count").over(W.partitionBy("period"))
    return counts.withColumn("total", total).withColumn("share", F.col("count") / F.col("total"))


def rubric_by_period(classified: DataFrame, granularity: str | None = None) -> DataFrame:
    means = (
        with_period(classified, granularity)
        .groupBy("period")
        .agg(F.count("*").alias("n"), *[F.avg(name).alias(name) for name in V.RUBRIC])
    )
    return means.unpivot(["period", "n"], V.RUBRIC, "dimension", "avg_score")


def cost_by_period(classified: DataFrame, granularity: str | None = None) -> DataFrame:
    """Cost per period, anomalous conversations apart from normal ones."""
    bucket = F.when(F.col("conversation_type") == "anomalous", "anomalous").otherwise("normal")
    return (
        with_period(classified, granularity)
        .groupBy("period", bucket.alias("bucket"))
        .agg(
            F.sum("total_cost_usd").cast("double").alias("sum"),
            mean_cost().alias("mean"),
            F.count("total_cost_usd").alias("count"),
        )
    )


def period_bin_sizes(classified: DataFrame, granularity: str | None = None) -> DataFrame:
    sizes = with_period(classified, granularity).groupBy("period").agg(F.count("*").alias("n"))
    return sizes.withColumn("is_sparse", F.col("n") < V.SPARSE_PERIOD_BELOW)


# --- recent against all -------------------------------------------------------------------


def tier_drift_recent(classified: DataFrame, recent: int = V.RECENT_WINDOW) -> DataFrame:
    """Tier shares of the most recent N conversations against the whole corpus.

    The recent rows are a top-N, so no global sort happens. Rows without a time
    count as the most recent ones.
    """
    axis, _ = time_axis(classified)
    newest = classified.orderBy(
        F.col(axis).desc_nulls_first(), F.desc("conversation_id")
    ).limit(recent)

    def shares(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(*tier_shares(rows)).unpivot([], V.TIERS, "outcome_tier", name)

    both = shares(classified, "baseline_share").join(
        shares(newest, "recent_share"), "outcome_tier", "full"
    ).fillna(0.0, ["baseline_share", "recent_share"])
    seen = (F.col("baseline_share") > 0) | (F.col("recent_share") > 0)
    return both.filter(seen).withColumn("delta", F.col("recent_share") - F.col("baseline_share"))


# --- learning gate -----------------------------------------------------------------------------


def gate_counts(classified: DataFrame) -> DataFrame:
    """Rows per gate decision; all three decisions appear, unused ones as 0."""
    decision = labels.gate_decision(F.col("outcome"))
    counts = classified.agg(*[F.count_if(decision == name).alias(name) for name in V.GATE_DECISIONS])
    return counts.unpivot([], V.GATE_DECISIONS, "gate_decision", "count")


def gate_by_type(classified: DataFrame) -> DataFrame:
    return (
        derived(classified)
        .groupBy("conversation_type", "gate_decision")
        .agg(F.count("*").alias("count"))
    )


def review_queue(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("outcome").isin(V.REVIEW_OUTCOMES)).select(
        "conversation_id", "conversation_type", "reasoning"
    )


# --- explorer ---------------------------------------------------------------------------------------


def explorer_scope(
    classified: DataFrame, outcomes: list[str] | None, types: list[str] | None
) -> DataFrame:
    rows = derived(classified)
    if outcomes is not None:
        rows = rows.filter(F.col("outcome").isin(outcomes))
    if types is not None:
        rows = rows.filter(F.col("conversation_type").isin(types))
    return rows


def has_id(rows: DataFrame, ids: list[str]) -> Column:
    """Is the conversation one of the typed ids?

    Typed as numbers, so that the filter reaches the scan: bucketed and sorted marts then open the
    buckets of these ids, and in them the row groups that may hold them. Text that isn't a number
    as it would be printed names no conversation.
    """
    if not isinstance(rows.schema["conversation_id"].dataType, IntegralType):
        return F.col("conversation_id").cast("string").isin(ids)
    numbers = [int(i) for i in ids if re.fullmatch(r"0|-?[1-9][0-9]{0,18}", i)]
    return F.col("conversation_id").isin([n for n in numbers if -(2**63) <= n < 2**63])


def explorer_filter(
    classified: DataFrame, outcomes: list[str] | None = None, types: list[str] | None = None,
    id_text: str = "",
) -> DataFrame:
    """Rows by outcome, type and an optional typed id list."""
    rows = explorer_scope(classified, outcomes, types)
    if id_text.strip():
        rows = rows.filter(has_id(rows, split_ids(id_text)))
    shown = ["conversation_id", "conversation_type", "outcome", "gate_decision", "reasoning",
             "char_count", "total_cost_usd", *V.RUBRIC]
    return rows.select([name for name in shown if name in rows.columns])


def explorer_unmatched_ids(
    classified: DataFrame, id_text: str, outcomes: list[str] | None = None,
    types: list[str] | None = None,
) -> DataFrame:
    """Typed ids that no row in scope has."""
    spark = classified.sparkSession
    typed_ids = F.explode(F.array([F.lit(part) for part in split_ids(id_text)]).cast("array<string>"))
    searched = spark.range(1).select(typed_ids.alias("conversation_id"))
    rows = explorer_scope(classified, outcomes, types)
    found = rows.filter(has_id(rows, split_ids(id_text))).select(
        F.col("conversation_id").cast("string").alias("conversation_id")
    )
    return searched.join(found, "conversation_id", "left_anti")
