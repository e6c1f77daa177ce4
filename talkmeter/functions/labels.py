"""Labels derived from other columns: eras, types, tiers, gates, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkmeter import vocabulary as V


def corpus_era(created_at: Column, cut: str = V.ERA_CUT) -> Column:
    """A missing creation time counts as the later era."""
    early = created_at < F.lit(cut).cast("timestamp_ntz")
    return F.when(early, "pre_prefetch").otherwise("post_prefetch")


def type_flags() -> dict[str, Column]:
    """The eight boolean signals over a signal row; NULL turns give NULL."""
    c = F.col
    return {
        "is_ghost": c("total_turns") == 0,
        "is_anomalous": c("total_turns") > V.ANOMALOUS_ABOVE_TURNS,
        "is_unknown": (c("corpus_era") == "pre_prefetch")
        & (c("prefetch_call_count") == 0)
        & (c("sql_write_count") == 0)
        & (c("non_sql_write_count") == 0)
        & (c("total_turns") > 0),
        "has_generation_signal": (c("corpus_era") == "post_prefetch")
        & (c("prefetch_call_count") > 0),
        "has_sql_write": c("sql_write_count") > 0,
        "has_non_sql_write": c("non_sql_write_count") > 0,
        "has_execute_sql": c("execute_sql_count") > 0,
        "has_user_interrupt": c("user_rejected_tool_count") > 0,
    }


def conversation_type(flags: dict[str, Column] | None = None) -> Column:
    """One label per conversation; the first flag that holds decides."""
    flags = flags or type_flags()
    priority = [
        (flags["is_ghost"], "ghost"),
        (flags["is_anomalous"], "anomalous"),
        (flags["is_unknown"], "unknown"),
        (flags["has_generation_signal"] & flags["has_sql_write"], "generation"),
        (flags["has_sql_write"], "modification"),
        (flags["has_non_sql_write"], "diagnostic"),
    ]
    label = F
    for condition, name in priority:
        label = label.when(condition, name)
    return label.otherwise("consultation")


def outcome_tier(outcome: Column) -> Column:
    """Everything that is neither success nor inconclusive is a failure."""
    return (
        F.when(outcome.isin(V.SUCCESS_OUTCOMES), "success")
        .when(outcome == V.INCONCLUSIVE, V.INCONCLUSIVE)
        .otherwise("failure")
    )


def gate_decision(outcome: Column) -> Column:
    """Labels outside both lists block, unlisted failures included."""
    return (
        F.when(outcome.isin(V.SUCCESS_OUTCOMES), "allow")
        .when(outcome.isin(V.REVIEW_OUTCOMES), "block_review")
        .otherwise("block")
    )


def drift_band(
    rate: Column,
    baseline: Column,
    stable: float = V.STABLE_BELOW,
    moderate: float = V.MODERATE_BELOW,
) -> Column:
    """Band of the unrounded difference; rounding first would move edge rows."""
    distance = F.abs(rate - baseline)
    return (
        F.when(rate.isNull() | baseline.isNull(), "unknown")
        .when(distance < stable, "stable")
        .when(distance < moderate, "moderate")
        .otherwise("significant")
    )


def error_class(error_name: Column) -> Column:
    """Coarse class from the name of the raised error; NULL stays NULL."""
    name = F.lower(error_name)
    return (
        F.when(name.isNull(), F.lit(None).cast("string"))
        .when(name.contains("ratelimit"), "rate_limit")
        .when(name.contains("json") | name.contains("value"), "parse_error")
        .when(name.contains("timeout"), "timeout")
        .otherwise("unknown")
    )


def scored_only(outcome: Column, value: Column) -> Column:
    """Value of a conclusive outcome, else NULL (also for a missing outcome)."""
    return F.when(outcome != V.INCONCLUSIVE, value)


def unless_inconclusive(outcome: Column, value: Column) -> Column:
    """As above, but a missing outcome keeps its value."""
    return F.when(outcome.isNull() | (outcome != V.INCONCLUSIVE), value)


def rate(part: Column, whole: Column) -> Column:
    """Share as double; an empty whole gives NULL."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
