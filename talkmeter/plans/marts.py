"""The marts as tables: built once per load, read by reports, checks and gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from talkmeter import vocabulary as V
from talkmeter.plans import outcomes, signals, validation
from talkmeter.sources import tables


@dataclass(frozen=True)
class Inputs:
    """Typed staging tables (or raw ones that repeat rows, with ``dedupe``) and the two ledgers."""

    conversations: DataFrame
    messages: DataFrame
    runs: DataFrame
    outcome_ledger: DataFrame
    validation_ledger: DataFrame
    era_cut: str = V.ERA_CUT
    dedupe: bool = False


# What each mart is made of; a later one reads the earlier ones as they were written.
BUILDERS: dict[str, Callable[[Inputs, dict[str, DataFrame]], DataFrame]] = {
    "conversation_types": lambda given, built: signals.conversation_types(
        signals.conversation_signals(
            given.conversations, given.messages, given.runs, given.era_cut, given.dedupe
        )
    ),
    "latest_outcomes": lambda given, built: outcomes.latest_outcomes(given.outcome_ledger),
    "fct_outcomes": lambda given, built: outcomes.fact_of_latest(
        built["conversation_types"], built["latest_outcomes"]
    ),
    "outcome_history": lambda given, built: outcomes.outcome_history(given.outcome_ledger),
    "dim_judge_version": lambda given, built: outcomes.judge_versions(given.outcome_ledger),
    "fct_validation_runs": lambda given, built: validation.validation_fact(given.validation_ledger),
    "fct_concept_drift": lambda given, built: validation.concept_drift(built["fct_validation_runs"]),
}
# Marts with at most one row per conversation (and judge version) lie bucketed by conversation.
BY_CONVERSATION = ("conversation_types", "latest_outcomes", "fct_outcomes", "outcome_history")
NEEDS = {
    "fct_outcomes": ["conversation_types", "latest_outcomes"],
    "fct_concept_drift": ["fct_validation_runs"],
}


def build_marts(
    spark: SparkSession, base: str, given: Inputs, wanted: Sequence[str] = tuple(BUILDERS),
    buckets: int | None = None, standing: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Publish a version of the wanted marts below ``base``; returns them as readers see them.

    Marts that are ``standing`` are read and not built again. Types and facts have over forty columns:
    a ``wide_session``, and inputs read in it, builds them in half the time.

    Messages are scanned once, for the types; everything else reads what was
    written. Marts by conversation have the same buckets, by default as many as
    the session's shuffles have partitions: the fact joins types and outcomes
    as they lie, and so do readers. A build that dies leaves the versions that readers had.
    """
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = {*wanted, *(need for name in wanted for need in NEEDS.get(name, []))}
    built = dict(standing or {})
    for name in (name for name in BUILDERS if name in needed and name not in built):
        rows = BUILDERS[name](given, built)
        key = "conversation_id" if name in BY_CONVERSATION else None
        tables.publish(rows, f"{base}/{name}", bucket_by=key, buckets=count)
        built[name] = tables.current(spark, f"{base}/{name}", rows.schema)
    return built


def as_views(given: Inputs, built: dict[str, DataFrame]) -> list[str]:
    """Name the layers for SQL: staging as views over its inputs, marts as views of their tables."""
    named = {
        "stg_conversations": given.conversations, "stg_messages": given.messages,
        "stg_runs": given.runs, "outcome_ledger": given.outcome_ledger,
        "validation_ledger": given.validation_ledger, **built,
    }
    for name, rows in named.items():
        rows.createOrReplaceTempView(name)
    return list(named)
