"""Judge against human labels: ledger, validation fact, drift and its gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.functions import keys, labels
from talkmeter.operators.latest import latest_by

RUN_KEYS = ["validation_run_id", "prompt_version", "model_version", "prompt_hash"]


def rubric_columns() -> list[str]:
    return [
        name
        for dimension in V.RUBRIC
        for name in (f"expected_{dimension}", f"actual_{dimension}", f"{dimension}_abs_error")
    ]


def validation_rows(
    labelled: DataFrame, results: DataFrame, run_id: str, run_at: str | Column,
    version: str, model: str, prompt_hash: str,
) -> DataFrame:
    """Ledger rows of one validation run.

    ``results`` holds one parsed judge reply per conversation (outcome, rubric,
    char_count, error). A label without a reply, or with a failed one, becomes
    an error row that did not pass.
    """
    judged = results.select(
        "conversation_id",
        F.col("outcome").alias("actual_outcome"),
        *[F.col(name).alias(f"actual_{name}") for name in V.RUBRIC],
        "char_count",
        "error",
        F.lit(True).alias("has_reply"),
    )
    rows = labelled.join(judged, "conversation_id", "left")
    error = F.when(F.col("has_reply"), F.col("error")).otherwise("no judge result")
    moment = F.lit(run_at) if isinstance(run_at, str) else run_at
    passed = F.coalesce(F.col("actual_outcome") == F.col("expected_outcome"), F.lit(False))
    scores = []
    for name in V.RUBRIC:
        expected, actual = F.col(f"expected_{name}"), F.col(f"actual_{name}")
        scores += [expected, actual, F.abs(expected - actual).alias(f"{name}_abs_error")]
    return rows.select(
        F.lit(run_id).alias("validation_run_id"),
        moment.cast("timestamp_ntz").alias("run_at"),
        "conversation_id",
        "label_cohort",
        "is_blind",
        F.lit(version).alias("prompt_version"),
        F.lit(model).alias("model"),
        F.lit(prompt_hash).alias("prompt_hash"),
        "expected_outcome",
        "actual_outcome",
        (passed & error.isNull()).alias("outcome_passed"),
        *scores,
        F.when(error.isNull(), F.col("char_count")).alias("char_count"),
        error.alias("error"),
    )


def validation_fact(ledger: DataFrame) -> DataFrame:
    """One row per run and conversation, duplicate inserts removed."""
    newest = latest_by(ledger, ["validation_run_id", "conversation_id"], ["run_at"])
    return newest.withColumnRenamed("model", "model_version").select(
        keys.surrogate_key(F.col("validation_run_id"), F.col("conversation_id"))
        .alias("validation_case_key"),
        "validation_run_id", "run_at", "conversation_id", "label_cohort", "is_blind",
        "prompt_version", "model_version", "prompt_hash",
        "expected_outcome", "actual_outcome", "outcome_passed",
        F.col("error").isNull().alias("is_scored"),
        F.col("error").isNotNull().alias("is_error"),
        "error",
        *rubric_columns(),
        "char_count",
    )


def run_rollup(fact: DataFrame) -> DataFrame:
    """Counts per run; errors are no disagreements and blind cases stay apart."""
    blind, scored, passed = F.col("is_blind"), F.col("is_scored"), F.col("outcome_passed")
    return fact.groupBy(*RUN_KEYS).agg(
        F.min("run_at").alias("run_at"),
        F.count_if(~blind & scored).alias("n_cases"),
        F.count_if(~blind & scored & passed).alias("n_passed"),
        F.count_if(F.col("is_error")).alias("error_count"),
        F.count_if(blind & scored).alias("n_blind_cases"),
        F.count_if(blind & scored & passed).alias("n_blind_passed"),
        *rubric_aggregates(),
    )


def rubric_aggregates() -> list[Column]:
    """Match rate and mean absolute error per dimension, where both sides exist."""
    columns = []
    for name in V.RUBRIC:
        error = F.col(f"{name}_abs_error")
        hit = F.when(F.col("is_scored") & error.isNotNull(), (error == 0).cast("double"))
        columns += [
            F.avg(hit).alias(f"{name}_match_rate"),
            F.avg(error).alias(f"{name}_mae"),
        ]
    return columns


def rubric_agreement(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*RUN_KEYS).agg(*rubric_aggregates())


def concept_drift(fact: DataFrame) -> DataFrame:
    """Agreement per run against the first run of the same judge version.

    The ledger is folded to one row per run once; the window over those rows
    holds a row per run of a version, however many cases a run has.
    """
    runs = run_rollup(fact).withColumns(
        {
            "outcome_agreement_rate": labels.rate(F.col("n_passed"), F.col("n_cases")),
            "blind_agreement_rate": labels.rate(F.col("n_blind_passed"), F.col("n_blind_cases")),
        }
    )
    # A missing run time sorts last; the run id settles equal times.
    from_first = Window.partitionBy("prompt_version").orderBy(
        F.col("run_at").asc_nulls_last(), "validation_run_id"
    )
    rate, base = F.col("outcome_agreement_rate"), F.col("baseline_agreement_rate")
    rows = runs.withColumn("baseline_agreement_rate", F.first(rate).over(from_first))
    measures = [f"{name}_{kind}" for name in V.RUBRIC for kind in ("match_rate", "mae")]
    return rows.select(
        *RUN_KEYS, "run_at",
        "n_cases", "n_passed", "error_count", "n_blind_cases", "n_blind_passed",
        "outcome_agreement_rate", "blind_agreement_rate", "baseline_agreement_rate",
        (rate - base).alias("agreement_delta_vs_baseline"),
        labels.drift_band(rate, base).alias("drift_band"),
        *measures,
    )


def latest_per_version(drift: DataFrame) -> DataFrame:
    return latest_by(drift, ["prompt_version"], ["run_at", "validation_run_id"]).select(
        "prompt_version", "run_at", "outcome_agreement_rate",
        "baseline_agreement_rate", "agreement_delta_vs_baseline",
    )


def drift_gate(drift: DataFrame, drop: float = V.GATE_DROP) -> DataFrame:
    """Versions whose latest run fell below the baseline by more than allowed."""
    return latest_per_version(drift).filter(F.col("agreement_delta_vs_baseline") < drop)


def headline_agreement(ledger: DataFrame) -> DataFrame:
    """Non-blind agreement per run as the console prints it: errors fail."""
    headline = ledger.filter(~F.col("is_blind"))
    return headline.groupBy("validation_run_id").agg(
        F.count_if("outcome_passed").alias("passed"),
        F.count("*").alias("cases"),
    )


def blind_cases(ledger: DataFrame) -> DataFrame:
    return ledger.filter("is_blind").select(
        "validation_run_id", "conversation_id", "expected_outcome", "actual_outcome",
        "outcome_passed",
    )


def newest_run(rows: DataFrame) -> DataFrame:
    """The single latest row by run time; the run id settles equal times."""
    return rows.orderBy(F.desc("run_at"), F.desc("validation_run_id")).limit(1)


def latest_run_cases(fact: DataFrame) -> DataFrame:
    """Case table of the latest run; its id is one scalar, not a join."""
    latest = newest_run(fact.select("validation_run_id", "run_at")).select("validation_run_id")
    return fact.filter(F.col("validation_run_id") == latest.scalar()).select(
        "conversation_id", "is_blind", "expected_outcome", "actual_outcome",
        "outcome_passed", "is_error",
    )


def history_depth(drift: DataFrame, sparse_below: int = V.SPARSE_HISTORY_BELOW) -> DataFrame:
    runs = drift.agg(F.count_distinct("validation_run_id").alias("runs"))
    return runs.withColumn("is_sparse", F.col("runs") < sparse_below)


def rubric_match_latest(drift: DataFrame) -> DataFrame:
    """Match rate per dimension of the latest run; empty if none is known."""
    rates = [f"{name}_match_rate" for name in V.RUBRIC]
    latest = newest_run(drift).filter(F.coalesce(*rates).isNotNull())
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), F.col(column).alias("match_rate"))
            for name, column in zip(V.RUBRIC, rates)
        ]
    )
    return latest.select(F.inline(pairs))


def blind_split_latest(drift: DataFrame) -> DataFrame:
    """Headline and blind agreement of the latest run as two rows."""
    blind = F.coalesce("blind_agreement_rate", F.lit(0.0))
    pairs = F.array(
        F.struct(F.lit("non-blind (headline)").alias("set"),
                 F.col("outcome_agreement_rate").alias("agreement")),
        F.struct(F.lit("blind (held out)").alias("set"), blind.alias("agreement")),
    )
    return newest_run(drift).select(F.inline(pairs))
