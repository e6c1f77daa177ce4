"""Judging runs end to end: queue, transcripts, replies, ledger."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.operators import judge, queue, transcripts
from talkmeter.plans import validation
from talkmeter.session import new_run_folder
from talkmeter.sources import tables

# Calls that each concurrent task makes per slice, unless the caller says how many slices.
CALLS_PER_TASK = 100


@dataclass(frozen=True)
class JudgeProfile:
    """What a judge is and which conversations it scores."""

    name: str
    types: list[str]
    model: str
    version: str
    prompt_hash: str
    limits: dict[str, int] = field(default_factory=lambda: V.CONSULTATION_LIMITS)
    fixed_type: str | None = None


def consultation_profile(model: str, version: str, prompt_hash: str) -> JudgeProfile:
    return JudgeProfile(
        "consultation", V.CONSULTATION_TYPES, model, version, prompt_hash,
        V.CONSULTATION_LIMITS, "consultation",
    )


def sql_output_profile(model: str, version: str, prompt_hash: str) -> JudgeProfile:
    return JudgeProfile(
        "sql_output", V.SQL_TYPES, model, version, prompt_hash, V.SQL_OUTPUT_LIMITS
    )


def with_transcripts(work: DataFrame, messages: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Queue rows with their capped transcript; no messages means empty text."""
    texts = transcripts.capped_transcripts(queue.only_queued(messages, work), limits)
    return work.join(texts, "conversation_id", "left").fillna({"transcript": "", "char_count": 0})


def judge_batch(
    work: DataFrame, messages: DataFrame, call: judge.Judge, profile: JudgeProfile,
    **settings: float,
) -> DataFrame:
    """Parsed judge results of a written queue."""
    ready = with_transcripts(work, messages, profile.limits)
    return judge.parse_replies(judge.call_judge(ready, call, **settings))


def judge_in_slices(
    work: DataFrame, messages: DataFrame, call: judge.Judge, profile: JudgeProfile, folder: str,
    slices: int | None, each: Callable[[DataFrame], None], parallelism: int = V.JUDGE_PARALLELISM,
    **settings: float,
) -> DataFrame:
    """Judge a written queue slice by slice; ``each`` takes every finished slice.

    The transcripts of the whole queue are built once and written by slice, in
    as many tasks as they need. The judge then sees one slice at a time in
    ``parallelism`` tasks, so the limit on concurrent calls doesn't limit the
    work on texts, and a lost task repeats its share of one slice.
    """
    spark = work.sparkSession
    if slices is None:
        slices = max(1, -(-work.count() // (parallelism * CALLS_PER_TASK)))
    part = F.pmod(F.xxhash64("conversation_id"), F.lit(slices)).cast("int")
    ready = with_transcripts(work, messages, profile.limits).withColumn("slice", part)
    ready.write.partitionBy("slice").parquet(f"{folder}/ready")
    ready = spark.read.schema(ready.schema).parquet(f"{folder}/ready")
    for number in range(slices):
        replies = judge.call_judge(
            ready.filter(F.col("slice") == number), call, parallelism=parallelism, **settings
        )
        results = judge.parse_replies(replies)
        results.write.parquet(f"{folder}/results/slice={number}")
        each(spark.read.schema(results.schema).parquet(f"{folder}/results/slice={number}"))
    return spark.read.schema(results.schema).parquet(f"{folder}/results")


def run_judge(
    typed: DataFrame, messages: DataFrame, ledger: DataFrame, ledger_path: str,
    call: judge.Judge, profile: JudgeProfile, classified_at: str, copy_path: str | None = None,
    slices: int | None = None, **settings: float,
) -> DataFrame:
    """Judge what is due and append it to the ledger; returns the appended rows.

    Replies are written once and read back, so the ledger rows and the JSON
    copy never call the judge a second time. Each slice is appended on its own:
    a run that dies loses the slice at hand, and the next run queues just what
    is missing. Without ``slices`` a slice holds some calls per concurrent task.
    """
    spark = typed.sparkSession
    folder = new_run_folder(spark, f"judge-{profile.name}")
    due = queue.judge_queue(typed, ledger, profile.types, profile.version, ordered=False)
    work = queue.written(due, f"{folder}/queue")

    def append(done: DataFrame) -> None:
        tables.append_ledger(rows_of(done, profile, classified_at), ledger_path)

    results = judge_in_slices(work, messages, call, profile, folder, slices, append, **settings)
    rows = rows_of(results, profile, classified_at)
    if copy_path:
        tables.write_jsonl(rows, copy_path)
    return rows


def rows_of(results: DataFrame, profile: JudgeProfile, classified_at: str) -> DataFrame:
    return judge.ledger_rows(
        results, profile.version, profile.model, profile.prompt_hash, classified_at,
        profile.fixed_type,
    )


def run_validation(
    labelled: DataFrame, messages: DataFrame, ledger_path: str, call: judge.Judge,
    profile: JudgeProfile, run_id: str, run_at: str, **settings: float,
) -> DataFrame:
    """Score every labelled conversation and append the comparison."""
    spark = labelled.sparkSession
    folder = new_run_folder(spark, f"validation-{run_id}")
    cases = labelled.select(
        "conversation_id", F.lit(profile.fixed_type or profile.name).alias("conversation_type")
    ).distinct()
    work = queue.written(cases, f"{folder}/cases")
    results = judge_in_slices(
        work, messages, call, profile, folder, None, lambda done: None, **settings
    )
    rows = validation.validation_rows(
        labelled, results, run_id, run_at, profile.version, profile.model, profile.prompt_hash
    )
    tables.append_ledger(rows, ledger_path)
    return rows
