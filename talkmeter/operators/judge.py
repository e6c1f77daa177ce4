"""The judging stage: call a judge, parse its replies, build ledger rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.functions import labels

Judge = Callable[[str, str], str]

REPLY_SCHEMA = (
    "conversation_id bigint, conversation_type string, char_count bigint, "
    "reply string, error_name string, error_text string, retries int, latency_s double"
)

LEDGER_COLUMNS = [
    "conversation_id", "conversation_type", "outcome", *V.RUBRIC,
    "flag_dev_acknowledged", "reasoning", "char_count", "error",
    "prompt_version", "model", "prompt_hash", "classified_at",
]

ANSWER_FIELDS = ", ".join(
    [f"{name} string" for name in ["outcome", *V.RUBRIC, "flag_dev_acknowledged", "reasoning"]]
)


def call_judge(
    queue: DataFrame,
    judge: Judge,
    parallelism: int | None = None,
    attempts: int = V.JUDGE_ATTEMPTS,
    wait_seconds: float = V.JUDGE_WAIT_SECONDS,
) -> DataFrame:
    """Apply ``judge(text, type)`` to rows of (id, type, char_count, transcript).

    ``parallelism`` bounds the concurrent calls, as the number of tasks that call;
    without it the rows stay in the tasks they come in. ``plans.judging`` applies
    it to one slice of a queue at a time, so that a lost task repeats few calls. A
    rate-limited call waits longer each time and gives up after ``attempts``;
    any other failure becomes an error row and the batch goes on. This is the
    one place where user Python runs.
    """

    def one(content: str, kind: str) -> tuple[str | None, str | None, str | None, int]:
        retries = 0
        while True:
            try:
                return judge(content, kind), None, None, retries
            except Exception as problem:  # any failure stays inside its row
                name = type(problem).__name__
                if "ratelimit" not in name.lower():
                    return None, name, str(problem), retries
                retries += 1
                time.sleep(wait_seconds * retries)
                if retries >= attempts:
                    return None, name, f"Failed after {attempts} retries", retries

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content, kind in zip(batch["transcript"], batch["conversation_type"]):
                began = time.perf_counter()
                rows.append((*one(content, kind), time.perf_counter() - began))
            replies = pd.DataFrame(
                rows, columns=["reply", "error_name", "error_text", "retries", "latency_s"]
            )
            known = batch[["conversation_id", "conversation_type", "char_count"]]
            yield pd.concat([known.reset_index(drop=True), replies], axis=1)

    columns = ["conversation_id", "conversation_type", "char_count", "transcript"]
    rows = queue.select(*columns)
    if parallelism:
        rows = rows.repartition(parallelism)
    return rows.mapInPandas(run, REPLY_SCHEMA)


def score(column: Column) -> Column:
    return column.try_cast("decimal(38,0)").try_cast("int")


def parse_replies(replies: DataFrame) -> DataFrame:
    """Reply text to answer columns plus ``error``; a bad reply is not dropped.

    Code fences go, decoding starts at the first brace and text after the
    object is ignored. Fields are read as text first, so that a score given as
    a string counts too.
    """
    raw = F.trim(F.regexp_replace("reply", "```json|```", ""))
    opening = F.instr(F.col("raw"), "{")
    answer = F.from_json(
        F.when(opening > 0, F.substr(F.col("raw"), opening)),
        f"{ANSWER_FIELDS}, _broken string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"},
    )
    parsed = replies.withColumn("raw", raw).withColumn("answer", answer)
    outcome = F.col("answer.outcome")
    known = {name: F.col(name) for name in ("error_name", "error_text") if name in replies.columns}
    call_error = (
        F.when(known["error_name"].isNotNull(),
               F.concat("error_name", F.lit(": "), F.coalesce("error_text", F.lit(""))))
        if known else F.lit(None).cast("string")
    )

    def told(what: str) -> Column:
        """The reply stays in the message, so that the failure can be looked into."""
        return F.concat(F.lit(f"{what}: "), F.col("raw"))

    error = F.coalesce(
        call_error,
        F.when(F.col("raw").isNull(), "ValueError: no reply")
        .when(opening == 0, told("ValueError: No JSON object in response"))
        .when(F.col("answer._broken").isNotNull(), told("JSONDecodeError: broken JSON object"))
        .when(outcome.isNull() | (outcome == ""),
              told("ValueError: Missing outcome field in response")),
    )
    fine = error.isNull()
    return parsed.select(
        *replies.columns,
        error.alias("error"),
        F.when(fine, outcome).alias("outcome"),
        *[F.when(fine, score(F.col(f"answer.{name}"))).alias(name) for name in V.RUBRIC],
        F.when(fine, F.col("answer.flag_dev_acknowledged").try_cast("boolean"))
        .alias("flag_dev_acknowledged"),
        F.when(fine, F.col("answer.reasoning")).alias("reasoning"),
    )


def ledger_rows(
    parsed: DataFrame,
    version: str,
    model: str,
    prompt_hash: str,
    classified_at: str | Column,
    fixed_type: str | None = None,
) -> DataFrame:
    """Rows to append to the outcome ledger.

    Consultation batches write one fixed type; SQL batches write their own, or
    ``unknown`` when it is missing.
    """
    kind = F.lit(fixed_type) if fixed_type else F.coalesce("conversation_type", F.lit("unknown"))
    moment = F.lit(classified_at) if isinstance(classified_at, str) else classified_at
    return parsed.select(
        *[name for name in parsed.columns if name in LEDGER_COLUMNS and name != "conversation_type"],
        kind.alias("conversation_type"),
        F.lit(version).alias("prompt_version"),
        F.lit(model).alias("model"),
        F.lit(prompt_hash).alias("prompt_hash"),
        moment.cast("timestamp").alias("classified_at"),
    ).select(*LEDGER_COLUMNS)


def judge_events(parsed: DataFrame, at: Column) -> DataFrame:
    """Telemetry rows, one per call, in the shape the telemetry plans read."""
    name = F.regexp_extract("error", "^([A-Za-z]+)", 1)
    return parsed.select(
        at.alias("ts"),
        "conversation_type",
        "outcome",
        F.col("latency_s"),
        labels.error_class(F.when(F.col("error").isNotNull(), name)).alias("error_type"),
        F.col("retries").alias("retry_count"),
        *V.RUBRIC,
        "flag_dev_acknowledged",
    )
