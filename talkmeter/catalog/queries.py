"""Registered queries: every operator over the whole of the driver's tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmeter import vocabulary as V
from talkmeter.catalog import fixtures as X
from talkmeter.functions import keys, labels, text
from talkmeter.operators import checks, judge, queue, running_transcripts, transcripts
from talkmeter.operators.latest import latest_by
from talkmeter.plans import (
    extensions, judging, marts, outcomes, reports, signals, staging, telemetry, validation,
)
from talkmeter.session import new_run_folder, streaming_session, wide_session
from talkmeter.sources import incremental, papers, tables
from talkmeter.streaming import papers as paper_stream
from talkmeter.streaming import signals as stream_signals
from talkmeter.streaming import sinks
from talkmeter.streaming import telemetry as stream_telemetry

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

MARK = "1998-06-15 00:00:00"
LOADED_AT = "2026-01-01 00:00:00"
EXPLORED_IDS = " 7, 12,, 140 , nope, 99999999"
JUDGE_MODEL = "judge-a"
JUDGE_PROMPT = "Score the conversation."
JUDGE_VERSION = "consultation_test0001"


def query(function: Query) -> Query:
    REGISTRY[function.__name__.removesuffix("_query")] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, so both engines print the same values."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles that come out of float sums, cut to stable digits."""
    return df.select(
        [
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- shared inputs ---------------------------------------------------------------


def signal_rows(spark: SparkSession, sf: str) -> DataFrame:
    return signals.conversation_signals(
        X.conversations(spark, sf), X.messages(spark, sf), X.runs(spark, sf), X.ERA_CUT
    )


def typed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return signals.conversation_types(signal_rows(spark, sf))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.outcome_fact(typed_rows(spark, sf), X.ledger(spark, sf))


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return reports.load_classified(fact(spark, sf))


def validation_fact(spark: SparkSession, sf: str) -> DataFrame:
    return validation.validation_fact(X.validation_ledger(spark, sf))


def drift(spark: SparkSession, sf: str) -> DataFrame:
    return validation.concept_drift(validation_fact(spark, sf))


STANDING: dict[tuple[str, str], tuple[SparkSession, str, dict[str, DataFrame]]] = {}


def mart_inputs(spark: SparkSession, sf: str) -> marts.Inputs:
    return marts.Inputs(
        X.conversations(spark, sf), X.messages(spark, sf), X.runs(spark, sf), X.ledger(spark, sf),
        X.validation_ledger(spark, sf), X.ERA_CUT,
    )


def standing_marts(
    spark: SparkSession, sf: str, *wanted: str, wide: bool = False
) -> dict[str, DataFrame]:
    """The marts of these tables, by default all; each is published once per application, by the first
    report that asks for it. ``wide`` opens them in the session for rows of many columns.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in STANDING:
        STANDING[key] = (wide_session(spark), new_run_folder(spark, "marts"), {})
    session, folder, built = STANDING[key]
    missing = [name for name in wanted or marts.BUILDERS if name not in built]
    if missing:
        built.update(
            marts.build_marts(session, folder, mart_inputs(session, sf), missing, standing=built)
        )
    if wide:
        return dict(built)
    return {
        name: tables.current(spark, f"{folder}/{name}", rows.schema) for name, rows in built.items()
    }


def landed(rows: DataFrame, key: str, early: dict[str, str]) -> DataFrame:
    return incremental.all_text(X.relanded(rows, key, early))


# --- 2.1 sources, sinks, incremental loading --------------------------------------


@query
def extract_parent_incremental(spark, sf):
    return plain(incremental.changed_since(X.conversations(spark, sf), MARK))


@query
def extract_behind_mark(spark, sf):
    """Landing lacks a seventh of the conversations and has a stale copy of an eleventh."""
    folder, rows = new_run_folder(spark, "landing"), X.conversations(spark, sf)
    stale = F.when(F.col("id") % 11 == 0, F.lit("stale")).otherwise(F.col("title"))
    incremental.land(rows.filter(F.col("id") % 7 != 0).withColumn("title", stale), folder, 1)
    landed_rows = incremental.newest_landed(spark.read.parquet(folder), staging.CONVERSATION_CHANGE)
    return plain(incremental.rows_behind_mark(rows, landed_rows))


@query
def watermark_advance(spark, sf):
    rows = incremental.changed_since(X.conversations(spark, sf), MARK)
    return incremental.next_mark(rows, MARK)


@query
def extract_runs_incremental(spark, sf):
    return plain(incremental.runs_since(X.runs(spark, sf), X.conversations(spark, sf), MARK))


@query
def extract_messages_incremental(spark, sf):
    return incremental.messages_since(X.messages(spark, sf), X.conversations(spark, sf), MARK)


@query
def land_raw_strings(spark, sf):
    folder = new_run_folder(spark, "landing")
    incremental.land(X.messages(spark, sf), folder)
    return spark.read.parquet(folder)


@query
def new_files_after_marker(spark, sf):
    return papers.new_files(X.paper_lines(spark, sf), "arxiv_20240102T000000.jsonl")


@query
def papers_parse_jsonl(spark, sf):
    parsed = papers.parse_lines(X.paper_lines(spark, sf), LOADED_AT)
    return parsed.withColumns({c: F.to_json(c) for c in ("authors", "categories")})


@query
def paper_id_from_url(spark, sf):
    return X.papers(spark, sf).select("id", "topic", text.id_from_url(F.col("id")).alias("paper_id"))


def upserted(spark, sf):
    """The table after the first files, then the later files merged into the buckets they touch."""
    folder = new_run_folder(spark, "papers")
    parsed = papers.parse_lines(X.paper_lines(spark, sf), LOADED_AT)
    early = F.col("s3_key") <= "arxiv_20240103T000000.jsonl"
    for part in (parsed.filter(early), parsed.filter(~early)):
        papers.merge_papers(part, folder, buckets=spark.sparkContext.defaultParallelism)
    return papers.current_papers(spark, folder)


@query
def papers_upsert(spark, sf):
    rows = upserted(spark, sf)
    return rows.withColumns({c: F.to_json(c) for c in ("authors", "categories")})


@query
def file_marker_advance(spark, sf):
    lines = X.paper_lines(spark, sf)
    batch = papers.new_files(lines, None)
    return papers.next_file_marker(batch, papers.parse_lines(lines, LOADED_AT), None)


@query
def load_run_summary(spark, sf):
    lines = X.paper_lines(spark, sf)
    return papers.load_summary(papers.decode_lines(lines), papers.new_files(lines, None), LOADED_AT)


@query
def load_file_summary(spark, sf):
    return papers.file_summary(papers.decode_lines(X.paper_lines(spark, sf)))


@query
def papers_parse_xml(spark, sf):
    parsed = papers.parse_entries(X.paper_entries(spark, sf))
    return parsed.withColumns({c: F.to_json(c) for c in ("authors", "categories")})


def topic_batches(spark, sf):
    rows = X.papers(spark, sf)
    columns = ["doc_id", "id", "title", "summary", "published"]
    return [rows.filter(F.col("topic") == t).select(*columns) for t in range(X.TOPICS)]


@query
def papers_union_topics(spark, sf):
    return papers.union_topics(topic_batches(spark, sf))


@query
def papers_keep_first(spark, sf):
    return papers.keep_first(papers.union_topics(topic_batches(spark, sf)), ["topic", "doc_id"])


@query
def sink_jsonl(spark, sf):
    folder = new_run_folder(spark, "jsonl")
    rows = X.papers(spark, sf).select("id", "title", "summary", "published", "authors", "categories")
    tables.write_jsonl(rows, folder)
    back = spark.read.schema(papers.RECORD_SCHEMA).json(folder)
    return back.withColumns({c: F.to_json(c) for c in ("authors", "categories")})


@query
def seed_labels(spark, sf):
    """Labels written as a CSV seed and read back with the declared types."""
    folder = new_run_folder(spark, "seed")
    rows = X.label_rows(spark, sf).select(
        "conversation_id", "expected_outcome", *[f"expected_{d}" for d in V.RUBRIC],
        F.lit("expert").alias("labeler"), F.lit("2026-06-17").cast("date").alias("labeled_at"),
        "label_cohort", "is_blind", F.lit("easy").alias("difficulty"),
    )
    rows.write.option("header", True).csv(folder)
    return tables.read_labels(spark, folder)


@query
def ledger_schema_evolve(spark, sf):
    rows = X.ledger(spark, sf)
    late = ["flag_dev_acknowledged", "prompt_version", "model", "prompt_hash"]
    first = rows.filter("conversation_type = 'consultation'").drop(*late)
    second = rows.filter("conversation_type <> 'consultation'")
    return tables.evolve(first, second)


@query
def load_classified(spark, sf):
    return plain(classified(spark, sf).orderBy("conversation_id"))


# --- 2.2 projections and typed staging ---------------------------------------------------


@query
def stg_conversations(spark, sf):
    raw = landed(X.conversations(spark, sf), "id", X.EARLY_CONVERSATION)
    return plain(staging.stg_conversations(raw)).drop(
        "conversation_uuid", "sdk_session_id", "is_active", "message_count", "total_runs",
        "last_message_at", "last_run_at", "learning_extraction_status", "summary",
    )


@query
def stg_runs(spark, sf):
    return plain(staging.stg_runs(landed(X.runs(spark, sf), "conversation_id", X.EARLY_RUN)))


@query
def stg_messages(spark, sf):
    raw = landed(X.messages(spark, sf), "conversation_id", X.EARLY_MESSAGE)
    return staging.stg_messages(raw)


@query
def stg_papers(spark, sf):
    rows = papers.parse_lines(X.paper_lines(spark, sf), F.lit(None).cast("string"))
    typed = staging.stg_papers(rows, LOADED_AT)
    return typed.withColumns({c: F.to_json(c) for c in ("authors", "categories")})


@query
def corpus_era(spark, sf):
    rows = X.conversations(spark, sf)
    return rows.select("id", labels.corpus_era(F.col("created_at"), X.ERA_CUT).alias("corpus_era"))


@query
def prefetch_to_write_gap(spark, sf):
    return signal_rows(spark, sf).select(
        "conversation_id", "first_prefetch_sequence", "first_write_sequence",
        "prefetch_to_write_gap",
    )


@query
def conversation_type_flags(spark, sf):
    return typed_rows(spark, sf).select(*signals.TYPE_COLUMNS[:-1])


@query
def conversation_type(spark, sf):
    return typed_rows(spark, sf).select("conversation_id", "conversation_type")


@query
def outcomes_masked(spark, sf):
    latest = outcomes.masked_outcomes(outcomes.latest_outcomes(X.ledger(spark, sf)))
    return latest.select("conversation_id", "outcome", *outcomes.MASKED, "char_count")


@query
def surrogate_keys(spark, sf):
    return X.validation_ledger(spark, sf).select(
        "validation_run_id", "conversation_id",
        keys.surrogate_key(F.col("validation_run_id"), F.col("conversation_id")).alias("key"),
    )


@query
def drift_band(spark, sf):
    return drift(spark, sf).select(
        "validation_run_id",
        labels.drift_band(F.col("outcome_agreement_rate"), F.col("baseline_agreement_rate"))
        .alias("drift_band"),
    )


@query
def outcome_tier(spark, sf):
    tier = labels.outcome_tier(F.col("outcome"))
    return X.ledger(spark, sf).select("reasoning", "outcome", tier.alias("outcome_tier"))


@query
def gate_decision(spark, sf):
    decision = labels.gate_decision(F.col("outcome"))
    return X.ledger(spark, sf).select("reasoning", "outcome", decision.alias("gate_decision"))


@query
def judge_fingerprint(spark, sf):
    rows = X.table(spark, sf, "documents")
    model, prompt = F.col("source"), F.col("text")
    return rows.select(
        "doc_id",
        keys.prompt_hash(model, prompt).alias("prompt_hash"),
        keys.prompt_version("consultation", model, prompt).alias("prompt_version"),
    )


# --- 2.3 filters -----------------------------------------------------------------------------


@query
def classifiable_corpus(spark, sf):
    rows = outcomes.classifiable(typed_rows(spark, sf))
    return rows.select(
        "conversation_id", "conversation_type", "has_generation_signal", "has_sql_write",
        "has_non_sql_write", "has_execute_sql", "has_user_interrupt",
    )


@query
def review_queue(spark, sf):
    return reports.review_queue(classified(spark, sf))


@query
def latest_run_cases(spark, sf):
    return validation.latest_run_cases(validation_fact(spark, sf))


@query
def explorer_filter(spark, sf):
    return plain(
        reports.explorer_filter(
            classified(spark, sf),
            ["success_clean", "inconclusive", "failure_schema_gap"],
            ["consultation", "modification", "generation"],
        )
    )


@query
def explorer_search(spark, sf):
    return plain(reports.explorer_filter(classified(spark, sf), id_text=EXPLORED_IDS))


@query
def explorer_search_mart(spark, sf):
    """The same search on the published fact, of which only the ids' buckets are opened."""
    fact_mart = reports.load_classified(standing_marts(spark, sf, "fct_outcomes")["fct_outcomes"])
    return plain(reports.explorer_filter(fact_mart, id_text=EXPLORED_IDS))


@query
def explorer_unmatched_ids(spark, sf):
    return reports.explorer_unmatched_ids(classified(spark, sf), EXPLORED_IDS)


@query
def cost_outliers(spark, sf):
    return plain(reports.cost_outliers(classified(spark, sf)))


# --- 2.4 signals and aggregations ---------------------------------------------------------------


def message_signal_columns(*columns: str) -> Query:
    def run(spark, sf):
        rows = signals.message_signals(X.messages(spark, sf))
        return rows.select("conversation_id", *columns)

    return run


SIGNAL_GROUPS = {
    "schema_prefetch_signals": ["prefetch_call_count", "first_prefetch_sequence"],
    "file_write_counts": ["sql_write_count", "non_sql_write_count", "first_write_sequence"],
    "execute_sql_signals": [
        "execute_sql_count", "execute_sql_success_count", "permission_error_count",
    ],
    "code_review_trajectory": [
        "code_review_count", "code_review_score_first", "code_review_score_last",
        "code_review_score_delta",
    ],
    "user_corrections": ["user_correction_count"],
    "stale_doc_warnings": ["stale_doc_warning_count"],
    "tool_error_signals": ["tool_use_error_count", "codebase_error_count"],
    "user_message_count": ["total_user_messages"],
    "user_rejected_tools": ["user_rejected_tool_count"],
}
for _name, _columns in SIGNAL_GROUPS.items():
    REGISTRY[_name] = message_signal_columns(*_columns)


@query
def review_score_extract(spark, sf):
    rows = X.messages(spark, sf).filter(
        (F.col("message_type") == "tool_result")
        & text.matches(F.lower("content"), V.REVIEW_SCORE_LINE)
    )
    return rows.select("id", text.review_score(F.col("content")).alias("score"))


@query
def run_cost_signals(spark, sf):
    return plain(signals.run_costs(X.runs(spark, sf)))


@query
def conversation_signals(spark, sf):
    return plain(signal_rows(spark, sf))


@query
def conversation_signals_raw(spark, sf):
    """Signals straight from raw rows that repeat, counted once per id."""
    return plain(
        signals.conversation_signals(
            X.relanded(X.conversations(spark, sf), "id", X.EARLY_CONVERSATION),
            X.relanded(X.messages(spark, sf), "conversation_id", X.EARLY_MESSAGE),
            X.relanded(X.runs(spark, sf), "conversation_id", X.EARLY_RUN),
            X.ERA_CUT,
            dedupe=True,
        )
    )


@query
def corpus_census(spark, sf):
    return reports.corpus_census(typed_rows(spark, sf))


@query
def outcome_distribution(spark, sf):
    return reports.outcome_distribution(X.ledger(spark, sf))


@query
def dim_judge_version_loads(spark, sf):
    """The registry from three loads' stored bitmaps and counts."""
    folder, rows = new_run_folder(spark, "version-parts"), X.ledger(spark, sf)
    for load in range(3):
        part = rows.filter(F.pmod(F.xxhash64("conversation_id", "classified_at"), F.lit(3)) == load)
        outcomes.version_parts(part).write.mode("append").parquet(folder)
    return outcomes.judge_versions_of(spark.read.parquet(folder))


@query
def dim_judge_version(spark, sf):
    return outcomes.judge_versions(X.ledger(spark, sf))


@query
def validation_run_rollup(spark, sf):
    rows = validation.run_rollup(validation_fact(spark, sf))
    return rows.select(
        *validation.RUN_KEYS, "run_at", "n_cases", "n_passed", "error_count", "n_blind_cases",
        "n_blind_passed",
    )


@query
def rubric_agreement(spark, sf):
    return validation.rubric_agreement(validation_fact(spark, sf))


@query
def tier_rates(spark, sf):
    return reports.tier_rates(classified(spark, sf))


@query
def headline_agreement(spark, sf):
    return validation.headline_agreement(X.validation_ledger(spark, sf))


@query
def blind_cases(spark, sf):
    return validation.blind_cases(X.validation_ledger(spark, sf))


@query
def tier_counts(spark, sf):
    return reports.tier_counts(classified(spark, sf))


@query
def rubric_means(spark, sf):
    return reports.rubric_means(classified(spark, sf))


@query
def dev_ack_rate(spark, sf):
    return reports.dev_ack_rate(classified(spark, sf))


@query
def cost_concentration(spark, sf):
    return reports.cost_concentration(classified(spark, sf))


@query
def cost_concentration_top(spark, sf):
    return reports.worst_concentration(classified(spark, sf))


@query
def outcome_mix_by_period(spark, sf):
    return reports.outcome_mix_by_period(classified(spark, sf))


@query
def outcome_mix_by_month(spark, sf):
    return reports.outcome_mix_by_period(classified(spark, sf), "monthly")


@query
def rubric_by_period(spark, sf):
    return reports.rubric_by_period(classified(spark, sf), "monthly")


@query
def cost_by_period(spark, sf):
    return reports.cost_by_period(classified(spark, sf), "weekly")


@query
def period_bin_sizes(spark, sf):
    return reports.period_bin_sizes(classified(spark, sf))


@query
def period_granularity(spark, sf):
    return reports.period_granularity(classified(spark, sf), "conversation_created_at")


@query
def cost_outlier_stats(spark, sf):
    return rounded(reports.cost_outlier_stats(classified(spark, sf)))


@query
def gate_counts(spark, sf):
    return reports.gate_counts(classified(spark, sf))


@query
def gate_by_type(spark, sf):
    return reports.gate_by_type(classified(spark, sf))


@query
def validation_history_depth(spark, sf):
    return validation.history_depth(drift(spark, sf))


@query
def classification_coverage(spark, sf):
    return reports.classification_coverage(fact(spark, sf))


# --- 2.5 to 2.8 joins, windows, top-k, reshaping ---------------------------------------------------


@query
def latest_outcomes(spark, sf):
    return outcomes.latest_outcomes(X.ledger(spark, sf))


@query
def latest_outcomes_tied(spark, sf):
    """Times cut to days, so that many rows tie; the reasoning settles them."""
    day = F.date_trunc("day", "classified_at").cast("timestamp_ntz")
    rows = X.ledger(spark, sf).withColumn("classified_at", day)
    newest = latest_by(rows, ["conversation_id"], ["classified_at"], [F.desc("reasoning")])
    return newest.select("conversation_id", "classified_at", "reasoning", "outcome")


@query
def judge_queue_consultation(spark, sf):
    return queue.judge_queue(
        typed_rows(spark, sf), X.ledger(spark, sf), V.CONSULTATION_TYPES, X.NEW_VERSION
    )


@query
def judge_queue_sql_output(spark, sf):
    return queue.judge_queue(
        typed_rows(spark, sf), X.ledger(spark, sf), V.SQL_TYPES, X.NEW_VERSION
    )


@query
def judge_queue_rotated(spark, sf):
    """A version that no ledger row carries: everything queues again."""
    model, prompt = F.lit(JUDGE_MODEL), F.lit(JUDGE_PROMPT)
    return queue.judge_queue(
        typed_rows(spark, sf), X.ledger(spark, sf), V.CLASSIFIABLE_TYPES,
        keys.prompt_version("consultation", model, prompt),
    )


@query
def judge_queue_patch(spark, sf):
    """Re-run exactly the conversations whose ledger shows an error."""
    failed = X.ledger(spark, sf).filter(F.col("error").isNotNull()).select("conversation_id")
    return queue.patch_queue(typed_rows(spark, sf), failed)


def document_results(spark, sf):
    """One judge result per document, some missing and some failed."""
    doc = F.col("doc_id")
    outcome = (
        F.when(doc % 3 == 0, "success_clean").when(doc % 3 == 1, "failure_knowledge_gap")
        .otherwise("inconclusive")
    )
    failed = doc % 10 == 0
    return (
        X.table(spark, sf, "documents")
        .filter(doc % 9 != 0)
        .select(
            doc.alias("conversation_id"),
            F.when(~failed, outcome).alias("outcome"),
            *[F.when(~failed, ((doc + i) % 3 + 1).cast("int")).alias(name)
              for i, name in enumerate(V.RUBRIC)],
            F.length("text").alias("char_count"),
            F.when(failed, "ValueError: bad json").alias("error"),
        )
    )


@query
def judge_validation_run(spark, sf):
    return validation.validation_rows(
        X.label_rows(spark, sf), document_results(spark, sf), "run_x", LOADED_AT,
        JUDGE_VERSION, JUDGE_MODEL, "test0001",
    )


@query
def fct_validation_runs(spark, sf):
    return validation_fact(spark, sf)


@query
def fct_validation_runs_duplicated(spark, sf):
    """A ledger with accidental second inserts gives the same fact."""
    rows = X.validation_ledger(spark, sf)
    return validation.validation_fact(X.repeated(rows, "conversation_id"))


@query
def outcome_history(spark, sf):
    return outcomes.outcome_history(X.ledger(spark, sf))


@query
def fct_outcomes_mart(spark, sf):
    """The published fact, joined from bucketed marts without a shuffle."""
    return plain(standing_marts(spark, sf, "fct_outcomes", wide=True)["fct_outcomes"])


@query
def marts_sql(spark, sf):
    """Facts, history and staging by name in one SQL statement; the marts join as they lie."""
    built = standing_marts(spark, sf, "fct_outcomes", "outcome_history")
    marts.as_views(mart_inputs(spark, sf), built)
    return spark.sql("""
        SELECT f.conversation_type, count(*) AS conversations, count_if(f.is_classified) AS classified,
               sum(h.judgements) AS judgements, sum(c.total_turns) AS turns
        FROM fct_outcomes f
        JOIN stg_conversations c ON c.id = f.conversation_id
        LEFT JOIN (SELECT conversation_id, count(*) AS judgements FROM outcome_history
                   GROUP BY conversation_id) h ON h.conversation_id = f.conversation_id
        GROUP BY f.conversation_type""")


def folded(spark, sf, keys: list[str]) -> DataFrame:
    """The ledger in three loads, each folded into the rows that the loads before it left."""
    folder, rows = new_run_folder(spark, "ledger"), X.ledger(spark, sf)
    for load in range(3):
        part = rows.filter(F.pmod(F.xxhash64("conversation_id", "classified_at"), F.lit(3)) == load)
        tables.append_ledger(part, f"{folder}/ledger", by_version=False, load=load)
        newest = outcomes.fold_newest(
            spark, f"{folder}/ledger", f"{folder}/newest", keys, rows.schema,
            spark.sparkContext.defaultParallelism,
        )
    return newest


@query
def latest_outcomes_folded(spark, sf):
    return folded(spark, sf, outcomes.FACT_KEYS)


@query
def outcome_history_folded(spark, sf):
    return outcomes.history_of_newest(folded(spark, sf, outcomes.HISTORY_KEYS))


@query
def fct_concept_drift(spark, sf):
    return drift(spark, sf)


@query
def drift_latest_per_version(spark, sf):
    return validation.latest_per_version(drift(spark, sf))


@query
def drift_latest_run(spark, sf):
    return validation.newest_run(drift(spark, sf))


@query
def tier_drift_recent(spark, sf):
    built = standing_marts(spark, sf, "fct_outcomes")
    return reports.tier_drift_recent(reports.load_classified(built["fct_outcomes"]))


@query
def rubric_match_latest(spark, sf):
    return validation.rubric_match_latest(drift(spark, sf))


@query
def blind_split_latest(spark, sf):
    return validation.blind_split_latest(drift(spark, sf))


@query
def watermark_age(spark, sf):
    return telemetry.watermark_age(X.conversations(spark, sf), LOADED_AT)


# --- 2.10 transcripts ---------------------------------------------------------------------------------


@query
def transcript_truncated_messages(spark, sf):
    return transcripts.truncated_messages(X.dialogues(spark, sf), X.SMALL_LIMITS)


@query
def transcripts_query(spark, sf):
    return transcripts.transcript_parts(X.messages(spark, sf))


@query
def transcripts_dialogue(spark, sf):
    return transcripts.transcript_parts(
        X.dialogues(spark, sf), X.SMALL_LIMITS, block=3, part_chars=400
    )


@query
def transcripts_long(spark, sf):
    """Whole texts in pieces: conversations longer than a piece in one block."""
    return transcripts.transcript_parts(X.long_dialogues(spark, sf), part_chars=20_000)


@query
def transcripts_capped(spark, sf):
    return transcripts.capped_transcripts(X.messages(spark, sf))


@query
def transcripts_followed(spark, sf):
    """Three loads, each with the messages that come after those of the load before."""
    path = new_run_folder(spark, "transcripts")
    messages, position = X.long_dialogues(spark, sf), F.col("sequence_number")
    for part in (position < 5, (position >= 5) & (position < 11), position >= 11):
        running_transcripts.load(
            messages.filter(part), path, whole=False, buckets=spark.sparkContext.defaultParallelism
        )
    return running_transcripts.current(spark, path)


@query
def transcripts_reloaded(spark, sf):
    """A load of all conversations, a fifth of them as they were, and one of that fifth as it is."""
    path = new_run_folder(spark, "transcripts")
    raw = staging.typed(landed(X.messages(spark, sf), "conversation_id", X.EARLY_MESSAGE), staging.MESSAGES)
    touched = F.col("conversation_id") % 5 == 0
    for part in (raw.filter(~touched | (F.col(staging.LOAD) == 1)), raw.filter(F.col(staging.LOAD) == 2)):
        running_transcripts.load(part, path, buckets=spark.sparkContext.defaultParallelism)
    return running_transcripts.current(spark, path)


@query
def transcripts_capped_sql_output(spark, sf):
    return transcripts.sql_output_transcripts(X.messages(spark, sf))


@query
def transcripts_capped_dialogue(spark, sf):
    return transcripts.capped_transcripts(
        X.dialogues(spark, sf), X.SMALL_LIMITS, **X.SMALL_CAP, block=2
    )


@query
def transcripts_capped_long(spark, sf):
    """Texts above every limit of the consultation judge, in conversations above the cap."""
    return transcripts.capped_transcripts(X.long_dialogues(spark, sf))


@query
def transcripts_capped_long_sql_output(spark, sf):
    return transcripts.sql_output_transcripts(X.long_dialogues(spark, sf))


@query
def transcripts_capped_documents(spark, sf):
    """Whole documents as single long messages, some far above the cap."""
    rows = X.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("conversation_id"),
        F.lit("thinking").alias("message_type"), F.col("text").alias("content"),
        F.lit(1).alias("sequence_number"),
    )
    return transcripts.capped_transcripts(rows)


# --- 2.11 judge stage ------------------------------------------------------------------------------------


def rule_judge() -> judge.Judge:
    """A stand-in judge whose answer follows from the text length alone.

    It is a closure over plain values, so executors need no copy of this package.
    """
    rubric = list(V.RUBRIC)

    def answer(content: str, kind: str) -> str:
        size = len(content)
        if size % 7 == 0:
            raise ValueError("cannot judge")
        if size % 11 == 0:
            raise TimeoutError("too slow")
        scores = {name: (size + i) % 3 + 1 for i, name in enumerate(rubric)}
        reply = {
            "outcome": ["success_clean", "failure_abandoned", "inconclusive"][size % 3],
            **scores,
            "reasoning": f"{kind} of {size} characters",
        }
        return "```json\n" + json.dumps(reply) + "\n```\nThat is all."

    return answer


TEST_PROFILE = judging.consultation_profile(JUDGE_MODEL, JUDGE_VERSION, "test0001")


def judged(spark, sf):
    due = queue.judge_queue(
        typed_rows(spark, sf), X.ledger(spark, sf), V.CONSULTATION_TYPES, X.NEW_VERSION,
        ordered=False,
    )
    work = queue.written(due, new_run_folder(spark, "queue"))
    return judging.judge_batch(
        work, X.messages(spark, sf), rule_judge(), TEST_PROFILE, parallelism=8, wait_seconds=0
    )


@query
def judge_batch(spark, sf):
    return judged(spark, sf).select(
        "conversation_id", "conversation_type", "char_count", "error", "outcome", *V.RUBRIC,
        "reasoning",
    )


@query
def judge_ledger_append(spark, sf):
    rows = judge.ledger_rows(
        judged(spark, sf), JUDGE_VERSION, JUDGE_MODEL, "test0001", LOADED_AT, "consultation"
    )
    appended = tables.evolve(
        X.ledger(spark, sf).withColumn("char_count", F.col("char_count").cast("bigint")),
        rows.withColumn("classified_at", F.col("classified_at").cast("timestamp_ntz")),
    )
    return appended


REPLY_FORMS = {
    0: '{"outcome": "success_clean", "answer_grounding": 2, "reasoning": "plain"}',
    1: '```json\n{"outcome": "inconclusive", "actionability": 3}\n```',
    2: '{"outcome": "failure_abandoned", "resource_exhaustion": "1"} I hope this helps.',
    3: 'Here it is: {"outcome": "success_clean", "question_understanding": 1}',
    4: '{"outcome": "success_clean", "reasoning": "cut o',
    5: "I cannot answer that.",
    6: '{"outcome": "", "reasoning": "empty"}',
    7: None,
    8: '{"outcome": "success_iterative", "flag_dev_acknowledged": true}',
}


@query
def judge_reply_parse(spark, sf):
    form = F
    for number, reply in REPLY_FORMS.items():
        form = form.when(F.col("event_id") % 9 == number, F.lit(reply).cast("string"))
    replies = X.table(spark, sf, "events").select("event_id", form.alias("reply"))
    return judge.parse_replies(replies).drop("reply")


@query
def error_class(spark, sf):
    name = F.element_at(
        F.array(*[F.lit(n) for n in ("RateLimitError", "JSONDecodeError", "ValueError",
                                     "APITimeoutError", "KeyError")]),
        (F.col("event_id") % 5 + 1).cast("int"),
    )
    events = X.table(spark, sf, "events")
    named = events.select("event_id", F.when(F.col("event_type") == "error", name).alias("name"))
    return named.select("event_id", labels.error_class(F.col("name")).alias("error_class"))


# --- 2.12 marts and checks -----------------------------------------------------------------------------------


@query
def fct_outcomes(spark, sf):
    return plain(fact(spark, sf))


@query
def dq_unique(spark, sf):
    return checks.duplicate_keys(X.repeated(X.messages(spark, sf), "conversation_id"), "id")


@query
def dq_not_null(spark, sf):
    return checks.null_counts(
        X.messages(spark, sf), ["id", "conversation_id", "content", "tool_use_id"]
    )


@query
def dq_accepted_values(spark, sf):
    return checks.unexpected_values(X.ledger(spark, sf), "outcome", V.SEED_OUTCOMES)


@query
def dq_rate_range(spark, sf):
    return checks.rates_out_of_range(drift(spark, sf))


@query
def drift_gate(spark, sf):
    return validation.drift_gate(drift(spark, sf))


@query
def drift_gate_breached(spark, sf):
    """The series up to its dip, where the gate must fire."""
    early = validation.validation_fact(X.validation_ledger(spark, sf, run_count=6))
    return validation.drift_gate(validation.concept_drift(early))


@query
def dq_report(spark, sf):
    built = standing_marts(spark, sf, "fct_outcomes", "fct_validation_runs", "fct_concept_drift")
    parts = [
        checks.table_report(
            "conversations", X.conversations(spark, sf), ["id"], ["id"]
        ),
        checks.table_report("runs", X.runs(spark, sf), ["id"], ["id", "conversation_id"]),
        checks.table_report(
            "messages", X.repeated(X.messages(spark, sf), "conversation_id"), ["id"],
            ["id", "conversation_id"],
        ),
        checks.table_report(
            "outcomes", built["fct_outcomes"], ["conversation_id"],
            ["conversation_id", "conversation_type", "is_classified"],
            {"conversation_type": V.CLASSIFIABLE_TYPES},
        ),
        checks.table_report(
            "labels", X.label_rows(spark, sf), [],
            ["conversation_id", "expected_outcome", "label_cohort", "is_blind"],
            {"expected_outcome": V.SEED_OUTCOMES},
        ),
        checks.table_report(
            "validation_runs", built["fct_validation_runs"], ["validation_case_key"],
            ["validation_case_key", "validation_run_id", "outcome_passed"],
        ),
        checks.table_report(
            "concept_drift", built["fct_concept_drift"], [], ["validation_run_id", "prompt_version"],
            {"drift_band": V.DRIFT_BANDS},
        ),
    ]
    return checks.report(parts)


@query
def dq_cast_losses(spark, sf):
    """Raw documents read as if their texts were numbers, flags and times."""
    raw = incremental.all_text(X.table(spark, sf, "documents"))
    kinds = {"doc_id": "long", "n_chars": "int", "lang": "bool", "source": "time", "text": "money"}
    return checks.cast_losses(raw, kinds)


# --- 2.13 telemetry and streams ---------------------------------------------------------------------------------


@query
def telemetry_counters(spark, sf):
    return telemetry.counters(X.judge_events(spark, sf))


@query
def rows_fetched(spark, sf):
    return telemetry.rows_fetched(X.loads(spark, sf))


@query
def latency_histogram(spark, sf):
    return rounded(telemetry.latency_histogram(X.judge_events(spark, sf)), 4)


@query
def insert_latency_histogram(spark, sf):
    return rounded(telemetry.insert_latency_histogram(X.loads(spark, sf)), 4)


@query
def score_histogram(spark, sf):
    return telemetry.score_histogram(X.judge_events(spark, sf))


@query
def latency_quantiles(spark, sf):
    return rounded(telemetry.latency_quantiles(X.judge_events(spark, sf)))


@query
def latency_quantiles_native(spark, sf):
    return telemetry.quantile_ranks(X.judge_events(spark, sf))


@query
def error_rate_5m(spark, sf):
    return rounded(telemetry.error_rate(X.judge_events(spark, sf)))


@query
def error_rate_10m(spark, sf):
    return rounded(telemetry.error_rate(X.judge_events(spark, sf), "10 minutes"))


@query
def error_rate_5m_sliding(spark, sf):
    return rounded(telemetry.error_rate(X.judge_events(spark, sf), slide="1 minute"))


@query
def score_mean_24h(spark, sf):
    return telemetry.score_means(X.judge_events(spark, sf))


@query
def score_mean_trailing_24h(spark, sf):
    return telemetry.score_means_trailing(X.judge_events(spark, sf))


@query
def latency_quantiles_sliding(spark, sf):
    return rounded(telemetry.latency_quantiles_trailing(X.judge_events(spark, sf)))


@query
def latency_quantiles_sketched(spark, sf):
    """Quantiles of trailing windows from stored sketches, checked by the rank of what they return."""
    folder, events = new_run_folder(spark, "sketches"), X.judge_events(spark, sf)
    telemetry.latency_sketches(events).write.parquet(folder)
    quantiles = telemetry.sketched_quantiles(spark.read.parquet(folder))
    return telemetry.sketched_ranks(events, quantiles)


@query
def success_rate(spark, sf):
    return telemetry.success_rate(X.judge_events(spark, sf))


@query
def telemetry_totals(spark, sf):
    return telemetry.totals(X.judge_events(spark, sf))


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream of files; the glob fits a single file and a folder.

    Drained once, all files are one batch: a table whose files aren't in the order of event time has
    no late rows then.
    """
    schema = X.table(spark, sf, name).schema
    path = f"{sf}/[{name[0]}]{name[1:]}.parquet"
    # A stream that is drained once needs no more state partitions than it has tasks.
    session = streaming_session(spark, 2 * spark.sparkContext.defaultParallelism)
    return sinks.read_stream(session, path, schema)


def logged(spark, result: DataFrame, label: str, key_columns: list[str]) -> DataFrame:
    folder = new_run_folder(spark, label)
    sinks.run_change_log(result, f"{folder}/log", f"{folder}/checkpoint")
    return sinks.read_change_log(spark, f"{folder}/log", key_columns, result.schema)


@query
def stream_counters(spark, sf):
    events = X.to_judge_events(stream_of(spark, sf, "events"))
    keys_of = ["metric", "label_1", "label_2"]
    return logged(spark, stream_telemetry.counters(events), "counters", keys_of)


@query
def stream_error_rate_5m(spark, sf):
    events = X.to_judge_events(stream_of(spark, sf, "events"))
    result = stream_telemetry.error_rate(events, "10 minutes")
    key_columns = ["window_start", "conversation_type", "error_type"]
    return rounded(logged(spark, result, "error-rate", key_columns))


@query
def stream_score_means(spark, sf):
    events = X.to_judge_events(stream_of(spark, sf, "events"))
    result = stream_telemetry.score_means(events, "10 minutes")
    return logged(spark, result, "score-means", ["window_start", "dimension"])


@query
def stream_signals_query(spark, sf):
    folder = new_run_folder(spark, "signals")
    messages = X.to_messages(stream_of(spark, sf, "lineitem"))
    stream_signals.follow(messages, f"{folder}/flags", f"{folder}/checkpoint")
    return stream_signals.current_signals(read_flags(spark, messages, folder))


def read_flags(spark, messages, folder):
    return sinks.read_log(spark, f"{folder}/flags", stream_signals.flag_rows(messages).schema)


@query
def stream_signals_relanded(spark, sf):
    """A fifth of the messages as the first load had them, then all as the second load has them."""
    folder = new_run_folder(spark, "signals")
    rows = landed(X.messages(spark, sf), "conversation_id", X.EARLY_MESSAGE)
    for load in (1, 2):
        rows.filter(F.col(staging.LOAD) == load).write.mode("append").parquet(f"{folder}/landing")
        arriving = sinks.read_stream(spark, f"{folder}/landing", rows.schema)
        messages = staging.typed(arriving, staging.MESSAGES)
        stream_signals.follow(messages, f"{folder}/flags", f"{folder}/checkpoint")
    return stream_signals.current_signals(read_flags(spark, messages, folder))


@query
def stream_papers(spark, sf):
    folder = new_run_folder(spark, "papers")
    lines = X.paper_lines(spark, sf).select("value", "s3_key")
    lines.write.partitionBy("s3_key").text(f"{folder}/incoming")
    key = "regexp_extract(_metadata.file_path, 's3_key=([^/]+)', 1)"
    stream = paper_stream.line_stream(spark, f"{folder}/incoming", pattern="*.txt", key=key)
    paper_stream.ingest(stream, f"{folder}/log", f"{folder}/checkpoint", LOADED_AT)
    rows = paper_stream.current_papers(spark, f"{folder}/log")
    return rows.withColumns({c: F.to_json(c) for c in ("authors", "categories")})


# --- 2.15 documented, not computed by the reference -----------------------------------------------------------------


@query
def final_responses(spark, sf):
    return extensions.final_responses(X.messages(spark, sf))


@query
def final_responses_dialogue(spark, sf):
    return extensions.final_responses(X.dialogues(spark, sf))


@query
def connection_drops(spark, sf):
    return extensions.connection_drops(X.dialogues(spark, sf))


@query
def drop_rate_by_period(spark, sf):
    return extensions.drop_rate_by_period(X.messages(spark, sf), X.conversations(spark, sf))


@query
def duplicate_user_messages(spark, sf):
    return extensions.duplicate_user_messages(X.messages(spark, sf))


@query
def execute_sql_paired(spark, sf):
    return extensions.paired_executions(X.messages(spark, sf))


@query
def learning_gate(spark, sf):
    relevance = X.conversations(spark, sf).select(
        F.col("id").alias("conversation_id"), (F.col("id") % 3 + 1).cast("int").alias("relevance")
    )
    return extensions.learning_gate(classified(spark, sf), relevance)


@query
def eval_units(spark, sf):
    return extensions.eval_units(X.messages(spark, sf))


@query
def outcome_version_shift(spark, sf):
    history = outcomes.outcome_history(X.ledger(spark, sf))
    return extensions.outcome_version_shift(history, X.OLD_VERSION, X.NEW_VERSION)
