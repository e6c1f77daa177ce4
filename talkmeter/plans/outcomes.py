"""Outcome marts over the append-only ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from talkmeter import vocabulary as V
from talkmeter.functions import keys as key_functions
from talkmeter.functions import labels
from talkmeter.operators.latest import latest_by, newest_first
from talkmeter.sources import keyed, tables

MASKED = [*V.RUBRIC, "flag_dev_acknowledged", "reasoning"]

# Columns of the outcome fact, in order (fixed values).
FACT_COLUMNS = [
    "conversation_id", "conversation_type",
    "is_classified", "outcome", "classified_as_type", "classified_at",
    "prompt_version", "model_version", "prompt_hash",
    *MASKED,
    "char_count",
    "total_turns", "total_user_messages", "run_count",
    "total_cost_usd", "total_duration_ms", "avg_run_duration_ms",
    "corpus_era", "conversation_created_at",
    "prefetch_call_count", "first_prefetch_sequence",
    "sql_write_count", "non_sql_write_count", "first_write_sequence", "prefetch_to_write_gap",
    "execute_sql_count", "execute_sql_success_count", "permission_error_count",
    "code_review_count", "code_review_score_first", "code_review_score_last",
    "code_review_score_delta",
    "user_correction_count", "user_rejected_tool_count",
    "stale_doc_warning_count",
    "tool_use_error_count", "codebase_error_count",
    "has_generation_signal", "has_sql_write", "has_non_sql_write", "has_non_sql_deliverable",
    "has_execute_sql", "has_user_interrupt",
    "learning_extracted",
]


VERSION = ["prompt_version", "model_version", "prompt_hash"]
FACT_KEYS = ["conversation_id"]
HISTORY_KEYS = ["conversation_id", "prompt_version"]


def with_lineage(ledger: DataFrame) -> DataFrame:
    """Ledger under mart names."""
    return ledger.withColumnsRenamed(
        {"model": "model_version", "conversation_type": "classified_as_type"}
    )


def latest_outcomes(ledger: DataFrame) -> DataFrame:
    """Newest ledger row per conversation.

    An error row counts like any other, so it may hide an earlier success.
    """
    return latest_by(with_lineage(ledger), ["conversation_id"], ["classified_at"])


def classifiable(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("conversation_type").isin(V.CLASSIFIABLE_TYPES))


def masked_outcomes(latest: DataFrame) -> DataFrame:
    """Rubric, flag and reasoning only for conclusive outcomes."""
    outcome = F.col("outcome")
    return latest.withColumns({c: labels.scored_only(outcome, F.col(c)) for c in MASKED})


def outcome_fact(typed: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per classifiable conversation with its latest outcome, if any."""
    return fact_of_latest(typed, latest_outcomes(ledger))


def fact_of_latest(typed: DataFrame, newest: DataFrame) -> DataFrame:
    """The fact from outcomes that are the newest already; bucketed marts join as they lie."""
    latest = masked_outcomes(newest).select(
        "conversation_id", "outcome", "classified_as_type", "classified_at",
        "prompt_version", "model_version", "prompt_hash", *MASKED, "char_count",
    )
    fact = classifiable(typed).join(latest, "conversation_id", "left")
    return fact.withColumns(
        {
            "is_classified": F.col("outcome").isNotNull(),
            "has_non_sql_deliverable": F.col("has_non_sql_write"),
        }
    ).select(*FACT_COLUMNS)


def outcome_history(ledger: DataFrame) -> DataFrame:
    """Newest row per conversation and judge version."""
    versioned = with_lineage(ledger).filter(F.col("prompt_version").isNotNull())
    return history_of_newest(latest_by(versioned, HISTORY_KEYS, ["classified_at"]))


def history_of_newest(newest: DataFrame) -> DataFrame:
    outcome = F.col("outcome")
    return newest.select(
        key_functions.surrogate_key(F.col("conversation_id"), F.col("prompt_version"))
        .alias("conversation_version_key"),
        "conversation_id", "prompt_version", "model_version", "prompt_hash",
        "classified_as_type", "classified_at", "outcome",
        *[labels.unless_inconclusive(outcome, F.col(c)).alias(c) for c in MASKED],
        "char_count", "error",
    )


def fold_newest(
    spark: SparkSession, ledger: str, base: str, keys: list[str], schema: StructType,
    buckets: int = 64,
) -> DataFrame:
    """Newest ledger row per key, kept up below ``base`` load by load; returns the rows.

    ``schema`` is that of the ledger today; columns that older files lack are NULL there. Only loads
    after the last folded one are opened (their number is a partition of the ledger, and no file is
    asked for its schema), and only the buckets that they touch are rewritten. The rows are those that ``latest_by`` finds in the
    whole ledger: a later load with an older ``classified_at`` changes nothing. With ``HISTORY_KEYS``
    rows without a version take no part.
    """
    step, folded = tables.read_step(spark, f"{base}/_marks", "load", "-1")
    whole = StructType([*schema.fields, StructField(tables.LOAD, LongType())])
    rows = with_lineage(spark.read.schema(whole).parquet(ledger))
    columns = [field for field in rows.schema.fields if field.name != tables.LOAD]
    kept = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in columns)
    new = rows.filter(F.col(tables.LOAD) > int(folded))
    for key in keys[1:]:
        new = new.filter(F.col(key).isNotNull())
    upto = new.agg(F.max(tables.LOAD)).first()[0]
    if upto is not None:
        order = [*newest_first("classified_at"), F.xxhash64(*[F.col(f.name) for f in columns])]
        keyed.merge(
            new.drop(tables.LOAD), f"{base}/rows", kept, keys, order, buckets, batch_wins=False
        )
        tables.write_mark(spark, f"{base}/_marks", "load", str(upto), after=step)
    return keyed.read(spark, f"{base}/rows", kept)


def judge_versions(ledger: DataFrame) -> DataFrame:
    """Registry of judges: what each version scored, when and how much.

    Few versions share all rows, so rows fold by hash to one per (version,
    conversation) and are counted there; the types come from a fold of their
    own. No distinct count and no sort over rows remains.
    """
    version = VERSION
    versioned = with_lineage(ledger).filter(F.col("prompt_version").isNotNull())
    per_conversation = versioned.groupBy(*version, "conversation_id").agg(
        F.min("classified_at").alias("first_at"),
        F.max("classified_at").alias("last_at"),
        F.count("*").alias("rows"),
        F.count("error").alias("errors"),
    )
    counted = per_conversation.groupBy(*version).agg(
        F.min("first_at").alias("first_classified_at"),
        F.max("last_at").alias("last_classified_at"),
        F.sum("rows").alias("total_classifications"),
        F.count("conversation_id").alias("distinct_conversations"),
        F.sum("errors").alias("error_count"),
    )
    per_type = versioned.groupBy(*version, "classified_as_type").agg(F.count("*").alias("rows"))
    return registry(counted, per_type)


def registry(counted: DataFrame, per_type: DataFrame) -> DataFrame:
    """The registry's columns from its counts and one row per version and type."""
    version = VERSION
    types = per_type.groupBy(*[F.col(c).alias(f"_{c}") for c in version]).agg(
        F.collect_set("classified_as_type").alias("types")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in version]
    return counted.join(types, same).select(
        *version,
        F.array_min("types").alias("first_conversation_type"),
        F.size("types").cast("bigint").alias("distinct_conversation_types"),
        "first_classified_at", "last_classified_at", "total_classifications",
        "distinct_conversations", "error_count",
    )


def version_parts(ledger: DataFrame) -> DataFrame:
    """What one load of the ledger adds to the registry, in a form that adds up.

    Conversations are exact bitmaps, one row per version, type and 32,768 neighbouring ids: a
    conversation that comes again in a later load, or under another type, sets the same bit.
    """
    versioned = with_lineage(ledger).filter(F.col("prompt_version").isNotNull())
    identity = F.col("conversation_id")
    return versioned.groupBy(
        *VERSION, "classified_as_type", F.bitmap_bucket_number(identity).alias("bucket")
    ).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(identity)).alias("conversations"),
        F.min("classified_at").alias("first_at"), F.max("classified_at").alias("last_at"),
        F.count("*").alias("rows"), F.count("error").alias("errors"),
    )


def merged_parts(parts: DataFrame, *by: str) -> DataFrame:
    """Parts of several loads as one; a plain batch job for a registry of many loads."""
    return parts.groupBy(*VERSION, *by, "bucket").agg(
        F.bitmap_or_agg("conversations").alias("conversations"),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
        F.sum("rows").alias("rows"), F.sum("errors").alias("errors"),
    )


def judge_versions_of(parts: DataFrame) -> DataFrame:
    """The registry of all loads whose parts these are; the ledger itself is not read."""
    counted = merged_parts(parts).groupBy(*VERSION).agg(
        F.min("first_at").alias("first_classified_at"),
        F.max("last_at").alias("last_classified_at"),
        F.sum("rows").alias("total_classifications"),
        F.sum(F.bitmap_count("conversations")).alias("distinct_conversations"),
        F.sum("errors").alias("error_count"),
    )
    per_type = parts.groupBy(*VERSION, "classified_as_type").agg(F.count("*").alias("rows"))
    return registry(counted, per_type)
