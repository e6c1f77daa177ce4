"""Model tables derived from the driver's tables.

The driver's tables hold no chat logs, so every model table is a projection of
one of them (see FIXTURES.md). The expressions are plain SQL; where the two
dialects differ an entry is a (Spark, DuckDB) pair. Each mapping therefore gives
both a DataFrame and the CTE the oracle reads. No mapping needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter import vocabulary as V

Expression = str | tuple[str, str]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spark(columns: dict[str, Expression]) -> list[str]:
    pick = [e if isinstance(e, str) else e[0] for e in columns.values()]
    return [f"{e} AS {name}" for name, e in zip(columns, pick)]


def _duck(columns: dict[str, Expression]) -> str:
    pick = [e if isinstance(e, str) else e[1] for e in columns.values()]
    return ",\n  ".join(f"{e} AS {name}" for name, e in zip(columns, pick))


# --- A. chat logs from orders and lineitem ---------------------------------------

CONVERSATIONS: dict[str, Expression] = {
    "id": "o_orderkey",
    "user_id": "o_custkey",
    "title": "o_orderpriority",
    "total_turns": "CAST((o_orderkey * 7) % 90 AS INT)",
    "total_duration_ms": "o_orderkey % 100000",
    "total_cost_usd": "CAST(CAST(floor(o_totalprice * 100 + 0.5) AS DECIMAL(18,0)) * 0.0001 "
    "AS DECIMAL(10,4))",
    "learning_extracted_at": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END",
    "created_at": "o_orderdate",
    "updated_at": (
        "o_orderdate + make_dt_interval(CAST(o_orderkey % 30 AS INT))",
        "o_orderdate + to_days(CAST(o_orderkey % 30 AS INT))",
    ),
}

# The parts the message text is chosen by: a kind (k) and a variant (j).
LINE_PARTS: dict[str, Expression] = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_shipdate": "l_shipdate",
    "k": "CAST(l_partkey % 4 AS INT)",
    "j": "CAST(floor(l_partkey / 4) % 10 AS INT)",
    "position": "CAST((l_partkey % 100000000) * 8 + l_linenumber AS INT)",
    "line_key": "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), "
    "CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING), "
    "CAST(CAST(l_quantity AS BIGINT) AS STRING))",
}

CONTENT = """CASE k
    WHEN 0 THEN CASE j
      WHEN 0 THEN 'that is wrong'
      WHEN 1 THEN 'it should be monthly'
      WHEN 2 THEN 'use the other table'
      WHEN 3 THEN 'not quite right'
      WHEN 4 THEN 'count it Instead Of sum'
      ELSE 'show orders by month' END
    WHEN 1 THEN CASE j
      WHEN 0 THEN NULL
      ELSE 'final answer ' || CAST(j AS STRING) END
    WHEN 2 THEN CASE
      WHEN j <= 2 THEN 'schema_prefetch_tool(t=' || CAST(j AS STRING) || ')'
      WHEN j <= 4 THEN 'Write(file_path="/w/sql/q.sql")'
      WHEN j = 5 THEN 'Write(file_path="/w/notes.md")'
      WHEN j = 6 THEN 'TodoWrite(file_path="/w/sql/x")'
      ELSE 'execute_sql(select 1)' END
    ELSE CASE j
      WHEN 0 THEN 'preview: 10 rows'
      WHEN 1 THEN 'OperationalError: no role'
      WHEN 2 THEN 'Quality Score: ' || CAST(l_linenumber + 2 AS STRING) || '/10'
      WHEN 3 THEN 'quality score pending'
      WHEN 4 THEN '<tool_use_error>'
      WHEN 5 THEN 'ModuleNotFoundError: x'
      WHEN 6 THEN 'The tool use was rejected'
      WHEN 7 THEN 'Documentation sync last performed 2024-01-01'
      WHEN 9 THEN 'execution_status: error' END
    END"""

MESSAGES: dict[str, Expression] = {
    "id": (
        "CAST(conv(substr(md5(line_key), 1, 15), 16, 10) AS BIGINT)",
        "CAST('0x' || substr(md5(line_key), 1, 15) AS BIGINT)",
    ),
    "conversation_id": "l_orderkey",
    "message_type": "CASE k WHEN 0 THEN 'user' WHEN 1 THEN 'thinking' "
    "WHEN 2 THEN 'tool_call' ELSE 'tool_result' END",
    "content": CONTENT,
    "message_metadata": "CAST(NULL AS STRING)",
    "tool_use_id": "CASE WHEN k >= 2 THEN CAST(l_orderkey AS STRING) || '-' || "
    "CAST(l_linenumber AS STRING) END",
    "is_error": "(k = 3 AND j = 4)",
    "sequence_number": "position",
    "created_at": "l_shipdate",
}

RUNS: dict[str, Expression] = {
    "id": MESSAGES["id"],
    "conversation_id": "l_orderkey",
    "user_message_id": "CAST(NULL AS BIGINT)",
    "num_turns": "CAST(l_quantity AS INT)",
    "duration_ms": "CAST(l_quantity * 1000 AS BIGINT)",
    "cost_usd": "CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS DECIMAL(18,0)) * 0.0001 "
    "AS DECIMAL(10,4))",
    "sdk_session_id": "CAST(NULL AS STRING)",
    "started_at": "l_shipdate",
    "completed_at": "l_shipdate",
}
RUN_PARTS = {
    name: LINE_PARTS[name] for name in ("l_orderkey", "l_shipdate", "line_key")
} | {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice"}

# Orders span 1995 to 2001, so the era cut lies inside them.
ERA_CUT = "1998-01-01 00:00:00"


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_spark(CONVERSATIONS))


def to_messages(lines: DataFrame) -> DataFrame:
    """The mapping alone, so that a stream of lines can pass through it."""
    return lines.selectExpr(*_spark(LINE_PARTS)).selectExpr(*_spark(MESSAGES))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(table(spark, sf_dir, "lineitem"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").selectExpr(*_spark(RUN_PARTS))
    return parts.selectExpr(*_spark(RUNS))


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """A fifth of the rows a second time, unchanged."""
    return rows.unionByName(rows.filter(F.col(key) % 5 == 0))


# What the first landing of a touched row said: it differs from the last one, and its change
# time doesn't tell which is newer.
EARLY_CONVERSATION = {"title": "'draft'", "total_turns": "0", "learning_extracted_at": "NULL"}
EARLY_MESSAGE = {"content": "concat('Quality Score: 2147483647 execute_sql ', coalesce(content, ''))"}
EARLY_RUN = {"completed_at": "NULL", "cost_usd": "NULL", "duration_ms": "1"}


def relanded(rows: DataFrame, key: str, early: dict[str, str]) -> DataFrame:
    """The raw form of a touched fifth: landed changed, and as it is by the next load."""
    touched = F.col(key) % 5 == 0
    kinds = dict(rows.dtypes)
    old = rows.filter(touched).withColumns(
        {name: F.expr(sql).cast(kinds[name]) for name, sql in early.items()}
    )
    new = rows.withColumn("_load", F.when(touched, 2).otherwise(1).cast("bigint"))
    return new.unionByName(old.withColumn("_load", F.lit(1).cast("bigint")))


CTE_CONVERSATIONS = f"conversations_a AS (SELECT\n  {_duck(CONVERSATIONS)}\nFROM orders)"
CTE_MESSAGES = (
    f"line_parts AS (SELECT\n  {_duck(LINE_PARTS)}\nFROM lineitem),\n"
    f"messages_a AS (SELECT\n  {_duck(MESSAGES)}\nFROM line_parts)"
)
CTE_RUNS = (
    f"run_parts AS (SELECT\n  {_duck(RUN_PARTS)}\nFROM lineitem),\n"
    f"runs_a AS (SELECT\n  {_duck(RUNS)}\nFROM run_parts)"
)

# --- B. dialogues from conversations ------------------------------------------------

DIALOGUES: dict[str, Expression] = {
    "id": "CAST(conv_id AS BIGINT) * 1000 + turn",
    "conversation_id": "CAST(conv_id AS BIGINT)",
    "message_type": "CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'thinking' "
    "ELSE 'tool_result' END",
    "content": "text",
    "sequence_number": "CAST(turn AS INT)",
}
# Whole documents as messages of all four kinds, sixteen or so per conversation: texts above every
# limit, and conversations above the cap.
LONG_DIALOGUES: dict[str, Expression] = {
    "id": "doc_id",
    "conversation_id": "CAST(floor(doc_id / 16) AS BIGINT)",
    "message_type": "CASE doc_id % 4 WHEN 0 THEN 'user' WHEN 1 THEN 'thinking' "
    "WHEN 2 THEN 'tool_call' ELSE 'tool_result' END",
    "content": "text",
    "sequence_number": "CAST(doc_id % 16 AS INT)",
}


def long_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*_spark(LONG_DIALOGUES))


CTE_LONG_DIALOGUES = f"long_dialogues_b AS (SELECT\n  {_duck(LONG_DIALOGUES)}\nFROM documents)"

# Limits small enough to cut the texts at hand.
SMALL_LIMITS = {"tool_result": 200, "user": 300}
SMALL_CAP = {"cap": 800, "head": 500, "tail": 300}


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(*_spark(DIALOGUES))


CTE_DIALOGUES = f"dialogues_b AS (SELECT\n  {_duck(DIALOGUES)}\nFROM conversations)"

# --- C. outcome ledger from events ------------------------------------------------------

OUTCOME = """CASE event_type
    WHEN 'click' THEN 'success_clean'
    WHEN 'view' THEN 'success_iterative'
    WHEN 'purchase' THEN 'success_with_correction'
    WHEN 'signup' THEN CASE event_id % 4
      WHEN 0 THEN 'inconclusive' WHEN 1 THEN 'failure_wrong_direction'
      WHEN 2 THEN 'failure_knowledge_gap' ELSE 'failure_schema_gap' END
    ELSE CASE event_id % 4
      WHEN 1 THEN 'failure_abandoned' WHEN 2 THEN 'failure_environment' END
    END"""

VERSION: Expression = (
    "CASE WHEN event_id % 11 = 0 THEN NULL WHEN ts < TIMESTAMP_NTZ '2024-01-16 00:00:00' "
    "THEN 'consultation_aaaa1111' ELSE 'consultation_bbbb2222' END",
    "CASE WHEN event_id % 11 = 0 THEN NULL WHEN ts < TIMESTAMP '2024-01-16 00:00:00' "
    "THEN 'consultation_aaaa1111' ELSE 'consultation_bbbb2222' END",
)
OLD_VERSION = "consultation_aaaa1111"
NEW_VERSION = "consultation_bbbb2222"

EVENT_PARTS: dict[str, Expression] = {
    "event_id": "event_id", "ts": "ts", "user_id": "user_id", "value": "value",
    "event_type": "event_type", "label": OUTCOME, "version": VERSION,
}

SCORES: dict[str, Expression] = {
    name: f"CASE WHEN label IS NOT NULL THEN CAST(floor(event_id / {3 ** i}) % 3 + 1 AS INT) END"
    for i, name in enumerate(V.RUBRIC)
}

LEDGER: dict[str, Expression] = {
    "conversation_id": "user_id * 10 + event_id % 10",
    "conversation_type": "CASE event_id % 3 WHEN 0 THEN 'consultation' "
    "WHEN 1 THEN 'generation' ELSE 'modification' END",
    "outcome": "label",
    **SCORES,
    "flag_dev_acknowledged": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 5 = 0 END",
    "reasoning": "'because ' || CAST(event_id AS STRING)",
    "char_count": "CAST(floor(value * 100) AS INT)",
    "error": "CASE WHEN label IS NULL THEN 'RateLimitError: x' END",
    "prompt_version": "version",
    "model": "CASE WHEN version = 'consultation_bbbb2222' THEN 'judge-b' ELSE 'judge-a' END",
    "prompt_hash": "right(version, 8)",
    "classified_at": "ts",
}


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "events").selectExpr(*_spark(EVENT_PARTS))
    return parts.selectExpr(*_spark(LEDGER))


CTE_LEDGER = (
    f"event_parts AS (SELECT\n  {_duck(EVENT_PARTS)}\nFROM events),\n"
    f"ledger_c AS (SELECT\n  {_duck(LEDGER)}\nFROM event_parts)"
)

# --- D. validation ledger from labels, twelve runs -----------------------------------------

RUN_COUNT = 12
WRONG_PERCENT = [0, 5, 10, 8, 20, 30, 15, 8, 5, 17, 10, 5]

LABELS: dict[str, Expression] = {
    "conversation_id": "doc_id",
    "expected_outcome": "CASE WHEN quality = 1 AND toxic = 0 THEN 'success_clean' "
    "WHEN quality = 0 AND toxic = 0 THEN 'failure_knowledge_gap' "
    "WHEN quality = 1 THEN 'success_with_correction' ELSE 'inconclusive' END",
    **{
        f"expected_{name}": "CASE WHEN doc_id % 4 <> 0 "
        "THEN CAST(quality + 1 + doc_id % 2 AS INT) END"
        for name in V.RUBRIC
    },
    "label_cohort": "'cohort_' || CAST(doc_id % 2 AS STRING)",
    "is_blind": "(doc_id % 7 = 0)",
    "base_score": "CAST(quality + 1 + doc_id % 2 AS INT)",
}

_WRONG = "CASE r " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(WRONG_PERCENT)) + " END"

VALIDATION_PARTS: dict[str, Expression] = {
    "r": "r",
    **{name: name for name in LABELS},
    "failed": "((conversation_id + r) % 29 = 0)",
    "wrong": f"((conversation_id * 31 + r * 17) % 100 < {_WRONG})",
}

_ANSWERED = "CASE WHEN wrong THEN CASE WHEN expected_outcome = 'success_clean' " \
    "THEN 'failure_abandoned' ELSE 'success_clean' END ELSE expected_outcome END"


def _actual(place: int) -> str:
    return ("CASE WHEN NOT failed THEN CAST(least(3, greatest(1, base_score + "
            f"(conversation_id + r + {place}) % 3 - 1)) AS INT) END")


VALIDATION: dict[str, Expression] = {
    "validation_run_id": "'run_' || lpad(CAST(r AS STRING), 2, '0')",
    "run_at": (
        "TIMESTAMP_NTZ '2026-01-05 00:00:00' + make_dt_interval(CAST(7 * r AS INT))",
        "TIMESTAMP '2026-01-05 00:00:00' + to_days(CAST(7 * r AS INT))",
    ),
    "conversation_id": "conversation_id",
    "label_cohort": "label_cohort",
    "is_blind": "is_blind",
    "prompt_version": "CASE WHEN r < 9 THEN 'v1' ELSE 'v2' END",
    "model": "'judge-a'",
    "prompt_hash": "CASE WHEN r < 9 THEN '11111111' ELSE '22222222' END",
    "expected_outcome": "expected_outcome",
    "actual_outcome": f"CASE WHEN NOT failed THEN {_ANSWERED} END",
    "outcome_passed": "(NOT failed AND NOT wrong)",
    **{
        column: expression
        for i, name in enumerate(V.RUBRIC)
        for column, expression in (
            (f"expected_{name}", f"expected_{name}"),
            (f"actual_{name}", _actual(i)),
            (f"{name}_abs_error", f"abs(expected_{name} - {_actual(i)})"),
        )
    },
    "char_count": "CASE WHEN NOT failed THEN CAST(conversation_id % 5000 AS INT) END",
    "error": "CASE WHEN failed THEN 'ValueError: bad json' END",
}


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr(*_spark(LABELS))


def validation_ledger(spark: SparkSession, sf_dir: str, run_count: int = RUN_COUNT) -> DataFrame:
    per_run = label_rows(spark, sf_dir).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.lit(run_count - 1)))
    )
    return per_run.selectExpr(*_spark(VALIDATION_PARTS)).selectExpr(*_spark(VALIDATION))


CTE_LABELS = f"labels_d AS (SELECT\n  {_duck(LABELS)}\nFROM labels)"


def cte_validation(run_count: int = RUN_COUNT) -> str:
    return (
        f"{CTE_LABELS},\n"
        f"label_runs AS (SELECT l.*, CAST(g.range AS INT) AS r FROM labels_d l, "
        f"range({run_count}) g),\n"
        f"validation_parts AS (SELECT\n  {_duck(VALIDATION_PARTS)}\nFROM label_runs),\n"
        f"validation_d AS (SELECT\n  {_duck(VALIDATION)}\nFROM validation_parts)"
    )


# --- E. judge and load events from events -------------------------------------------------

JUDGE_EVENTS: dict[str, Expression] = {
    "ts": "ts",
    "conversation_type": "CASE user_id % 3 WHEN 0 THEN 'consultation' "
    "WHEN 1 THEN 'generation' ELSE 'modification' END",
    "outcome": "CASE WHEN event_type <> 'error' THEN label END",
    "latency_s": "value / 4",
    "error_type": "CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'rate_limit' "
    "WHEN 1 THEN 'parse_error' WHEN 2 THEN 'timeout' ELSE 'unknown' END END",
    "retry_count": "CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 3 "
    "ELSE CAST(event_id % 2 AS INT) END",
    **{
        name: f"CASE WHEN event_type <> 'error' "
        f"THEN CAST(floor(event_id / {3 ** i}) % 3 + 1 AS INT) END"
        for i, name in enumerate(V.RUBRIC)
    },
    "flag_dev_acknowledged": "CASE WHEN user_id % 3 = 0 THEN NULL ELSE event_id % 5 = 0 END",
}
LOADS: dict[str, Expression] = {
    "table_name": "CASE event_id % 3 WHEN 0 THEN 'conversations' "
    "WHEN 1 THEN 'conversation_runs' ELSE 'conversation_messages' END",
    "rows": "CAST(floor(value) AS BIGINT)",
    "insert_s": "value / 16",
}


def to_judge_events(events: DataFrame) -> DataFrame:
    """The mapping alone, so that a stream of events can pass through it."""
    return events.selectExpr(*_spark(EVENT_PARTS)).selectExpr(*_spark(JUDGE_EVENTS))


def judge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_judge_events(table(spark, sf_dir, "events"))


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_spark(LOADS))


CTE_JUDGE_EVENTS = (
    f"event_parts AS (SELECT\n  {_duck(EVENT_PARTS)}\nFROM events),\n"
    f"judge_e AS (SELECT\n  {_duck(JUDGE_EVENTS)}\nFROM event_parts)"
)
CTE_LOADS = f"loads_e AS (SELECT\n  {_duck(LOADS)}\nFROM events)"

# --- F. paper records from documents -----------------------------------------------------------

PAPERS: dict[str, Expression] = {
    "doc_id": "doc_id",
    "id": "'http://arxiv.org/abs/' || CAST(doc_id AS STRING) || '/'",
    "title": "concat_ws(' ', lang, source, CAST(doc_id AS STRING))",
    "summary": "text",
    "published": (
        "date_format(TIMESTAMP_NTZ '2024-01-01 00:00:00' + "
        "make_dt_interval(CAST(doc_id % 365 AS INT)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
        "strftime(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 365 AS INT)), "
        "'%Y-%m-%dT%H:%M:%SZ')",
    ),
    "source": "source",
    "lang": "lang",
    "topic": "CAST(doc_id % 6 AS INT)",
}
TOPICS = 6


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of six topics; a fifth of them shows up in the next topic again."""
    first = table(spark, sf_dir, "documents").selectExpr(*_spark(PAPERS))
    again = first.filter("doc_id % 5 = 0").withColumns(
        {
            "title": F.concat("title", F.lit("v2")),
            "topic": ((F.col("doc_id") + 1) % TOPICS).cast("int"),
        }
    )
    return first.unionByName(again).select(
        "doc_id", "id", "title", "summary", "published",
        F.array("source", "lang").alias("authors"),
        F.array("lang").alias("categories"),
        "topic",
    )


def paper_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSONL lines of one file per topic, some broken and some without a date."""
    record = ["id", "title", "summary", "published", "authors", "categories"]
    whole = F.to_json(F.struct(*record))
    undated = F.to_json(F.struct(*[name for name in record if name != "published"]))
    value = (
        F.when(F.col("doc_id") % 17 == 0, "broken{")
        .when(F.col("doc_id") % 19 == 0, undated)
        .otherwise(whole)
    )
    return papers(spark, sf_dir).select(
        value.alias("value"),
        F.concat(F.lit("arxiv_2024010"), (F.col("topic") + 1).cast("string"),
                 F.lit("T000000.jsonl")).alias("s3_key"),
        F.col("doc_id").alias("line"),
    )


def paper_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Atom ``<entry>`` element per record."""

    def escaped(name: str) -> F.Column:
        text = F.col(name)
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(sign), F.lit(entity))
        return text

    def element(name: str, inner: F.Column) -> F.Column:
        return F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))

    authors = F.array_join(
        F.transform("authors", lambda a: element("author", element("name", a))), ""
    )
    categories = F.array_join(
        F.transform("categories", lambda c: F.concat(F.lit('<category term="'), c, F.lit('"/>'))), ""
    )
    entry = F.concat(
        F.lit('<entry xmlns="http://www.w3.org/2005/Atom">'),
        element("id", F.col("id")),
        element("title", escaped("title")),
        element("summary", escaped("summary")),
        element("published", F.col("published")),
        authors,
        categories,
        F.lit("</entry>"),
    )
    return papers(spark, sf_dir).select("doc_id", "topic", entry.alias("entry"))


CTE_PAPERS = f"""paper_first AS (SELECT
  {_duck(PAPERS)}
FROM documents),
papers_f AS (
  SELECT * FROM paper_first
  UNION ALL
  SELECT * REPLACE (title || 'v2' AS title, CAST((doc_id + 1) % 6 AS INT) AS topic)
  FROM paper_first WHERE doc_id % 5 = 0),
lines_f AS (SELECT *, 'arxiv_2024010' || CAST(topic + 1 AS STRING) || 'T000000.jsonl' AS s3_key,
  CASE WHEN doc_id % 17 = 0 THEN 'broken json' WHEN doc_id % 19 = 0 THEN 'missing field' END
  AS problem FROM papers_f)"""
