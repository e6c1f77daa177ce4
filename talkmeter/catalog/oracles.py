"""The same results in DuckDB SQL, one statement per registered query.

Only the fixture CTEs are shared with the Spark side. Signals are computed one
by one from separate filtered aggregates, so they also prove the one-pass plan.
"""

from __future__ import annotations

from talkmeter import vocabulary as V
from talkmeter.catalog import fixtures as X

MARK = "TIMESTAMP '1998-06-15 00:00:00'"
LOADED_AT = "TIMESTAMP '2026-01-01 00:00:00'"
ERA = "TIMESTAMP '1998-01-01 00:00:00'"
TYPES = "('generation', 'modification', 'diagnostic', 'consultation')"
SUCCESS = "('success_clean', 'success_with_correction', 'success_iterative')"
TIER = (
    f"CASE WHEN outcome IN {SUCCESS} THEN 'success' "
    "WHEN outcome = 'inconclusive' THEN 'inconclusive' ELSE 'failure' END"
)
GATE = (
    f"CASE WHEN outcome IN {SUCCESS} THEN 'allow' "
    "WHEN outcome = 'failure_wrong_direction' THEN 'block_review' ELSE 'block' END"
)

MONEY = "total_cost_usd::DOUBLE AS total_cost_usd"

# --- per-message conditions --------------------------------------------------------

PREFETCH = "message_type = 'tool_call' AND content ILIKE '%schema_prefetch_tool%'"
WRITES = (
    "message_type = 'tool_call' AND content ILIKE '%Write(file_path=%' "
    "AND NOT content ILIKE '%TodoWrite%'"
)
SQL_WRITE = f"{WRITES} AND content ILIKE '%/sql/%'"
OTHER_WRITE = f"{WRITES} AND NOT content ILIKE '%/sql/%'"
EXECUTION = (
    "message_type IN ('tool_call', 'tool_result') AND (content ILIKE '%execute_sql%' "
    "OR content ILIKE '%OperationalError%' OR content ILIKE '%preview%')"
)
RESULT = "message_type = 'tool_result'"
REVIEW = f"{RESULT} AND content ILIKE '%Quality Score%'"
CORRECTION = "message_type = 'user' AND (" + " OR ".join(
    f"content ILIKE '{phrase}'" for phrase in V.CORRECTION_PHRASES
) + ")"
SCORE = "TRY_CAST(nullif(regexp_extract(content, 'Quality Score[^0-9]*([0-9]+)', 1), '') AS INT)"


def n(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def first_at(condition: str) -> str:
    return f"min(sequence_number) FILTER (WHERE {condition})"


# One CTE per signal, each over its own filtered rows.
SIGNAL_CTES = {
    "prefetch": (PREFETCH, "count(*) AS prefetch_call_count, "
                 "min(sequence_number) AS first_prefetch_sequence"),
    "sql_writes": (SQL_WRITE, "count(*) AS sql_write_count, "
                   "min(sequence_number) AS first_write_sequence"),
    "other_writes": (OTHER_WRITE, "count(*) AS non_sql_write_count"),
    "executions": (EXECUTION, "count(*) AS execute_sql_count"),
    "previews": (f"{RESULT} AND content ILIKE '%preview%'",
                 "count(*) AS execute_sql_success_count"),
    "db_errors": (f"{RESULT} AND content ILIKE '%OperationalError%'",
                  "count(*) AS permission_error_count"),
    "corrections": (CORRECTION, "count(*) AS user_correction_count"),
    "stale": ("content ILIKE '%Documentation sync last performed%'",
              "count(*) AS stale_doc_warning_count"),
    "tool_errors": (f"{RESULT} AND content ILIKE '%tool_use_error%'",
                    "count(*) AS tool_use_error_count"),
    "code_errors": (f"{RESULT} AND (content ILIKE '%ImportError%' "
                    "OR content ILIKE '%ModuleNotFoundError%')",
                    "count(*) AS codebase_error_count"),
    "user_rows": ("message_type = 'user'", "count(*) AS total_user_messages"),
    "rejections": (f"{RESULT} AND content ILIKE '%tool use was rejected%'",
                   "count(*) AS user_rejected_tool_count"),
}
REVIEWS = f"""reviews AS (
  SELECT conversation_id, count(*) AS code_review_count,
    max(score) FILTER (WHERE up = 1) AS code_review_score_first,
    max(score) FILTER (WHERE down = 1) AS code_review_score_last
  FROM (SELECT conversation_id, {SCORE} AS score,
      row_number() OVER (PARTITION BY conversation_id
        ORDER BY sequence_number ASC NULLS LAST, {SCORE} ASC NULLS FIRST) AS up,
      row_number() OVER (PARTITION BY conversation_id
        ORDER BY sequence_number DESC NULLS FIRST, {SCORE} DESC NULLS LAST) AS down
    FROM messages_a WHERE {REVIEW})
  GROUP BY conversation_id)"""
COSTS = """costs AS (
  SELECT conversation_id, sum(cost_usd)::DECIMAL(20,4) AS total_cost_usd,
    count(*) AS run_count, avg(duration_ms) AS avg_run_duration_ms
  FROM runs_a GROUP BY conversation_id)"""

SIGNALS = (
    f"{X.CTE_CONVERSATIONS},\n{X.CTE_MESSAGES},\n{X.CTE_RUNS},\n"
    + ",\n".join(
        f"{name} AS (SELECT conversation_id, {outputs} FROM messages_a WHERE {condition} "
        "GROUP BY conversation_id)"
        for name, (condition, outputs) in SIGNAL_CTES.items()
    )
    + f",\n{REVIEWS},\n{COSTS},\n"
    + """signals AS (
  SELECT c.id AS conversation_id, c.total_turns, c.total_duration_ms,
    c.learning_extracted_at IS NOT NULL AS learning_extracted,
    c.created_at AS conversation_created_at,
    CASE WHEN c.created_at < """ + ERA + """ THEN 'pre_prefetch' ELSE 'post_prefetch' END
      AS corpus_era,
    """
    + ",\n    ".join(
        f"coalesce({'costs.' * (column == 'total_cost_usd')}{column}, 0) AS {column}"
        for column in [
            "total_user_messages", "prefetch_call_count", "sql_write_count",
            "non_sql_write_count", "execute_sql_count", "execute_sql_success_count",
            "permission_error_count", "code_review_count", "user_correction_count",
            "stale_doc_warning_count", "tool_use_error_count", "codebase_error_count",
            "user_rejected_tool_count", "total_cost_usd", "run_count", "avg_run_duration_ms",
        ]
    )
    + """,
    first_prefetch_sequence, first_write_sequence,
    first_write_sequence - first_prefetch_sequence AS prefetch_to_write_gap,
    code_review_score_first, code_review_score_last,
    code_review_score_last - code_review_score_first AS code_review_score_delta
  FROM conversations_a c
  """
    + "\n  ".join(
        f"LEFT JOIN {name} ON {name}.conversation_id = c.id"
        for name in [*SIGNAL_CTES, "reviews", "costs"]
    )
    + ")"
)

TYPED = SIGNALS + """,
typed AS (
  SELECT *, total_turns = 0 AS is_ghost, total_turns > 75 AS is_anomalous,
    corpus_era = 'pre_prefetch' AND prefetch_call_count + sql_write_count + non_sql_write_count = 0
      AND total_turns > 0 AS is_unknown,
    corpus_era = 'post_prefetch' AND prefetch_call_count > 0 AS has_generation_signal,
    sql_write_count > 0 AS has_sql_write, non_sql_write_count > 0 AS has_non_sql_write,
    execute_sql_count > 0 AS has_execute_sql, user_rejected_tool_count > 0 AS has_user_interrupt,
    CASE WHEN is_ghost THEN 'ghost' WHEN is_anomalous THEN 'anomalous'
      WHEN is_unknown THEN 'unknown'
      WHEN has_sql_write AND has_generation_signal THEN 'generation'
      WHEN has_sql_write THEN 'modification' WHEN has_non_sql_write THEN 'diagnostic'
      ELSE 'consultation' END AS conversation_type
  FROM signals)"""

LATEST = X.CTE_LEDGER + """,
latest AS (
  SELECT * RENAME (conversation_type AS classified_as_type, model AS model_version) FROM ledger_c
  QUALIFY row_number() OVER (PARTITION BY conversation_id
    ORDER BY classified_at DESC NULLS FIRST, reasoning) = 1)"""

MASKED = [*V.RUBRIC, "flag_dev_acknowledged", "reasoning"]


def mask(column: str, keep_unjudged: bool = False) -> str:
    hide = "outcome = 'inconclusive'" if keep_unjudged else "coalesce(outcome, 'inconclusive') = 'inconclusive'"
    return f"CASE WHEN {hide} THEN NULL ELSE {column} END AS {column}"


FACT_COLUMNS = """t.conversation_id, conversation_type, outcome IS NOT NULL AS is_classified,
    outcome, classified_as_type, classified_at, prompt_version, model_version, prompt_hash,
    """ + ", ".join(mask(c) for c in MASKED) + """, char_count, total_turns, total_user_messages,
    run_count, total_cost_usd, total_duration_ms, avg_run_duration_ms, corpus_era,
    conversation_created_at, prefetch_call_count, first_prefetch_sequence, sql_write_count,
    non_sql_write_count, first_write_sequence, prefetch_to_write_gap, execute_sql_count,
    execute_sql_success_count, permission_error_count, code_review_count,
    code_review_score_first, code_review_score_last, code_review_score_delta,
    user_correction_count, user_rejected_tool_count, stale_doc_warning_count,
    tool_use_error_count, codebase_error_count, has_generation_signal, has_sql_write,
    has_non_sql_write, has_non_sql_write AS has_non_sql_deliverable, has_execute_sql,
    has_user_interrupt, learning_extracted"""
FACT = f"""{TYPED},
{LATEST},
fact AS (SELECT {FACT_COLUMNS}
  FROM typed t LEFT JOIN latest l ON l.conversation_id = t.conversation_id
  WHERE conversation_type IN {TYPES}),
classified AS (SELECT *, {TIER} AS outcome_tier, {GATE} AS gate_decision
  FROM fact WHERE is_classified)"""

RUBRIC_TRIPLES = ", ".join(
    f"expected_{d}, actual_{d}, {d}_abs_error" for d in V.RUBRIC
)


def validation_fact(run_count: int = X.RUN_COUNT) -> str:
    return X.cte_validation(run_count) + f""",
vfact AS (
  SELECT md5(validation_run_id || '-' || CAST(conversation_id AS VARCHAR)) AS validation_case_key,
    validation_run_id, run_at, conversation_id, label_cohort, is_blind, prompt_version,
    model AS model_version, prompt_hash, expected_outcome, actual_outcome, outcome_passed,
    error IS NULL AS is_scored, error IS NOT NULL AS is_error, error, {RUBRIC_TRIPLES}, char_count
  FROM validation_d
  QUALIFY row_number() OVER (PARTITION BY validation_run_id, conversation_id
    ORDER BY run_at DESC NULLS FIRST) = 1)"""


AGREEMENT = ", ".join(
    f"avg(CAST({d}_abs_error = 0 AS INT)) FILTER (WHERE is_scored AND {d}_abs_error IS NOT NULL) "
    f"AS {d}_match_rate, avg({d}_abs_error) AS {d}_mae"
    for d in V.RUBRIC
)
RUN_KEYS = "validation_run_id, prompt_version, model_version, prompt_hash"
ROLLUP = f"""{RUN_KEYS}, min(run_at) AS run_at,
    {n('NOT is_blind AND is_scored')} AS n_cases,
    {n('NOT is_blind AND is_scored AND outcome_passed')} AS n_passed,
    {n('is_error')} AS error_count,
    {n('is_blind AND is_scored')} AS n_blind_cases,
    {n('is_blind AND is_scored AND outcome_passed')} AS n_blind_passed"""


def drift_fact(run_count: int = X.RUN_COUNT) -> str:
    measures = ", ".join(f"{d}_match_rate, {d}_mae" for d in V.RUBRIC)
    return validation_fact(run_count) + f""",
rollup_runs AS (SELECT {ROLLUP}, {AGREEMENT} FROM vfact GROUP BY {RUN_KEYS}),
rated AS (SELECT *, n_passed::DOUBLE / nullif(n_cases, 0) AS outcome_agreement_rate,
    n_blind_passed::DOUBLE / nullif(n_blind_cases, 0) AS blind_agreement_rate FROM rollup_runs),
based AS (SELECT *, first_value(outcome_agreement_rate) OVER (PARTITION BY prompt_version
    ORDER BY run_at ASC NULLS LAST, validation_run_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS baseline_agreement_rate
  FROM rated),
drift AS (SELECT {RUN_KEYS}, run_at, n_cases, n_passed, error_count, n_blind_cases,
    n_blind_passed, outcome_agreement_rate, blind_agreement_rate, baseline_agreement_rate,
    outcome_agreement_rate - baseline_agreement_rate AS agreement_delta_vs_baseline,
    CASE WHEN agreement_delta_vs_baseline IS NULL THEN 'unknown'
      WHEN abs(agreement_delta_vs_baseline) < 0.10 THEN 'stable'
      WHEN abs(agreement_delta_vs_baseline) < 0.25 THEN 'moderate'
      ELSE 'significant' END AS drift_band, {measures}
  FROM based),
newest_runs AS (SELECT prompt_version, run_at, outcome_agreement_rate, baseline_agreement_rate,
    agreement_delta_vs_baseline FROM drift
  QUALIFY row_number() OVER (PARTITION BY prompt_version
    ORDER BY run_at DESC, validation_run_id DESC) = 1)"""


# --- transcripts -------------------------------------------------------------------------


def cut(limits: dict[str, int]) -> str:
    arms = " ".join(
        f"WHEN message_type = '{kind}' AND length(content) > {limit} "
        f"THEN left(content, {limit}) || '... [truncated]'"
        for kind, limit in limits.items()
    )
    return f"CASE {arms} ELSE coalesce(content, '') END"


def line(limits: dict[str, int]) -> str:
    return f"'[' || message_type || '] ' || {cut(limits)}"


def parts(cte: str, source: str, limits: dict[str, int], block: int, part_chars: int) -> str:
    return f"""WITH {cte}, lined AS (
  SELECT conversation_id, CAST(floor(sequence_number / {block}) AS BIGINT) AS part,
    sequence_number, id, {line(limits)} AS line FROM {source}),
placed AS (SELECT *, CAST(floor((sum(length(line) + 2) OVER (PARTITION BY conversation_id, part
    ORDER BY sequence_number, id, line ROWS UNBOUNDED PRECEDING) - length(line) - 2)
    / {part_chars}) AS BIGINT) AS piece FROM lined)
SELECT conversation_id, part, piece, count(*) AS messages, string_agg(line, chr(10) || chr(10)
    ORDER BY sequence_number, id) AS text, length(text) AS part_chars
FROM placed GROUP BY 1, 2, 3"""


def capped(cte: str, source: str, limits: dict[str, int], cap: int, head: int, tail: int) -> str:
    return f"""WITH {cte}, whole AS (
  SELECT conversation_id, string_agg({line(limits)}, chr(10) || chr(10)
    ORDER BY sequence_number, id) AS text FROM {source} GROUP BY 1)
SELECT conversation_id, length(text) AS char_count,
  CASE WHEN length(text) <= {cap} THEN text ELSE left(text, {head}) || chr(10) || chr(10)
    || '... [' || CAST(length(text) - {head} - {tail} AS VARCHAR) || ' chars truncated] ...'
    || chr(10) || chr(10) || right(text, {tail}) END AS transcript
FROM whole"""


# --- judge -----------------------------------------------------------------------------------

QUEUE = f"""{TYPED},
{X.CTE_LEDGER},
waiting AS (SELECT conversation_id, conversation_type FROM typed t
  WHERE NOT EXISTS (SELECT 1 FROM ledger_c l WHERE l.conversation_id = t.conversation_id
    AND l.prompt_version = '{X.NEW_VERSION}' AND l.error IS NULL))"""

JUDGED = f"""{QUEUE},
texts AS (SELECT conversation_id, length(string_agg({line(V.CONSULTATION_LIMITS)},
    chr(10) || chr(10) ORDER BY sequence_number, id)) AS size
  FROM messages_a GROUP BY 1),
work AS (SELECT w.conversation_id, conversation_type, coalesce(size, 0) AS char_count
  FROM waiting w LEFT JOIN texts x ON x.conversation_id = w.conversation_id
  WHERE conversation_type = 'consultation'),
judged AS (SELECT *,
    CASE WHEN char_count % 7 = 0 THEN 'ValueError: cannot judge'
      WHEN char_count % 11 = 0 THEN 'TimeoutError: too slow' END AS error,
    CASE WHEN error IS NULL THEN CASE char_count % 3 WHEN 0 THEN 'success_clean'
      WHEN 1 THEN 'failure_abandoned' ELSE 'inconclusive' END END AS outcome,
    """ + ", ".join(
    f"CASE WHEN error IS NULL THEN CAST((char_count + {i}) % 3 + 1 AS INT) END AS {d}"
    for i, d in enumerate(V.RUBRIC)
) + """,
    CASE WHEN error IS NULL THEN conversation_type || ' of ' || CAST(char_count AS VARCHAR)
      || ' characters' END AS reasoning
  FROM work)"""
LEDGER_COLUMNS = "conversation_id, conversation_type, outcome, " + ", ".join(V.RUBRIC) + \
    ", flag_dev_acknowledged, reasoning, char_count, error, prompt_version, model, prompt_hash, " \
    "classified_at"

# --- papers --------------------------------------------------------------------------------------

LISTS = """'["' || source || '","' || lang || '"]' AS authors, '["' || lang || '"]' AS categories"""
RECORD = f"id, title, summary, published, {LISTS}"
PAPER = f"""CAST(doc_id AS VARCHAR) AS paper_id, id AS arxiv_url, title, summary AS abstract, {LISTS},
  CAST(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 365 AS INT)) AS TIMESTAMP)
    AS published_date, s3_key"""
TRIMMED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g') AS {0}"
UPSERTED = f"""WITH {X.CTE_PAPERS}
SELECT {PAPER}, {LOADED_AT} AS ingested_at FROM lines_f WHERE problem IS NULL
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s3_key DESC) = 1"""

# --- telemetry ---------------------------------------------------------------------------------------


def buckets(source: str, groups: str, value: str, bounds: list[float], digits: int | None) -> str:
    total = f"sum({value})::DOUBLE"
    total = total if digits is None else f"round({total}, {digits})"
    arms = " UNION ALL ".join(
        [
            f"SELECT {groups}, '{b:g}' AS le, {n(f'{value} <= {b}')} AS cumulative_count, "
            f"{total} AS value_sum, count({value}) AS value_count FROM {source} "
            f"WHERE {value} IS NOT NULL GROUP BY {groups}"
            for b in bounds
        ]
        + [
            f"SELECT {groups}, '+Inf' AS le, count({value}) AS cumulative_count, "
            f"{total} AS value_sum, count({value}) AS value_count FROM {source} "
            f"WHERE {value} IS NOT NULL GROUP BY {groups}"
        ]
    )
    return arms


LONG_SCORES = "scores AS (" + " UNION ALL ".join(
    f"SELECT ts, conversation_type, '{d}' AS dimension, {d} AS score FROM judge_e "
    f"WHERE {d} IS NOT NULL" for d in V.RUBRIC
) + ")"


def quantile(q: float) -> str:
    """Walk the bucket table: first bucket whose cumulative count reaches the rank."""
    edges = [0, *V.LATENCY_BUCKETS]
    arms = []
    for low, high in zip(edges, edges[1:]):
        below = f"count(*) FILTER (WHERE latency_s <= {low})" if low else "0"
        upto = f"count(*) FILTER (WHERE latency_s <= {high})"
        arms.append(
            f"WHEN {upto} >= count(*) * {q} THEN {low} + ({high} - {low}) * "
            f"(count(*) * {q} - {below})::DOUBLE / nullif({upto} - {below}, 0)"
        )
    return f"round(CASE {' '.join(arms)} ELSE {edges[-1]} END::DOUBLE, 6)"


COUNTERS = f"""WITH {X.CTE_JUDGE_EVENTS}
SELECT 'outcomes' AS metric, conversation_type AS label_1, outcome AS label_2,
  count(*)::BIGINT AS value FROM judge_e WHERE error_type IS NULL GROUP BY 2, 3
UNION ALL SELECT 'errors', conversation_type, error_type, count(*) FROM judge_e
  WHERE error_type IS NOT NULL GROUP BY 2, 3
UNION ALL SELECT 'retries', conversation_type, NULL, sum(retry_count)::BIGINT FROM judge_e
  WHERE retry_count > 0 GROUP BY 2
UNION ALL SELECT 'dev_acknowledged', outcome, NULL, count(*) FROM judge_e
  WHERE flag_dev_acknowledged AND error_type IS NULL GROUP BY 2"""
ERROR_RATE = f"""WITH {X.CTE_JUDGE_EVENTS}
SELECT time_bucket(INTERVAL '5 minutes', ts, TIMESTAMP '1970-01-01') AS window_start,
  conversation_type, error_type, count(*) AS errors, round(count(*) / 300.0::DOUBLE, 6) AS errors_per_second
FROM judge_e WHERE error_type IS NOT NULL GROUP BY 1, 2, 3"""

PERIOD_AUTO = """CASE WHEN (SELECT date_diff('second', min(conversation_created_at),
    max(conversation_created_at)) // 86400 FROM classified) < 120
  THEN date_trunc('month', conversation_created_at)
  ELSE date_trunc('week', conversation_created_at) END::TIMESTAMP"""
MONTH = "date_trunc('month', conversation_created_at)::TIMESTAMP"
WEEK = "date_trunc('week', conversation_created_at)::TIMESTAMP"


def mix(period: str) -> str:
    return f"""WITH {FACT}
SELECT *, count / total AS share FROM (
  SELECT {period} AS period, outcome_tier, count(*) AS count,
    sum(count(*)) OVER (PARTITION BY {period})::BIGINT AS total
  FROM classified GROUP BY 1, 2)"""


MEAN_COST = "sum(total_cost_usd)::DOUBLE / count(total_cost_usd)"
COST_LIMIT = f"(SELECT {MEAN_COST} + 2 * stddev_samp(total_cost_usd::DOUBLE) FROM classified)"
EXPLORER = "conversation_id, conversation_type, outcome, gate_decision, reasoning, char_count, " \
    "total_cost_usd::DOUBLE AS total_cost_usd, " + ", ".join(V.RUBRIC)
EXPLORED = "('7', '12', '140', 'nope', '99999999')"

MESSAGE_GROUP = f"WITH {X.CTE_MESSAGES} SELECT conversation_id, {{0}} FROM messages_a GROUP BY 1"

MESSAGE_SIGNALS = f"""{X.CTE_MESSAGES}, {REVIEWS}, counted AS (
  SELECT conversation_id, {n("message_type = 'user'")} AS total_user_messages,
    {n(PREFETCH)} AS prefetch_call_count, {first_at(PREFETCH)} AS first_prefetch_sequence,
    {n(SQL_WRITE)} AS sql_write_count, {n(OTHER_WRITE)} AS non_sql_write_count,
    {first_at(SQL_WRITE)} AS first_write_sequence, {n(EXECUTION)} AS execute_sql_count,
    {n(RESULT + " AND content ILIKE '%preview%'")} AS execute_sql_success_count,
    {n(RESULT + " AND content ILIKE '%OperationalError%'")} AS permission_error_count,
    {n(CORRECTION)} AS user_correction_count,
    {n("content ILIKE '%Documentation sync last performed%'")} AS stale_doc_warning_count,
    {n(RESULT + " AND content ILIKE '%tool_use_error%'")} AS tool_use_error_count,
    {n(RESULT + " AND (content ILIKE '%ImportError%' OR content ILIKE '%ModuleNotFoundError%')")}
      AS codebase_error_count,
    {n(RESULT + " AND content ILIKE '%tool use was rejected%'")} AS user_rejected_tool_count
  FROM messages_a GROUP BY 1)"""

ORACLES: dict[str, str] = {
    # sources and sinks
    "extract_parent_incremental": f"WITH {X.CTE_CONVERSATIONS} SELECT * REPLACE "
    f"(total_cost_usd::DOUBLE AS total_cost_usd) FROM conversations_a WHERE updated_at > {MARK}",
    "watermark_advance": f"WITH {X.CTE_CONVERSATIONS} SELECT greatest(max(updated_at), {MARK}) "
    "AS mark FROM conversations_a",
    "extract_runs_incremental": f"WITH {X.CTE_CONVERSATIONS}, {X.CTE_RUNS} SELECT r.* REPLACE "
    "(r.cost_usd::DOUBLE AS cost_usd) FROM runs_a r JOIN conversations_a c "
    f"ON r.conversation_id = c.id WHERE c.updated_at > {MARK}",
    "extract_messages_incremental": f"WITH {X.CTE_CONVERSATIONS}, {X.CTE_MESSAGES} SELECT m.* "
    "FROM messages_a m JOIN conversations_a c ON m.conversation_id = c.id "
    f"WHERE c.updated_at > {MARK} AND message_type IN ('user', 'tool_call', 'tool_result', 'thinking')",
    "land_raw_strings": f"WITH {X.CTE_MESSAGES} SELECT CAST(COLUMNS(*) AS VARCHAR) FROM messages_a",
    "new_files_after_marker": f"WITH {X.CTE_PAPERS} SELECT DISTINCT s3_key FROM lines_f "
    "WHERE s3_key > 'arxiv_20240102T000000.jsonl'",
    "papers_parse_jsonl": f"WITH {X.CTE_PAPERS} SELECT {PAPER}, {LOADED_AT} AS ingested_at, "
    "doc_id AS line FROM lines_f WHERE problem IS NULL",
    "paper_id_from_url": f"WITH {X.CTE_PAPERS} SELECT id, topic, "
    "split_part(rtrim(id, '/'), '/', 5) AS paper_id FROM papers_f",
    "papers_upsert": UPSERTED,
    "stream_papers": UPSERTED,
    "file_marker_advance": f"WITH {X.CTE_PAPERS} SELECT max(s3_key) AS marker FROM lines_f",
    "load_run_summary": f"WITH {X.CTE_PAPERS} SELECT {LOADED_AT} AS run_at, "
    "count(DISTINCT s3_key) AS files_processed, count(*) FILTER (WHERE problem IS NULL) "
    "AS rows_loaded, count(*) FILTER (WHERE problem = 'broken json') AS broken_json, "
    "count(*) FILTER (WHERE problem = 'missing field') AS missing_field, 0::BIGINT AS bad_date "
    "FROM lines_f",
    "load_file_summary": f"WITH {X.CTE_PAPERS} SELECT s3_key, count(*) FILTER (WHERE problem IS NULL) "
    "AS rows_loaded, count(*) FILTER (WHERE problem = 'broken json') AS broken_json, "
    "count(*) FILTER (WHERE problem = 'missing field') AS missing_field, 0::BIGINT AS bad_date "
    "FROM lines_f GROUP BY 1",
    "papers_parse_xml": f"WITH {X.CTE_PAPERS} SELECT doc_id, topic, id, {TRIMMED.format('title')}, "
    f"{TRIMMED.format('summary')}, published, {LISTS} FROM papers_f",
    "papers_union_topics": f"WITH {X.CTE_PAPERS} SELECT doc_id, id, title, summary, published, "
    "topic FROM papers_f",
    "papers_keep_first": f"WITH {X.CTE_PAPERS} SELECT doc_id, id, title, summary, published, "
    "topic FROM papers_f QUALIFY row_number() OVER (PARTITION BY id ORDER BY topic, doc_id) = 1",
    "sink_jsonl": f"WITH {X.CTE_PAPERS} SELECT {RECORD} FROM papers_f",
    "seed_labels": f"WITH {X.CTE_LABELS} SELECT * EXCLUDE (base_score), 'expert' AS labeler, "
    "DATE '2026-06-17' AS labeled_at, 'easy' AS difficulty FROM labels_d",
    "ledger_schema_evolve": f"WITH {X.CTE_LEDGER} SELECT * REPLACE ("
    + ", ".join(
        f"CASE WHEN conversation_type <> 'consultation' THEN {c} END AS {c}"
        for c in ("flag_dev_acknowledged", "prompt_version", "model", "prompt_hash")
    ) + ") FROM ledger_c",
    "load_classified": f"WITH {FACT} SELECT * EXCLUDE (outcome_tier, gate_decision) "
    f"REPLACE ({MONEY}) FROM classified",
    # staging
    "stg_conversations": f"WITH {X.CTE_CONVERSATIONS} SELECT * REPLACE "
    "(total_cost_usd::DOUBLE AS total_cost_usd) FROM conversations_a",
    "stg_runs": f"WITH {X.CTE_RUNS} SELECT * REPLACE (cost_usd::DOUBLE AS cost_usd) FROM runs_a",
    "stg_messages": f"WITH {X.CTE_MESSAGES} SELECT * FROM messages_a",
    "stg_papers": f"WITH {X.CTE_PAPERS} SELECT * EXCLUDE (s3_key), {LOADED_AT} AS ingested_date "
    f"FROM (SELECT {PAPER} FROM lines_f WHERE problem IS NULL)",
    "corpus_era": f"SELECT o_orderkey AS id, CASE WHEN o_orderdate < {ERA} THEN 'pre_prefetch' "
    "ELSE 'post_prefetch' END AS corpus_era FROM orders",
    "prefetch_to_write_gap": f"WITH {SIGNALS} SELECT conversation_id, first_prefetch_sequence, "
    "first_write_sequence, prefetch_to_write_gap FROM signals",
    "conversation_type_flags": f"WITH {TYPED} SELECT conversation_id, corpus_era, is_ghost, "
    "is_anomalous, is_unknown, has_generation_signal, has_sql_write, has_non_sql_write, "
    "has_execute_sql, has_user_interrupt FROM typed",
    "conversation_type": f"WITH {TYPED} SELECT conversation_id, conversation_type FROM typed",
    "outcomes_masked": f"WITH {LATEST} SELECT conversation_id, outcome, "
    + ", ".join(mask(c) for c in MASKED) + ", char_count FROM latest",
    "surrogate_keys": f"WITH {X.cte_validation()} SELECT validation_run_id, conversation_id, "
    "md5(validation_run_id || '-' || CAST(conversation_id AS VARCHAR)) AS key FROM validation_d",
    "drift_band": f"WITH {drift_fact()} SELECT validation_run_id, drift_band FROM drift",
    "outcome_tier": f"WITH {X.CTE_LEDGER} SELECT reasoning, outcome, {TIER} AS outcome_tier FROM ledger_c",
    "gate_decision": f"WITH {X.CTE_LEDGER} SELECT reasoning, outcome, {GATE} AS gate_decision FROM ledger_c",
    "judge_fingerprint": "SELECT doc_id, left(sha256(source || chr(10) || text), 8) AS prompt_hash, "
    "'consultation_' || left(sha256(source || chr(10) || text), 8) AS prompt_version FROM documents",
    # filters
    "classifiable_corpus": f"WITH {TYPED} SELECT conversation_id, conversation_type, "
    "has_generation_signal, has_sql_write, has_non_sql_write, has_execute_sql, has_user_interrupt "
    f"FROM typed WHERE conversation_type IN {TYPES}",
    "review_queue": f"WITH {FACT} SELECT conversation_id, conversation_type, reasoning "
    "FROM classified WHERE outcome = 'failure_wrong_direction'",
    "latest_run_cases": f"WITH {validation_fact()} SELECT conversation_id, is_blind, "
    "expected_outcome, actual_outcome, outcome_passed, is_error FROM vfact "
    "WHERE run_at = (SELECT max(run_at) FROM vfact)",
    "explorer_filter": f"WITH {FACT} SELECT {EXPLORER} FROM classified WHERE outcome IN "
    "('success_clean', 'inconclusive', 'failure_schema_gap') AND conversation_type <> 'diagnostic'",
    "explorer_search": f"WITH {FACT} SELECT {EXPLORER} FROM classified "
    f"WHERE CAST(conversation_id AS VARCHAR) IN {EXPLORED}",
    "explorer_unmatched_ids": f"WITH {FACT} SELECT unnest(['7', '12', '140', 'nope', '99999999']) "
    "AS conversation_id EXCEPT SELECT CAST(conversation_id AS VARCHAR) FROM classified",
    "cost_outliers": f"WITH {FACT} SELECT conversation_id, conversation_type, outcome, "
    f"{MONEY}, run_count FROM classified WHERE total_cost_usd::DOUBLE > {COST_LIMIT}",
    # signals
    "schema_prefetch_signals": MESSAGE_GROUP.format(
        f"{n(PREFETCH)} AS prefetch_call_count, {first_at(PREFETCH)} AS first_prefetch_sequence"),
    "file_write_counts": MESSAGE_GROUP.format(
        f"{n(SQL_WRITE)} AS sql_write_count, {n(OTHER_WRITE)} AS non_sql_write_count, "
        f"{first_at(SQL_WRITE)} AS first_write_sequence"),
    "execute_sql_signals": MESSAGE_GROUP.format(
        f"{n(EXECUTION)} AS execute_sql_count, "
        + n(RESULT + " AND content ILIKE '%preview%'") + " AS execute_sql_success_count, "
        + n(RESULT + " AND content ILIKE '%OperationalError%'") + " AS permission_error_count"),
    "user_corrections": MESSAGE_GROUP.format(f"{n(CORRECTION)} AS user_correction_count"),
    "stale_doc_warnings": MESSAGE_GROUP.format(
        n("content ILIKE '%Documentation sync last performed%'") + " AS stale_doc_warning_count"),
    "tool_error_signals": MESSAGE_GROUP.format(
        n(RESULT + " AND content ILIKE '%tool_use_error%'") + " AS tool_use_error_count, "
        + n(RESULT + " AND (content ILIKE '%ImportError%' OR content ILIKE '%ModuleNotFoundError%')")
        + " AS codebase_error_count"),
    "user_message_count": MESSAGE_GROUP.format(
        n("message_type = 'user'") + " AS total_user_messages"),
    "user_rejected_tools": MESSAGE_GROUP.format(
        n(RESULT + " AND content ILIKE '%tool use was rejected%'") + " AS user_rejected_tool_count"),
    "code_review_trajectory": f"WITH {X.CTE_MESSAGES}, {REVIEWS} SELECT m.conversation_id, "
    "coalesce(any_value(code_review_count), 0) AS code_review_count, "
    "any_value(code_review_score_first) AS code_review_score_first, "
    "any_value(code_review_score_last) AS code_review_score_last, "
    "any_value(code_review_score_last - code_review_score_first) AS code_review_score_delta "
    "FROM messages_a m LEFT JOIN reviews r ON r.conversation_id = m.conversation_id GROUP BY 1",
    "review_score_extract": f"WITH {X.CTE_MESSAGES} SELECT id, {SCORE} AS score FROM messages_a "
    f"WHERE {REVIEW}",
    "run_cost_signals": f"WITH {X.CTE_RUNS}, {COSTS} SELECT * REPLACE ({MONEY}) FROM costs",
    "conversation_signals": f"WITH {SIGNALS} SELECT * REPLACE ({MONEY}) FROM signals",
    "conversation_signals_raw": f"WITH {SIGNALS} SELECT * REPLACE ({MONEY}) FROM signals",
    "stream_signals": f"WITH {MESSAGE_SIGNALS} SELECT c.*, "
    "coalesce(code_review_count, 0) AS code_review_count, code_review_score_first, "
    "code_review_score_last, code_review_score_last - code_review_score_first "
    "AS code_review_score_delta, first_write_sequence - first_prefetch_sequence "
    "AS prefetch_to_write_gap FROM counted c LEFT JOIN reviews r USING (conversation_id)",
    # aggregations
    "corpus_census": f"WITH {TYPED} SELECT conversation_type, count(*) AS conversations, "
    f"conversation_type IN {TYPES} AS is_classifiable FROM typed GROUP BY 1",
    "outcome_distribution": f"WITH {X.CTE_LEDGER} SELECT conversation_type, "
    "coalesce(outcome, 'error') AS outcome, count(*) AS count FROM ledger_c GROUP BY ALL",
    "dim_judge_version": f"WITH {X.CTE_LEDGER} SELECT prompt_version, model AS model_version, "
    "prompt_hash, min(conversation_type) AS first_conversation_type, "
    "count(DISTINCT conversation_type) AS distinct_conversation_types, "
    "min(classified_at) AS first_classified_at, max(classified_at) AS last_classified_at, "
    "count(*) AS total_classifications, count(DISTINCT conversation_id) AS distinct_conversations, "
    "count(error) AS error_count FROM ledger_c WHERE prompt_version IS NOT NULL GROUP BY ALL",
    "validation_run_rollup": f"WITH {validation_fact()} SELECT {ROLLUP} FROM vfact GROUP BY {RUN_KEYS}",
    "rubric_agreement": f"WITH {validation_fact()} SELECT {RUN_KEYS}, {AGREEMENT} FROM vfact "
    f"GROUP BY {RUN_KEYS}",
    "tier_rates": f"WITH {FACT} SELECT count(*) AS classified, "
    + ", ".join(
        f"count(*) FILTER (WHERE outcome_tier = '{t}') / count(*) AS {t}_rate" for t in V.TIERS
    ) + " FROM classified",
    "headline_agreement": f"WITH {X.cte_validation()} SELECT validation_run_id, "
    f"{n('outcome_passed')} AS passed, count(*) AS cases FROM validation_d WHERE NOT is_blind GROUP BY 1",
    "blind_cases": f"WITH {X.cte_validation()} SELECT validation_run_id, conversation_id, "
    "expected_outcome, actual_outcome, outcome_passed FROM validation_d WHERE is_blind",
    "tier_counts": f"WITH {FACT} SELECT outcome_tier AS tier, count(*) AS count FROM classified GROUP BY 1",
    "rubric_means": f"WITH {FACT} " + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, avg({d}) AS avg_score FROM classified" for d in V.RUBRIC
    ),
    "dev_ack_rate": f"WITH {FACT} SELECT avg(flag_dev_acknowledged::INT) AS ack_rate, "
    "count(*) AS conversations FROM classified WHERE conversation_type IN ('generation', 'modification')",
    "outcome_mix_by_period": mix(PERIOD_AUTO),
    "outcome_mix_by_month": mix(MONTH),
    "rubric_by_period": f"WITH {FACT} " + " UNION ALL ".join(
        f"SELECT {MONTH} AS period, count(*) AS n, '{d}' AS dimension, avg({d}) AS avg_score "
        "FROM classified GROUP BY 1" for d in V.RUBRIC
    ),
    "cost_by_period": f"WITH {FACT} SELECT {WEEK} AS period, CASE WHEN conversation_type = 'anomalous' "
    "THEN 'anomalous' ELSE 'normal' END AS bucket, sum(total_cost_usd)::DOUBLE AS sum, "
    f"{MEAN_COST} AS mean, count(total_cost_usd) AS count FROM classified GROUP BY 1, 2",
    "period_bin_sizes": f"WITH {FACT} SELECT {PERIOD_AUTO} AS period, count(*) AS n, "
    "count(*) < 5 AS is_sparse FROM classified GROUP BY 1",
    "period_granularity": f"WITH {FACT} SELECT date_diff('second', min(conversation_created_at), "
    "max(conversation_created_at)) // 86400 AS span_days, CASE WHEN span_days < 120 THEN 'monthly' "
    "ELSE 'weekly' END AS granularity FROM classified",
    "cost_outlier_stats": f"WITH {FACT} SELECT round({MEAN_COST}, 6) AS mean_cost, "
    f"round({COST_LIMIT}, 6) AS threshold, "
    f"count(*) FILTER (WHERE total_cost_usd::DOUBLE > {COST_LIMIT}) "
    "AS above_threshold FROM classified",
    "gate_counts": f"WITH {FACT} " + " UNION ALL ".join(
        f"SELECT '{g}' AS gate_decision, count(*) FILTER (WHERE gate_decision = '{g}') AS count "
        "FROM classified" for g in V.GATE_DECISIONS
    ),
    "gate_by_type": f"WITH {FACT} SELECT conversation_type, gate_decision, count(*) AS count "
    "FROM classified GROUP BY ALL",
    "validation_history_depth": f"WITH {drift_fact()} SELECT count(DISTINCT validation_run_id) AS runs, "
    "count(DISTINCT validation_run_id) < 3 AS is_sparse FROM drift",
    "classification_coverage": f"WITH {FACT} SELECT count(*) AS classifiable, count(outcome) AS classified, "
    "count(*) - count(outcome) AS backlog, count(outcome) / count(*) AS coverage FROM fact",
    # joins, windows, reshaping
    "latest_outcomes_tied": f"""WITH {X.CTE_LEDGER}
SELECT conversation_id, date_trunc('day', classified_at)::TIMESTAMP AS classified_at, reasoning, outcome
FROM ledger_c QUALIFY row_number() OVER (PARTITION BY conversation_id
  ORDER BY date_trunc('day', classified_at) DESC, reasoning DESC) = 1""",
    "latest_outcomes": f"WITH {LATEST} SELECT * FROM latest",
    "judge_queue_consultation": f"WITH {QUEUE} SELECT * FROM waiting WHERE conversation_type = 'consultation'",
    "judge_queue_sql_output": f"WITH {QUEUE} SELECT * FROM waiting "
    "WHERE conversation_type IN ('generation', 'modification')",
    "judge_queue_rotated": f"WITH {TYPED} SELECT conversation_id, conversation_type FROM typed "
    f"WHERE conversation_type IN {TYPES}",
    "judge_queue_patch": f"WITH {TYPED}, {X.CTE_LEDGER} SELECT conversation_id, conversation_type "
    "FROM typed WHERE conversation_id IN (SELECT conversation_id FROM ledger_c WHERE error IS NOT NULL)",
    "judge_validation_run": f"""WITH {X.CTE_LABELS}, results AS (
  SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'ValueError: bad json' END AS error,
    CASE doc_id % 3 WHEN 0 THEN 'success_clean' WHEN 1 THEN 'failure_knowledge_gap'
      ELSE 'inconclusive' END AS answer, length(text) AS size
  FROM documents WHERE doc_id % 9 <> 0),
pairs AS (SELECT l.*, r.answer, r.size,
    CASE WHEN r.doc_id IS NULL THEN 'no judge result' ELSE r.error END AS error
  FROM labels_d l LEFT JOIN results r ON r.doc_id = l.conversation_id)
SELECT 'run_x' AS validation_run_id, {LOADED_AT} AS run_at, conversation_id, label_cohort, is_blind,
  'consultation_test0001' AS prompt_version, 'judge-a' AS model, 'test0001' AS prompt_hash,
  expected_outcome, CASE WHEN error IS NULL THEN answer END AS actual_outcome,
  error IS NULL AND answer = expected_outcome AS outcome_passed, """ + ", ".join(
        f"expected_{d}, CASE WHEN error IS NULL THEN ((conversation_id + {i}) % 3 + 1)::INT END "
        f"AS actual_{d}, abs(expected_{d} - CASE WHEN error IS NULL THEN "
        f"((conversation_id + {i}) % 3 + 1)::INT END) AS {d}_abs_error"
        for i, d in enumerate(V.RUBRIC)
    ) + ", CASE WHEN error IS NULL THEN size::INT END AS char_count, error FROM pairs",
    "fct_validation_runs": f"WITH {validation_fact()} SELECT * FROM vfact",
    "fct_validation_runs_duplicated": f"WITH {validation_fact()} SELECT * FROM vfact",
    "outcome_history": f"WITH {X.CTE_LEDGER} SELECT md5(CAST(conversation_id AS VARCHAR) || '-' || "
    "prompt_version) AS conversation_version_key, conversation_id, prompt_version, model AS "
    "model_version, prompt_hash, conversation_type AS classified_as_type, classified_at, outcome, "
    + ", ".join(mask(c, keep_unjudged=True) for c in MASKED)
    + ", char_count, error FROM ledger_c WHERE prompt_version IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY conversation_id, ledger_c.prompt_version "
    "ORDER BY classified_at DESC NULLS FIRST) = 1",
    "fct_concept_drift": f"WITH {drift_fact()} SELECT * FROM drift",
    "drift_latest_per_version": f"WITH {drift_fact()} SELECT * FROM newest_runs",
    "drift_latest_run": f"WITH {drift_fact()} SELECT * FROM drift ORDER BY run_at DESC LIMIT 1",
    "tier_drift_recent": f"""WITH {FACT}, recent AS (SELECT outcome_tier FROM classified
  ORDER BY conversation_created_at DESC NULLS FIRST, conversation_id DESC LIMIT 30),
shares AS (SELECT outcome_tier, count(*) / (SELECT count(*) FROM classified) AS baseline_share
  FROM classified GROUP BY 1),
fresh AS (SELECT outcome_tier, count(*) / (SELECT count(*) FROM recent) AS recent_share
  FROM recent GROUP BY 1)
SELECT outcome_tier, coalesce(baseline_share, 0) AS baseline_share,
  coalesce(recent_share, 0) AS recent_share,
  coalesce(recent_share, 0) - coalesce(baseline_share, 0) AS delta
FROM shares FULL JOIN fresh USING (outcome_tier)""",
    "rubric_match_latest": f"WITH {drift_fact()}, last_run AS (SELECT * FROM drift ORDER BY run_at "
    "DESC LIMIT 1) " + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d}_match_rate AS match_rate FROM last_run" for d in V.RUBRIC
    ),
    "blind_split_latest": f"WITH {drift_fact()}, last_run AS (SELECT * FROM drift ORDER BY run_at "
    "DESC LIMIT 1) SELECT 'non-blind (headline)' AS set, outcome_agreement_rate AS agreement "
    "FROM last_run UNION ALL SELECT 'blind (held out)', coalesce(blind_agreement_rate, 0) FROM last_run",
    "watermark_age": f"WITH {X.CTE_CONVERSATIONS} SELECT date_diff('second', max(updated_at), "
    f"{LOADED_AT}) AS age_seconds FROM conversations_a",
    # transcripts
    "transcript_truncated_messages": f"WITH {X.CTE_DIALOGUES}, cut_rows AS (SELECT conversation_id, "
    f"id, sequence_number, message_type, {cut(X.SMALL_LIMITS)} AS content FROM dialogues_b) "
    "SELECT *, length(content) AS length FROM cut_rows",
    "transcripts": parts(X.CTE_MESSAGES, "messages_a", V.CONSULTATION_LIMITS, 512, 1_000_000),
    "transcripts_dialogue": parts(X.CTE_DIALOGUES, "dialogues_b", X.SMALL_LIMITS, 3, 400),
    "transcripts_long": parts(
        X.CTE_LONG_DIALOGUES, "long_dialogues_b", V.CONSULTATION_LIMITS, 512, 20_000),
    "transcripts_capped": capped(
        X.CTE_MESSAGES, "messages_a", V.CONSULTATION_LIMITS, 30000, 20000, 10000),
    "transcripts_capped_sql_output": capped(
        X.CTE_MESSAGES, "messages_a", V.SQL_OUTPUT_LIMITS, 30000, 20000, 10000),
    "transcripts_capped_dialogue": capped(
        X.CTE_DIALOGUES, "dialogues_b", X.SMALL_LIMITS, **X.SMALL_CAP),
    "transcripts_capped_long": capped(
        X.CTE_LONG_DIALOGUES, "long_dialogues_b", V.CONSULTATION_LIMITS, 30000, 20000, 10000),
    "transcripts_capped_long_sql_output": capped(
        X.CTE_LONG_DIALOGUES, "long_dialogues_b", V.SQL_OUTPUT_LIMITS, 30000, 20000, 10000),
    "transcripts_capped_documents": capped(
        "one_long AS (SELECT doc_id AS conversation_id, doc_id AS id, 'thinking' AS message_type, "
        "text AS content, 1 AS sequence_number FROM documents)", "one_long", {"user": 2000},
        30000, 20000, 10000),
    # judge
    "judge_batch": f"WITH {JUDGED} SELECT * FROM judged",
    "judge_ledger_append": f"WITH {JUDGED} SELECT {LEDGER_COLUMNS} FROM ledger_c UNION ALL "
    f"SELECT conversation_id, 'consultation', outcome, {', '.join(V.RUBRIC)}, NULL, reasoning, "
    f"char_count, error, 'consultation_test0001', 'judge-a', 'test0001', {LOADED_AT} FROM judged",
    "judge_reply_parse": """WITH forms(form, outcome, understanding, exhaustion, grounding, action,
  flag, reasoning, error) AS (VALUES
  (0, 'success_clean', NULL, NULL, 2, NULL, NULL, 'plain', NULL),
  (1, 'inconclusive', NULL, NULL, NULL, 3, NULL, NULL, NULL),
  (2, 'failure_abandoned', NULL, 1, NULL, NULL, NULL, NULL, NULL),
  (3, 'success_clean', 1, NULL, NULL, NULL, NULL, NULL, NULL),
  (4, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'JSONDecodeError: broken JSON object: {"outcome": "success_clean", "reasoning": "cut o'),
  (5, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'ValueError: No JSON object in response: I cannot answer that.'),
  (6, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'ValueError: Missing outcome field in response: {"outcome": "", "reasoning": "empty"}'),
  (7, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'ValueError: no reply'),
  (8, 'success_iterative', NULL, NULL, NULL, NULL, TRUE, NULL, NULL))
SELECT event_id, outcome, understanding::INT AS question_understanding,
  exhaustion::INT AS resource_exhaustion, grounding::INT AS answer_grounding,
  action::INT AS actionability, flag AS flag_dev_acknowledged, reasoning, error
FROM events JOIN forms ON form = event_id % 9""",
    "error_class": "SELECT event_id, CASE WHEN event_type = 'error' THEN CASE event_id % 5 "
    "WHEN 0 THEN 'rate_limit' WHEN 3 THEN 'timeout' WHEN 4 THEN 'unknown' ELSE 'parse_error' END "
    "END AS error_class FROM events",
    # marts and checks
    "fct_outcomes": f"WITH {FACT} SELECT * REPLACE ({MONEY}) FROM fact",
    "dq_unique": f"WITH {X.CTE_MESSAGES} SELECT CAST(id AS VARCHAR) AS key, 2::BIGINT AS rows "
    "FROM messages_a WHERE conversation_id % 5 = 0",
    "dq_not_null": f"WITH {X.CTE_MESSAGES} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS failing FROM messages_a"
        for c in ("id", "conversation_id", "content", "tool_use_id")
    ),
    "dq_accepted_values": f"WITH {X.CTE_LEDGER} SELECT outcome AS value, count(*) AS rows "
    "FROM ledger_c WHERE outcome NOT IN "
    f"({', '.join(repr(o) for o in V.SEED_OUTCOMES)}) GROUP BY 1",
    "dq_rate_range": f"WITH {drift_fact()} SELECT validation_run_id, prompt_version, "
    "outcome_agreement_rate FROM drift WHERE outcome_agreement_rate NOT BETWEEN 0 AND 1",
    "drift_gate": f"WITH {drift_fact()} SELECT * FROM newest_runs WHERE agreement_delta_vs_baseline < -0.10",
    "drift_gate_breached": f"WITH {drift_fact(6)} SELECT * FROM newest_runs "
    "WHERE agreement_delta_vs_baseline < -0.10",
    "dq_cast_losses": """SELECT unnest([
  {'column': 'doc_id', 'failing': 0::BIGINT}, {'column': 'n_chars', 'failing': 0::BIGINT},
  {'column': 'lang', 'failing': count(lang)}, {'column': 'source', 'failing': count(source)},
  {'column': 'text', 'failing': count(text)}], recursive := true) FROM documents""",
    # telemetry
    "telemetry_counters": COUNTERS,
    "stream_counters": COUNTERS,
    "rows_fetched": f"WITH {X.CTE_LOADS} SELECT table_name, sum(rows)::BIGINT AS rows_fetched "
    "FROM loads_e GROUP BY 1",
    "latency_histogram": f"WITH {X.CTE_JUDGE_EVENTS} "
    + buckets("judge_e", "conversation_type", "latency_s", V.LATENCY_BUCKETS, 4),
    "insert_latency_histogram": f"WITH {X.CTE_LOADS} "
    + buckets("loads_e", "table_name", "insert_s", V.INSERT_BUCKETS, 4),
    "score_histogram": f"WITH {X.CTE_JUDGE_EVENTS}, {LONG_SCORES} "
    + buckets("scores", "conversation_type, dimension", "score", V.SCORE_BUCKETS, None),
    "latency_quantiles": f"WITH {X.CTE_JUDGE_EVENTS} SELECT time_bucket(INTERVAL '5 minutes', ts, "
    "TIMESTAMP '1970-01-01') AS window_start, conversation_type, "
    f"{quantile(0.5)} AS p50, {quantile(0.95)} AS p95 FROM judge_e GROUP BY 1, 2",
    "latency_quantiles_native": f"WITH {X.CTE_JUDGE_EVENTS} SELECT DISTINCT conversation_type, "
    "true AS p50_in_bound, true AS p95_in_bound FROM judge_e WHERE latency_s IS NOT NULL",
    "latency_quantiles_sliding": f"""WITH {X.CTE_JUDGE_EVENTS}, spread AS (
  SELECT * REPLACE (date_trunc('minute', ts) + to_minutes(CAST(g.range AS INT) + 1) AS ts)
  FROM judge_e, range(5) g)
SELECT ts AS window_end, conversation_type, {quantile(0.5)} AS p50, {quantile(0.95)} AS p95
FROM spread GROUP BY 1, 2""",
    "score_mean_trailing_24h": f"""WITH {X.CTE_JUDGE_EVENTS}, {LONG_SCORES}, spread AS (
  SELECT date_trunc('hour', ts) + to_hours(CAST(g.range AS INT) + 1) AS window_end, dimension, score
  FROM scores, range(24) g)
SELECT window_end, dimension, sum(score)::DOUBLE / count(score) AS mean_score,
  count(score) AS scores FROM spread GROUP BY 1, 2""",
    "error_rate_5m": ERROR_RATE,
    "error_rate_10m": ERROR_RATE.replace("5 minutes", "10 minutes").replace("300.0", "600.0"),
    "stream_error_rate_5m": ERROR_RATE,
    "error_rate_5m_sliding": f"""WITH {X.CTE_JUDGE_EVENTS}, spread AS (
  SELECT date_trunc('minute', ts) - to_minutes(CAST(g.range AS INT)) AS window_start,
    conversation_type, error_type FROM judge_e, range(5) g WHERE error_type IS NOT NULL)
SELECT window_start, conversation_type, error_type, count(*) AS errors,
  round(count(*) / 300.0::DOUBLE, 6) AS errors_per_second FROM spread GROUP BY 1, 2, 3""",
    "score_mean_24h": f"WITH {X.CTE_JUDGE_EVENTS}, {LONG_SCORES} SELECT "
    "date_trunc('day', ts)::TIMESTAMP AS window_start, dimension, "
    "sum(score)::DOUBLE / count(score) AS mean_score FROM scores GROUP BY 1, 2",
    "success_rate": f"WITH {X.CTE_JUDGE_EVENTS} SELECT count(*) FILTER (WHERE "
    "regexp_matches(outcome, '^success')) / count(*) AS success_rate FROM judge_e "
    "WHERE error_type IS NULL",
    "telemetry_totals": f"WITH {X.CTE_JUDGE_EVENTS} SELECT count(*) AS classified, "
    "count(*) FILTER (WHERE flag_dev_acknowledged) AS dev_acknowledged FROM judge_e "
    "WHERE error_type IS NULL",
    # documented reports
    "final_responses": f"WITH {X.CTE_MESSAGES} SELECT conversation_id, sequence_number, "
    "content AS response FROM messages_a WHERE message_type = 'thinking' QUALIFY row_number() OVER "
    "(PARTITION BY conversation_id ORDER BY sequence_number DESC, id DESC) = 1",
    "final_responses_dialogue": f"WITH {X.CTE_DIALOGUES} SELECT conversation_id, "
    "max(sequence_number) AS sequence_number, max_by(content, sequence_number) AS response "
    "FROM dialogues_b WHERE message_type = 'thinking' GROUP BY 1",
    "connection_drops": f"WITH {X.CTE_DIALOGUES} SELECT conversation_id, "
    "max_by(message_type, sequence_number) AS last_kind, max_by(message_type, sequence_number) = "
    "'user' AS is_dropped FROM dialogues_b GROUP BY 1",
    "drop_rate_by_period": f"""WITH {X.CTE_MESSAGES}, {X.CTE_CONVERSATIONS}, ends AS (
  SELECT conversation_id, message_type = 'user' AS dropped FROM messages_a QUALIFY row_number()
    OVER (PARTITION BY conversation_id ORDER BY sequence_number DESC, id DESC) = 1)
SELECT date_trunc('month', created_at)::TIMESTAMP AS period, count(*) AS conversations,
  count(*) FILTER (WHERE dropped) AS dropped, avg(dropped::INT) AS drop_rate
FROM ends e JOIN conversations_a c ON c.id = e.conversation_id GROUP BY 1""",
    "duplicate_user_messages": f"""WITH {X.CTE_MESSAGES}, twice AS (
  SELECT conversation_id, md5(content) AS content_md5, count(*) AS copies,
    max(sequence_number) AS last_copy FROM messages_a WHERE message_type = 'user'
  GROUP BY 1, 2 HAVING count(*) > 1)
SELECT conversation_id, content_md5, copies, last_copy = (SELECT max(sequence_number)
  FROM messages_a m WHERE m.conversation_id = t.conversation_id) AS is_last FROM twice t""",
    "execute_sql_paired": f"""WITH {X.CTE_MESSAGES}, call_ids AS (
  SELECT DISTINCT conversation_id, tool_use_id FROM messages_a
  WHERE message_type = 'tool_call' AND content ILIKE '%execute_sql%'),
fates AS (SELECT c.conversation_id, c.tool_use_id,
    bool_or(m.content ILIKE '%preview%') AS succeeded, bool_or(m.is_error) AS tool_failed,
    bool_or(NOT m.is_error AND m.content ILIKE '%OperationalError%') AS db_failed,
    bool_or(NOT m.is_error AND m.content ILIKE '%execution_status: error%') AS exec_failed
  FROM call_ids c LEFT JOIN messages_a m ON m.conversation_id = c.conversation_id
    AND m.tool_use_id = c.tool_use_id AND m.message_type = 'tool_result' GROUP BY 1, 2)
SELECT conversation_id, count(*) AS executions, {n('succeeded')} AS succeeded,
  {n('tool_failed')} AS tool_errors, {n('db_failed')} AS database_errors,
  {n('exec_failed')} AS executor_errors FROM fates GROUP BY 1""",
    "learning_gate": f"WITH {FACT} SELECT conversation_id, outcome, "
    "(conversation_id % 3 + 1)::INT AS relevance, conversation_id % 3 >= 1 AND "
    "outcome_tier = 'success' AS learn FROM classified",
    "eval_units": f"""WITH {X.CTE_MESSAGES}, pre AS (SELECT DISTINCT conversation_id, tool_use_id
  FROM messages_a WHERE {PREFETCH}), wrote AS (SELECT DISTINCT conversation_id, tool_use_id
  FROM messages_a WHERE {SQL_WRITE}), results AS (SELECT * FROM messages_a WHERE {RESULT}),
context AS (SELECT conversation_id, sequence_number AS place, content AS context
  FROM results SEMI JOIN pre USING (conversation_id, tool_use_id) QUALIFY row_number() OVER
    (PARTITION BY conversation_id ORDER BY sequence_number DESC, id DESC) = 1),
asked AS (SELECT m.conversation_id, content AS question FROM messages_a m JOIN context c
    ON c.conversation_id = m.conversation_id WHERE message_type = 'user' AND sequence_number < place
  QUALIFY row_number() OVER (PARTITION BY m.conversation_id
    ORDER BY sequence_number DESC, id DESC) = 1),
answered AS (SELECT r.conversation_id, content AS answer
  FROM (SELECT * FROM results SEMI JOIN wrote USING (conversation_id, tool_use_id)) r
    JOIN context c ON c.conversation_id = r.conversation_id WHERE sequence_number > place
  QUALIFY row_number() OVER (PARTITION BY r.conversation_id
    ORDER BY sequence_number DESC, id DESC) = 1)
SELECT c.conversation_id, question, context, answer FROM context c
  LEFT JOIN asked USING (conversation_id) LEFT JOIN answered USING (conversation_id)""",
    "outcome_version_shift": f"""WITH {X.CTE_LEDGER}, newest AS (
  SELECT conversation_id, prompt_version, outcome FROM ledger_c WHERE prompt_version IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conversation_id, prompt_version
    ORDER BY classified_at DESC) = 1)
SELECT a.outcome AS outcome_before, b.outcome AS outcome_after, count(*) AS conversations
FROM newest a JOIN newest b ON a.conversation_id = b.conversation_id
  AND a.prompt_version = '{X.OLD_VERSION}' AND b.prompt_version = '{X.NEW_VERSION}'
GROUP BY 1, 2""",
}

SHARES = f"""WITH {FACT}, per_type AS (
  SELECT conversation_type, sum(total_cost_usd) AS total_cost, count(total_cost_usd) AS count
  FROM classified GROUP BY 1)
SELECT *, pct_of_cost - pct_of_count AS imbalance FROM (
  SELECT conversation_type, total_cost::DOUBLE AS total_cost, count,
    total_cost::DOUBLE / (SELECT sum(total_cost) FROM per_type)::DOUBLE AS pct_of_cost,
    count / (SELECT sum(count) FROM per_type)::DOUBLE AS pct_of_count
  FROM per_type)"""
ORACLES["dim_judge_version_loads"] = ORACLES["dim_judge_version"]
ORACLES["explorer_search_mart"] = ORACLES["explorer_search"]
ORACLES["extract_behind_mark"] = (
    f"WITH {X.CTE_CONVERSATIONS} SELECT * REPLACE (total_cost_usd::DOUBLE AS total_cost_usd) "
    "FROM conversations_a WHERE id % 7 = 0 OR id % 11 = 0"
)
ORACLES["latency_quantiles_sketched"] = f"""WITH {X.CTE_JUDGE_EVENTS}
SELECT date_trunc('minute', ts) + to_minutes(CAST(g.range AS INT) + 1) AS window_end, conversation_type,
  count(*) AS latencies, true AS p50_in_bound, true AS p95_in_bound
FROM judge_e, range(5) g WHERE latency_s IS NOT NULL GROUP BY 1, 2"""
ORACLES["transcripts_followed"] = ORACLES["transcripts_capped_long"]
ORACLES["transcripts_reloaded"] = ORACLES["transcripts_capped"]
ORACLES["latest_outcomes_folded"] = ORACLES["latest_outcomes"]
ORACLES["outcome_history_folded"] = ORACLES["outcome_history"]
ORACLES["marts_sql"] = (
    f"WITH {FACT}, history AS ({ORACLES['outcome_history'].replace(f'WITH {X.CTE_LEDGER} ', '')}) "
    "SELECT f.conversation_type, count(*) AS conversations, "
    "count(*) FILTER (WHERE f.is_classified) AS classified, sum(h.judgements)::BIGINT AS judgements, "
    "sum(f.total_turns)::BIGINT AS turns FROM fact f LEFT JOIN (SELECT conversation_id, "
    "count(*) AS judgements FROM history GROUP BY 1) h USING (conversation_id) GROUP BY 1"
)
ORACLES["fct_outcomes_mart"] = ORACLES["fct_outcomes"]
ORACLES["stream_signals_relanded"] = ORACLES["stream_signals"]
ORACLES["stream_score_means"] = ORACLES["score_mean_24h"]
ORACLES["cost_concentration"] = SHARES
ORACLES["cost_concentration_top"] = f"{SHARES} ORDER BY imbalance DESC LIMIT 1"


def _counts(check: str, source: str, table: str, columns: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
        f"{n(condition)} AS failing FROM {source}"
        for column, condition in columns.items()
    ]


def _nulls(source: str, table: str, *columns: str) -> list[str]:
    return _counts("not_null", source, table, {c: f"{c} IS NULL" for c in columns})


ORACLES["dq_report"] = (
    f"WITH {FACT}, {drift_fact()} "
    + " UNION ALL ".join(
        _nulls("conversations_a", "conversations", "id")
        + _nulls("runs_a", "runs", "id", "conversation_id")
        + _nulls("messages_a", "messages", "id", "conversation_id")
        + _nulls("fact", "outcomes", "conversation_id", "conversation_type", "is_classified")
        + _nulls("labels_d", "labels", "conversation_id", "expected_outcome", "label_cohort",
                 "is_blind")
        + _nulls("vfact", "validation_runs", "validation_case_key", "validation_run_id",
                 "outcome_passed")
        + _nulls("drift", "concept_drift", "validation_run_id", "prompt_version")
        + _counts("accepted_values", "fact", "outcomes",
                  {"conversation_type": f"conversation_type NOT IN {TYPES}"})
        + _counts("accepted_values", "labels_d", "labels", {
            "expected_outcome":
            f"expected_outcome NOT IN ({', '.join(repr(o) for o in V.SEED_OUTCOMES)})"})
        + _counts("accepted_values", "drift", "concept_drift", {
            "drift_band": "drift_band NOT IN ('stable', 'moderate', 'significant', 'unknown')"})
        + _counts("unique", "(SELECT id FROM conversations_a GROUP BY 1 HAVING count(*) > 1)",
                  "conversations", {"id": "TRUE"})
        + _counts("unique", "(SELECT id FROM runs_a GROUP BY 1 HAVING count(*) > 1)", "runs",
                  {"id": "TRUE"})
        + _counts("unique", "messages_a", "messages", {"id": "conversation_id % 5 = 0"})
        + _counts("unique", "(SELECT 1 FROM fact GROUP BY conversation_id HAVING count(*) > 1)",
                  "outcomes", {"conversation_id": "TRUE"})
        + _counts("unique", "(SELECT 1 FROM vfact GROUP BY validation_case_key HAVING count(*) > 1)",
                  "validation_runs", {"validation_case_key": "TRUE"})
    )
)
