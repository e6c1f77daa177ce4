"""One-pass signals against a message-by-message recount in plain Python."""

import datetime
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from talkmeter import vocabulary as V
from talkmeter.plans import signals, staging

SCHEMA = (
    "id bigint, conversation_id bigint, message_type string, content string, "
    "sequence_number int, created_at timestamp_ntz"
)
NOW = datetime.datetime(2026, 5, 1)
TEXTS = [
    None, "", "schema_prefetch_tool(x)", "SCHEMA-PREFETCH.TOOL", "Write(file_path='/a/SQL/b')",
    "Write(file_path='/a/b')", "TodoWrite(Write(file_path='/sql/')", "write(", "Execute_SQL",
    "a\npreview\nb", "OperationalError: x", "Quality Score: 7/10", "quality score 9",
    "Quality Score none", "Quality Score\n is 12 of 3", "it should be so", "use\nany table",
    "table use", "not that right", "right, not", "Documentation sync last performed",
    "tool_use_error", "tool use error", "ImportError", "modulenotfounderror",
    "The tool use was rejected",
]
ROWS = st.lists(
    st.tuples(
        st.integers(0, 2),
        st.sampled_from([*V.MESSAGE_KINDS, "other", None]),
        st.sampled_from(TEXTS),
        st.one_of(st.none(), st.integers(0, 6)),
    ),
    max_size=25,
)


def like(content, pattern):
    if content is None:
        return False
    regex = re.escape(pattern).replace("%", ".*").replace("_", ".")
    return re.fullmatch(regex, content, re.DOTALL | re.IGNORECASE) is not None


def recount(rows):
    """Signals of one conversation, counted row by row."""

    def matching(kinds, *patterns, but=()):
        return [
            (pos, text) for kind, text, pos in rows
            if (kinds is None or kind in kinds)
            and any(like(text, p) for p in patterns) and not any(like(text, p) for p in but)
        ]

    def first(found):
        places = [pos for pos, _ in found if pos is not None]
        return min(places) if places else None

    def score(text):
        hit = re.search(V.REVIEW_SCORE_REGEX, text)
        return int(hit.group(1)) if hit else None

    result = ["tool_result"]
    prefetch = matching(["tool_call"], V.PREFETCH_CALL)
    writes = matching(["tool_call"], V.FILE_WRITE, but=[V.TODO_WRITE])
    sql = [w for w in writes if like(w[1], V.SQL_FOLDER)]
    reviews = [
        (2**31 - 1 if pos is None else pos, -1 if score(t) is None else score(t))
        for pos, t in matching(result, V.REVIEW_SCORE_LINE)
    ]

    def shown(number):
        return None if number == -1 else number

    return {
        "total_user_messages": sum(kind == "user" for kind, _, _ in rows),
        "prefetch_call_count": len(prefetch),
        "first_prefetch_sequence": first(prefetch),
        "sql_write_count": len(sql),
        "non_sql_write_count": len(writes) - len(sql),
        "first_write_sequence": first(sql),
        "execute_sql_count": len(matching(["tool_call", "tool_result"], *V.SQL_EXECUTION)),
        "execute_sql_success_count": len(matching(result, V.RESULT_PREVIEW)),
        "permission_error_count": len(matching(result, V.DATABASE_ERROR)),
        "code_review_count": len(reviews),
        "code_review_score_first": shown(min(reviews)[1]) if reviews else None,
        "code_review_score_last": shown(max(reviews)[1]) if reviews else None,
        "user_correction_count": len(matching(["user"], *V.CORRECTION_PHRASES)),
        "stale_doc_warning_count": len(matching(None, V.STALE_DOCUMENT)),
        "tool_use_error_count": len(matching(result, V.TOOL_USE_ERROR)),
        "codebase_error_count": len(matching(result, *V.CODEBASE_ERRORS)),
        "user_rejected_tool_count": len(matching(result, V.REJECTED_TOOL)),
    }


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.booleans())
def test_one_pass_equals_recount(spark, rows, copied):
    """With ``copied`` every row lands twice and must still count once."""
    numbered = [(i, conv, kind, text, pos, NOW) for i, (conv, kind, text, pos) in enumerate(rows)]
    frame = spark.createDataFrame(numbered * (2 if copied else 1), SCHEMA)
    got = {r["conversation_id"]: r for r in signals.message_signals(frame, copied).collect()}
    for conv in {row[0] for row in rows}:
        expected = recount([row[1:] for row in rows if row[0] == conv])
        assert {name: got[conv][name] for name in expected} == expected
    assert len(got) == len({row[0] for row in rows})


def conversation(spark, **values):
    row = {"id": 1, "total_turns": 5, "total_duration_ms": 10, "learning_extracted_at": None,
           "created_at": NOW, "updated_at": NOW, **values}
    schema = ("id bigint, total_turns int, total_duration_ms bigint, "
              "learning_extracted_at timestamp_ntz, created_at timestamp_ntz, "
              "updated_at timestamp_ntz")
    return spark.createDataFrame([tuple(row.values())], schema)


def typed(spark, messages=(), **values):
    rows = [(i, 1, kind, text, i, NOW) for i, (kind, text) in enumerate(messages)]
    runs = spark.createDataFrame(
        [], "id bigint, conversation_id bigint, cost_usd decimal(10,4), duration_ms bigint, "
        "completed_at timestamp_ntz")
    frame = signals.conversation_signals(
        conversation(spark, **values), spark.createDataFrame(rows, SCHEMA), runs)
    return signals.conversation_types(frame).first()


SQL_WRITE = ("tool_call", "Write(file_path='/w/sql/x')")
OTHER_WRITE = ("tool_call", "Write(file_path='/w/x')")
PREFETCH = ("tool_call", "schema_prefetch_tool()")
EARLY = datetime.datetime(2026, 2, 28, 23, 59)


@pytest.mark.parametrize(
    "messages, values, expected",
    [
        ([SQL_WRITE], {"total_turns": 0}, "ghost"),
        ([SQL_WRITE], {"total_turns": 76}, "anomalous"),
        ([SQL_WRITE], {"total_turns": 75}, "modification"),
        ([], {"created_at": EARLY}, "unknown"),
        ([("user", "hi")], {"created_at": EARLY, "total_turns": None}, "consultation"),
        ([], {"created_at": None}, "consultation"),
        ([PREFETCH, SQL_WRITE], {}, "generation"),
        # An early SQL write with a prefetch call is a modification.
        ([PREFETCH, SQL_WRITE], {"created_at": EARLY}, "modification"),
        ([OTHER_WRITE], {}, "diagnostic"),
        ([PREFETCH], {}, "consultation"),
    ],
)
def test_type_priority(spark, messages, values, expected):
    assert typed(spark, messages, **values)["conversation_type"] == expected


def test_conversation_without_messages_or_runs_is_zero_filled(spark):
    row = typed(spark)
    assert all(row[name] == 0 for name in signals.COUNTS)
    assert all(row[name] is None for name in signals.POSITIONS)
    assert (row["total_cost_usd"], row["run_count"], row["avg_run_duration_ms"]) == (0, 0, 0.0)


def test_gap_may_be_negative(spark):
    assert typed(spark, [SQL_WRITE, ("user", "x"), PREFETCH])["prefetch_to_write_gap"] == -2


def test_execution_counts_call_and_result_and_any_preview(spark):
    """Calls, their results and unrelated previews all count, on purpose."""
    row = typed(spark, [("tool_call", "execute_sql(1)"), ("tool_result", "execute_sql: preview"),
                        ("tool_result", "page preview")])
    assert (row["execute_sql_count"], row["execute_sql_success_count"]) == (3, 2)


@pytest.mark.parametrize(
    "raw, whole, cost",
    [("", None, None), ("1.6", 2, "1.6000"), ("abc", None, None), (None, None, None),
     ("1.00005", 1, "1.0001")],
)
def test_numbers_from_text(spark, raw, whole, cost):
    frame = spark.createDataFrame([(raw, raw)], "id string, cost_usd string")
    row = staging.stg_runs(frame, dedupe=False).first()
    assert row["id"] == whole
    assert (None if row["cost_usd"] is None else str(row["cost_usd"])) == cost


def test_times_and_flags_from_text(spark):
    frame = spark.createDataFrame(
        [("2026-01-02 03:04:05+00:00", "t"), ("2026-01-02 03:04:05", "1"), ("soon", "maybe")],
        "created_at string, is_error string",
    )
    rows = staging.stg_messages(frame, dedupe=False).collect()
    noon = datetime.datetime(2026, 1, 2, 3, 4, 5)
    assert [r["created_at"] for r in rows] == [noon, noon, None]
    assert [r["is_error"] for r in rows] == [True, True, None]


def test_newest_copy_of_a_row_wins(spark):
    frame = spark.createDataFrame(
        [("1", "old", "2026-01-01 00:00:00"), ("1", "new", "2026-01-02 00:00:00"),
         ("2", "only", None)],
        "id string, title string, updated_at string",
    )
    rows = {r["id"]: r["title"] for r in staging.stg_conversations(frame).collect()}
    assert rows == {1: "new", 2: "only"}


def test_greatest_score_does_not_overflow(spark):
    """2147483647 is a score like any other; a greater number is none."""
    schema = ("id bigint, conversation_id bigint, message_type string, content string, "
              "sequence_number int, created_at timestamp_ntz")
    rows = [(i, 1, "tool_result", f"Quality Score: {score}", i, None)
            for i, score in enumerate((0, 2147483647))]
    found = signals.message_signals(spark.createDataFrame(rows, schema)).first()
    assert (found["code_review_score_first"], found["code_review_score_last"]) == (0, 2147483647)
    assert found["code_review_score_delta"] == 2147483647
    over = [(1, 1, "tool_result", "Quality Score: 2147483648", 1, None)]
    found = signals.message_signals(spark.createDataFrame(over, schema)).first()
    assert found["code_review_count"] == 1 and found["code_review_score_last"] is None
