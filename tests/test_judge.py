"""The judging stage: replies, retries, queues and whole runs."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.functions import keys, labels
from talkmeter.operators import judge, queue
from talkmeter.plans import judging, outcomes
from talkmeter.sources import tables

AT = "2026-06-01 12:00:00"
LEDGER = (
    "conversation_id bigint, conversation_type string, outcome string, "
    + ", ".join(f"{d} int" for d in V.RUBRIC)
    + ", flag_dev_acknowledged boolean, reasoning string, char_count bigint, error string, "
    "prompt_version string, model string, prompt_hash string, classified_at timestamp"
)


def parse(spark, reply):
    return judge.parse_replies(spark.createDataFrame([(1, reply)], "id int, reply string")).first()


@pytest.mark.parametrize(
    "reply, outcome, error",
    [
        ('{"outcome": "success_clean"}', "success_clean", None),
        ('```json\n{"outcome": "inconclusive"}\n```', "inconclusive", None),
        ('{"outcome": "success_clean"} and {more} prose', "success_clean", None),
        ('Sure! {"outcome": "success_clean"}', "success_clean", None),
        ('{"outcome": "success_cl', None, "JSONDecodeError"),
        ("none", None, "No JSON object"),
        ('{"outcome": ""}', None, "Missing outcome"),
        ('{"outcome": null}', None, "Missing outcome"),
        ('{"reasoning": "x"}', None, "Missing outcome"),
        (None, None, "no reply"),
    ],
)
def test_reply_forms(spark, reply, outcome, error):
    row = parse(spark, reply)
    assert row["outcome"] == outcome
    assert (row["error"] is None) if error is None else (error in row["error"])


def test_reply_fields(spark):
    row = parse(spark, json.dumps({
        "outcome": "success_clean", "question_understanding": 3, "resource_exhaustion": "2",
        "answer_grounding": "high", "flag_dev_acknowledged": True, "reasoning": "a {b} c"}))
    assert [row[d] for d in V.RUBRIC] == [3, 2, None, None]
    assert (row["flag_dev_acknowledged"], row["reasoning"]) == (True, "a {b} c")


def work(spark, texts):
    rows = [(i, "consultation", len(t), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "conversation_id bigint, conversation_type string, char_count bigint, transcript string")


def flaky(failures):
    """A judge that is rate limited ``failures`` times per process, then answers."""
    state = {"left": failures}

    class RateLimitError(Exception):
        pass

    def answer(content, kind):
        if "bad" in content:
            raise ValueError("bad text")
        if state["left"] > 0:
            state["left"] -= 1
            raise RateLimitError("slow down")
        return '{"outcome": "success_clean"}'

    return answer


def test_rate_limited_call_is_retried(spark):
    replies = judge.call_judge(work(spark, ["a"]), flaky(2), parallelism=1, wait_seconds=0)
    row = judge.parse_replies(replies).first()
    assert (row["outcome"], row["retries"], row["error"]) == ("success_clean", 2, None)


def test_rate_limit_gives_up_after_three_attempts(spark):
    replies = judge.call_judge(work(spark, ["a"]), flaky(9), parallelism=1, wait_seconds=0)
    row = judge.parse_replies(replies).first()
    assert row["error"] == "RateLimitError: Failed after 3 retries" and row["retries"] == 3


def test_failed_row_leaves_the_others_alone(spark):
    replies = judge.call_judge(
        work(spark, ["good", "bad", "good"]), flaky(0), parallelism=1, wait_seconds=0)
    rows = {r["conversation_id"]: r for r in judge.parse_replies(replies).collect()}
    assert [rows[i]["outcome"] for i in range(3)] == ["success_clean", None, "success_clean"]
    assert rows[1]["error"] == "ValueError: bad text"
    events = judge.judge_events(
        judge.parse_replies(replies), F.lit(AT).cast("timestamp")).collect()
    assert sorted(e["error_type"] or "" for e in events) == ["", "", "parse_error"]


@pytest.mark.parametrize(
    "name, expected",
    [("RateLimitError", "rate_limit"), ("JSONDecodeError", "parse_error"),
     ("ValueError", "parse_error"), ("APITimeoutError", "timeout"), ("KeyError", "unknown"),
     ("RateLimitValueError", "rate_limit"), (None, None)],
)
def test_error_class(spark, name, expected):
    frame = spark.createDataFrame([(name,)], "name string")
    assert frame.select(labels.error_class(F.col("name"))).first()[0] == expected


def ledger(spark, rows):
    full = [
        (c, "consultation", o, 1, 2, 3, 1, None, f"r{i}", 10, e, v, "m", "h",
         datetime.datetime(2026, 5, 1 + day))
        for i, (c, o, e, v, day) in enumerate(rows)
    ]
    return spark.createDataFrame(full, LEDGER)


def typed(spark, rows):
    return spark.createDataFrame(rows, "conversation_id bigint, conversation_type string")


TYPED = [(1, "consultation"), (2, "consultation"), (3, "consultation"), (4, "generation"),
         (5, "diagnostic")]


def queued(spark, rows, types, version):
    frame = queue.judge_queue(typed(spark, TYPED), ledger(spark, rows), types, version)
    return [r["conversation_id"] for r in frame.collect()]


def test_queue_skips_done_and_keeps_failed(spark):
    rows = [(1, "success_clean", None, "v1", 0), (2, None, "ValueError", "v1", 0),
            (2, "success_clean", None, "v0", 0)]
    assert queued(spark, rows, V.CONSULTATION_TYPES, "v1") == [2, 3]
    assert queued(spark, rows, V.SQL_TYPES, "v1") == [4]


def test_new_version_queues_everything(spark):
    rows = [(1, "success_clean", None, "v1", 0)]
    assert queued(spark, rows, V.CONSULTATION_TYPES, "v2") == [1, 2, 3]


def test_null_id_in_the_ledger_hides_nothing(spark):
    rows = [(None, "success_clean", None, "v1", 0)]
    assert queued(spark, rows, V.CONSULTATION_TYPES, "v1") == [1, 2, 3]


def test_fingerprint_rotates_with_model_and_prompt(spark):
    def version(model, prompt):
        column = keys.prompt_version("consultation", F.lit(model), F.lit(prompt))
        return spark.range(1).select(column).first()[0]

    assert version("a", "b") == "consultation_" + __import__("hashlib").sha256(
        b"a\nb").hexdigest()[:8]
    assert len({version("a", "b"), version("a", "c"), version("b", "b")}) == 3


def test_latest_error_hides_an_earlier_success(spark):
    rows = [(1, "success_clean", None, "v1", 0), (1, None, "ValueError", "v1", 1)]
    row = outcomes.latest_outcomes(ledger(spark, rows)).first()
    assert row["outcome"] is None


def test_masks(spark):
    rows = [(1, "inconclusive", None, "v1", 0), (2, None, "E", "v1", 0),
            (3, "success_clean", None, "v1", 0)]
    fact = {r["conversation_id"]: r["actionability"] for r in
            outcomes.masked_outcomes(outcomes.latest_outcomes(ledger(spark, rows))).collect()}
    assert fact == {1: None, 2: None, 3: 1}
    history = {r["conversation_id"]: r["actionability"]
               for r in outcomes.outcome_history(ledger(spark, rows)).collect()}
    # The history keeps the scores of rows without an outcome.
    assert history == {1: None, 2: 1, 3: 1}


def test_registry_takes_the_first_type_by_alphabet(spark):
    rows = ledger(spark, [(1, "success_clean", None, "v1", 0)]).unionByName(
        ledger(spark, [(2, "success_clean", None, "v1", 3)]).withColumn(
            "conversation_type", F.lit("a_later_type")))
    row = outcomes.judge_versions(rows).first()
    assert row["first_conversation_type"] == "a_later_type"
    assert (row["distinct_conversation_types"], row["distinct_conversations"]) == (2, 2)


MESSAGES = [(1, 1, "user", "hello", 0), (2, 1, "thinking", "answer", 1), (3, 2, "user", "bad", 0)]


def test_whole_run_then_rerun(spark, tmp_path):
    """The second run judges only what failed; unchanged rows stay as they were."""
    path = str(tmp_path / "ledger")
    messages = spark.createDataFrame(
        MESSAGES, "id bigint, conversation_id bigint, message_type string, content string, "
        "sequence_number int")
    profile = judging.consultation_profile("m", "v1", "h")
    rows = judging.run_judge(
        typed(spark, TYPED), messages, spark.createDataFrame([], LEDGER), path, flaky(0), profile,
        AT, str(tmp_path / "copy"), slices=3, parallelism=2, wait_seconds=0)
    first = {r["conversation_id"]: r for r in rows.collect()}
    assert {c: r["outcome"] for c, r in first.items()} == {
        1: "success_clean", 2: None, 3: "success_clean"}
    assert first[1]["char_count"] == len("[user] hello\n\n[thinking] answer")
    assert first[3]["char_count"] == 0
    assert spark.read.json(str(tmp_path / "copy")).count() == 3

    def patient(content, kind):
        return '{"outcome": "failure_abandoned", "actionability": 1}'

    again = judging.run_judge(
        typed(spark, TYPED), messages, tables.read_ledger(spark, path), path, patient, profile,
        "2026-06-02 12:00:00", parallelism=2, wait_seconds=0)
    assert [(r["conversation_id"], r["outcome"]) for r in again.collect()] == [
        (2, "failure_abandoned")]
    ledger_now = tables.read_ledger(spark, path)
    assert ledger_now.count() == 4
    latest = {r["conversation_id"]: r["outcome"]
              for r in outcomes.latest_outcomes(ledger_now).collect()}
    assert latest == {1: "success_clean", 2: "failure_abandoned", 3: "success_clean"}


def test_sql_rows_keep_their_type(spark):
    replies = spark.createDataFrame(
        [(1, "generation", 5, '{"outcome": "success_clean"}'), (2, None, 5, "x")],
        "conversation_id bigint, conversation_type string, char_count bigint, reply string")
    rows = judge.ledger_rows(judge.parse_replies(replies), "v", "m", "h", AT).collect()
    assert {r["conversation_id"]: r["conversation_type"] for r in rows} == {
        1: "generation", 2: "unknown"}


def test_validation_run_end_to_end(spark, tmp_path):
    labelled = spark.createDataFrame(
        [(1, "success_clean", 3, None, None, 1, "c", False), (2, "inconclusive", *[None] * 4, "c", True)],
        "conversation_id bigint, expected_outcome string, "
        + ", ".join(f"expected_{d} int" for d in V.RUBRIC) + ", label_cohort string, is_blind boolean")
    messages = spark.createDataFrame(
        MESSAGES, "id bigint, conversation_id bigint, message_type string, content string, "
        "sequence_number int")

    def answer(content, kind):
        if "bad" in content:
            raise ValueError("bad text")
        return '{"outcome": "success_clean", "question_understanding": 1}'

    rows = judging.run_validation(
        labelled, messages, str(tmp_path / "v"), answer,
        judging.consultation_profile("m", "v1", "h"), "run1", AT, parallelism=1, wait_seconds=0)
    got = {r["conversation_id"]: r for r in rows.collect()}
    assert (got[1]["outcome_passed"], got[1]["question_understanding_abs_error"]) == (True, 2)
    assert (got[2]["outcome_passed"], got[2]["error"]) == (False, "ValueError: bad text")
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2
