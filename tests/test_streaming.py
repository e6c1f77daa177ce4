"""Streams give what the batch gives, also after restarts and late files."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from talkmeter.catalog import fixtures as X
from talkmeter.catalog import queries
from talkmeter.plans import signals, telemetry
from talkmeter.streaming import papers as stream_papers
from talkmeter.streaming import signals as stream_signals
from talkmeter.streaming import sinks
from talkmeter.streaming import telemetry as stream_telemetry


def rows_of(df):
    return sorted(
        (tuple(str(row[c]) for c in sorted(df.columns)) for row in df.collect())
    )


@pytest.fixture(scope="module")
def event_files(spark, sf_dir, tmp_path_factory):
    """The events as five files, so that rows arrive out of order."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = X.table(spark, sf_dir, "events")
    for part in range(5):
        events.filter(F.col("event_id") % 5 == part).coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder, files=1):
    schema = spark.read.parquet(folder).schema
    return sinks.read_stream(spark, folder, schema, files)


@pytest.mark.parametrize(
    "streamed, batch, keys",
    [
        (stream_telemetry.counters, telemetry.counters, ["metric", "label_1", "label_2"]),
        (lambda e: stream_telemetry.error_rate(e, "40 days"), telemetry.error_rate,
         ["window_start", "conversation_type", "error_type"]),
        (lambda e: stream_telemetry.error_rate(e, "40 days", "1 minute"),
         lambda e: telemetry.error_rate(e, slide="1 minute"),
         ["window_start", "conversation_type", "error_type"]),
        (lambda e: stream_telemetry.latency_quantiles(e, "40 days"), telemetry.latency_quantiles,
         ["window_start", "conversation_type"]),
        (lambda e: stream_telemetry.score_means(e, "40 days"), telemetry.score_means,
         ["window_start", "dimension"]),
    ],
    ids=["counters", "error_rate", "error_rate_sliding", "quantiles", "scores"],
)
def test_update_stream_equals_batch(spark, sf_dir, event_files, tmp_path, streamed, batch, keys):
    result = streamed(X.to_judge_events(stream(spark, event_files)))
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    sinks.run_change_log(result, log, checkpoint)
    batches = lambda: [d for d in os.listdir(log) if d.startswith("batch=")]
    assert len(batches()) >= 5
    expected = rows_of(batch(X.judge_events(spark, sf_dir)))
    assert rows_of(sinks.read_change_log(spark, log, keys, result.schema)) == expected
    # All batches but the last, which might be run again, become one; a second time nothing is left to do.
    folded = sinks.fold_log(spark, log, keys, [F.desc("batch")], result.schema)
    assert folded >= 3 and len(batches()) == 2
    assert sinks.fold_log(spark, log, keys, [F.desc("batch")], result.schema) == -1
    assert rows_of(sinks.read_change_log(spark, log, keys, result.schema)) == expected


def test_many_files_out_of_order_lose_no_rows(spark, sf_dir, tmp_path):
    """Drained as one batch a table equals the batch form; in batches of 64 files the loss is an error."""
    events = X.table(spark, sf_dir, "events")
    folder = str(tmp_path / "events.parquet")
    events.repartition(130).write.parquet(folder)
    expected = rows_of(telemetry.error_rate(X.judge_events(spark, sf_dir)))
    assert rows_of(queries.rounded(queries.REGISTRY["stream_error_rate_5m"](spark, str(tmp_path)))) == rows_of(
        queries.rounded(telemetry.error_rate(X.judge_events(spark, sf_dir))))
    result = stream_telemetry.error_rate(X.to_judge_events(stream(spark, folder, 64)), "10 minutes")
    with pytest.raises(sinks.LateRows):
        sinks.run_change_log(result, str(tmp_path / "log"), str(tmp_path / "checkpoint"))
    wide = stream_telemetry.error_rate(X.to_judge_events(stream(spark, folder, 64)), "4000 days")
    sinks.run_change_log(wide, str(tmp_path / "log2"), str(tmp_path / "checkpoint2"))
    keys = ["window_start", "conversation_type", "error_type"]
    assert rows_of(sinks.read_change_log(spark, str(tmp_path / "log2"), keys, wide.schema)) == expected


def event(number, ts, kind="error"):
    return (number, ts, 0, kind, 1.0, "{}")


SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
START = datetime.datetime(2024, 1, 1, 12, 0)


def test_append_mode_closes_windows_and_drops_late_rows(spark, tmp_path):
    """A window comes out once the watermark has passed it; later rows are lost."""
    folder = str(tmp_path / "in")
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def add(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def drain():
        result = stream_telemetry.error_rate(X.to_judge_events(stream(spark, folder)), "10 minutes")
        progress = sinks.run_change_log(result, log, checkpoint, mode="append", allow_late=True)
        dropped.append(sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"]))
        return result.schema

    dropped = []

    add(event(1, START), event(5, START + datetime.timedelta(minutes=1)))
    drain()
    add(event(9, datetime.datetime(2024, 12, 31)))
    drain()
    add(event(13, START + datetime.timedelta(minutes=2)))
    schema = drain()
    keys = ["window_start", "conversation_type", "error_type"]
    rows = sinks.read_change_log(spark, log, keys, schema).collect()
    assert [(r["window_start"], r["errors"]) for r in rows] == [(START, 2)]
    # The lost row is counted in the reports of its drain.
    assert dropped == [0, 0, 1]


def test_late_rows_of_more_batches_than_spark_keeps_reports_of_fail_the_drain(spark, tmp_path):
    folder = str(tmp_path / "in")
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "1")
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    for number, ts in enumerate([datetime.datetime(2024, 12, 31), *[START] * 9]):
        rows = session.createDataFrame([event(4 * number + 1, ts)], SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(folder)
    result = stream_telemetry.error_rate(X.to_judge_events(stream(session, folder)), "10 minutes")
    with pytest.raises(sinks.LateRows, match="^[89] rows"):
        sinks.run_change_log(result, str(tmp_path / "log"), str(tmp_path / "checkpoint"))


def test_state_is_given_up_once_the_watermark_has_passed(spark, tmp_path):
    folder = str(tmp_path / "in")
    for hour in range(6):
        rows = [event(4 * i + 1, START + datetime.timedelta(hours=hour, minutes=i)) for i in range(60)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    result = stream_telemetry.error_rate(X.to_judge_events(stream(spark, folder)), "10 minutes")
    progress = sinks.run_change_log(result, str(tmp_path / "log"), str(tmp_path / "checkpoint"))
    held = [step["stateOperators"][0]["numRowsTotal"] for step in progress if step["stateOperators"]]
    assert max(held) <= 2 * 12 + 3 and held[-1] <= 3


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    log, schema = str(tmp_path / "log"), spark.createDataFrame([], "k int, v int").schema
    read = lambda: sorted(tuple(r) for r in sinks.read_change_log(spark, log, ["k"], schema).collect())
    sinks.write_batch(spark.createDataFrame([(1, 1)], schema), log, 0)
    sinks.write_batch(spark.createDataFrame([(1, 9), (3, 9)], schema), log, 1)
    sinks.write_batch(spark.createDataFrame([(1, 2), (2, 2)], schema), log, 1)
    assert read() == [(1, 2), (2, 2)] and len(sinks.read_log(spark, log, schema).collect()) == 3


MESSAGES = ("id bigint, conversation_id bigint, message_type string, content string, "
            "sequence_number int, created_at timestamp_ntz")
TEXTS = ["Quality Score: 3", "Quality Score: 8", "preview", "that is wrong", "execute_sql",
         "Write(file_path='/sql/x')", "schema_prefetch_tool()"]


def message_rows():
    kinds = ["tool_result", "tool_result", "tool_result", "user", "tool_call", "tool_call", "tool_call"]
    return [
        (i, i % 4, kinds[i % 7], TEXTS[i % 7], (i * 5) % 60, START + datetime.timedelta(minutes=i))
        for i in range(60)
    ]


def test_running_signals_equal_batch_with_repeats_edits_and_restart(spark, tmp_path):
    folder = str(tmp_path / "in")
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    rows = [(*row, 1) for row in message_rows()]

    def add(part):
        frame = spark.createDataFrame(part, f"{MESSAGES}, _load bigint")
        frame.coalesce(1).write.mode("append").parquet(folder)

    def drain():
        messages = stream(spark, folder)
        stream_signals.follow(messages, log, checkpoint)
        schema = stream_signals.flag_rows(messages).schema
        return schema, rows_of(stream_signals.current_signals(sinks.read_log(spark, log, schema)))

    def expected(found):
        frame = spark.createDataFrame(found, f"{MESSAGES}, _load bigint")
        return rows_of(signals.message_signals(frame, dedupe=True))

    add(rows[40:])
    add(rows[:20])
    assert drain()[1] == expected(rows[40:] + rows[:20])
    # After a restart: new rows, a conversation that lands again, and messages that a later load has
    # changed, one of them into nothing that counts; an earlier load arrives last and changes nothing.
    edited = [(*row[:3], "Quality Score: 5" if row[0] % 2 else "", *row[4:6], 2) for row in rows[::7]]
    add(rows[20:40])
    add(edited + [row for row in rows if row[1] == 2])
    add(rows[::3])
    schema, got = drain()
    assert got == expected(rows + edited) != expected(rows)
    assert stream_signals.fold(spark, log, schema) >= 2
    assert rows_of(stream_signals.current_signals(sinks.read_log(spark, log, schema))) == got
    assert sinks.read_log(spark, log, schema).count() < len(rows) + len(rows[::3]) + 1


def test_signals_of_a_table_of_many_files_equal_batch(spark, sf_dir, tmp_path):
    """None of the files is in the order of event time."""
    lines = X.table(spark, sf_dir, "lineitem")
    lines.repartition(150).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = queries.REGISTRY["stream_signals"](spark, str(tmp_path))
    assert rows_of(got) == rows_of(signals.message_signals(X.messages(spark, sf_dir)))


def test_restart_without_new_files_changes_nothing(spark, event_files, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    for _ in range(2):
        result = stream_telemetry.counters(X.to_judge_events(stream(spark, event_files, 5)))
        sinks.run_change_log(result, log, checkpoint)
    assert [d for d in os.listdir(log) if d.startswith("batch=")] == ["batch=0"]


def test_empty_log_reads_as_empty(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v int").schema
    assert sinks.read_change_log(spark, str(tmp_path / "none"), ["k"], schema).count() == 0


def record(number, title):
    return json.dumps({"id": f"http://arxiv.org/abs/{number}/", "title": title, "summary": "s",
                       "published": "2024-01-01T00:00:00Z", "authors": ["A"], "categories": ["c"]})


def test_paper_stream_takes_late_files_without_going_back(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def drain():
        lines = stream_papers.line_stream(spark, str(folder))
        stream_papers.ingest(lines, log, checkpoint, "2026-01-01")
        rows = stream_papers.current_papers(spark, log).collect()
        return {r["paper_id"]: r["title"] for r in rows}

    (folder / "f2.jsonl").write_text("\n".join([record(1, "two"), "broken{", record(1, "two b")]))
    assert drain() == {"1": "two b"}
    # A late file under an earlier name adds papers but does not undo newer ones.
    (folder / "f1.jsonl").write_text("\n".join([record(1, "one"), record(3, "late")]))
    assert drain() == {"1": "two b", "3": "late"}
    (folder / "f3.jsonl").write_text(record(3, "newest"))
    assert drain() == {"1": "two b", "3": "newest"}
    assert stream_papers.fold(spark, log) == 1
    rows = stream_papers.current_papers(spark, log).collect()
    assert {r["paper_id"]: r["title"] for r in rows} == {"1": "two b", "3": "newest"}
