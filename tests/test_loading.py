"""Incremental loads, published tables, paper files and feeds."""

import datetime
import json
import os
import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from talkmeter.operators.latest import latest_by, upsert
from talkmeter.plans import outcomes, signals, staging
from talkmeter.sources import incremental, keyed, papers, tables

PARENTS = "id bigint, title string, updated_at timestamp_ntz"
RUNS = "id bigint, conversation_id bigint, cost_usd decimal(10,4), completed_at timestamp_ntz"
MESSAGES = ("id bigint, conversation_id bigint, message_type string, content string, "
            "sequence_number int, created_at timestamp_ntz")


def day(number):
    return datetime.datetime(2026, 1, number)


def source(spark, second=False):
    """Two conversations; later the second one changes and gains a message."""
    moved = day(5) if second else day(3)
    parents = [(1, "a", day(2)), (2, "b2" if second else "b", moved)]
    messages = [(10, 1, "user", "x", 0, day(2)), (20, 2, "user", "y", 0, day(3)),
                (21, 2, "system", "hidden", 1, day(3))]
    if second:
        messages.append((22, 2, "thinking", "z", 2, day(5)))
    runs = [(100, 1, None, day(2)), (200, 2, None, day(3))]
    return (spark.createDataFrame(parents, PARENTS), spark.createDataFrame(runs, RUNS),
            spark.createDataFrame(messages, MESSAGES))


def test_two_loads_then_staging(spark, tmp_path):
    paths = incremental.LoadPaths(*[str(tmp_path / n) for n in ("marks", "c", "r", "m")])
    assert incremental.load_changes(spark, *source(spark), paths).startswith("2026-01-03")
    assert incremental.load_changes(spark, *source(spark), paths).startswith("2026-01-03")
    assert spark.read.parquet(paths.messages).count() == 2
    assert incremental.load_changes(spark, *source(spark, True), paths).startswith("2026-01-05")
    raw = spark.read.parquet(paths.messages)
    # The touched conversation landed again as a whole; the system message never did.
    assert raw.count() == 4 and set(dict(raw.drop("_load").dtypes).values()) == {"string"}
    assert sorted(r["_load"] for r in raw.collect()) == [1, 1, 3, 3]
    messages = staging.stg_messages(raw)
    assert sorted(r["id"] for r in messages.collect()) == [10, 20, 22]
    titles = staging.stg_conversations(spark.read.parquet(paths.conversations))
    assert {r["id"]: r["title"] for r in titles.collect()} == {1: "a", 2: "b2"}
    assert spark.read.parquet(paths.runs).count() == 3


def test_failed_load_leaves_the_mark(spark, tmp_path):
    paths = incremental.LoadPaths(*[str(tmp_path / n) for n in ("marks", "c", "r", "m")])
    parents, runs, messages = source(spark)
    broken = messages.withColumn("content", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        incremental.load_changes(spark, parents, runs, broken, paths)
    assert tables.read_mark(spark, paths.marks, "conversations", None) is None
    incremental.load_changes(spark, parents, runs, messages, paths)
    assert staging.stg_conversations(spark.read.parquet(paths.conversations)).count() == 2


def test_rows_at_the_mark_are_not_read_again(spark):
    parents, _, _ = source(spark)
    assert incremental.changed_since(parents, "2026-01-03 00:00:00").count() == 0
    empty = incremental.next_mark(parents.limit(0), "2026-01-03 00:00:00").first()["mark"]
    assert empty == day(3)


def test_rows_committed_behind_the_mark_are_found_and_landed(spark, tmp_path):
    """A late commit, a change that didn't move ``updated_at``, and nothing else; then all is equal."""
    path = str(tmp_path / "c")
    rows = [(i, f"t{i}", day(1 + i % 9)) for i in range(5, 3000, 3)]
    source = spark.createDataFrame(rows, PARENTS)
    incremental.land(source.filter("id <> 1001 AND id <> 2999"), path, 1)
    changed = source.withColumn("title", F.expr("CASE WHEN id = 500 THEN 'new' ELSE title END"))

    def behind(frame, pieces):
        landed = incremental.newest_landed(spark.read.parquet(path), staging.CONVERSATION_CHANGE)
        return incremental.rows_behind_mark(frame, landed, pieces=pieces)

    for pieces in (1, 7, 1000):
        found = behind(changed, pieces)
        assert found.schema == changed.schema
        assert sorted(r["id"] for r in found.collect()) == [500, 1001] + [2999] * (2999 % 3 == 2)
    incremental.land(behind(changed, 100), path, 2)
    assert behind(changed, 100).count() == 0 and behind(changed.limit(0), 5).count() == 0


def test_publish_keeps_the_old_version_until_the_pointer_moves(spark, tmp_path):
    base = str(tmp_path / "t")
    schema = "id int, v string"
    assert tables.current(spark, base, schema).count() == 0
    tables.publish(spark.createDataFrame([(1, "a")], schema), base)
    before = tables.current(spark, base, schema)
    tables.publish(before.unionByName(spark.createDataFrame([(2, "b")], schema)), base)
    assert before.count() == 1
    assert tables.current(spark, base, schema).count() == 2


def test_a_writer_that_was_overtaken_is_told_so(spark, tmp_path):
    base, schema = str(tmp_path / "t"), "id int, v string"
    step, empty = tables.current_step(spark, base, schema)
    first, second = (spark.createDataFrame([(n, "x")], schema) for n in (1, 2))
    tables.publish(empty.unionByName(first), base, after=step)
    with pytest.raises(tables.Moved):
        tables.publish(empty.unionByName(second), base, after=step)
    assert [r["id"] for r in tables.current(spark, base, schema).collect()] == [1]


def test_of_two_writers_at_once_one_wins_and_the_other_is_told(spark, tmp_path):
    path, together = str(tmp_path / "marks"), threading.Barrier(2)

    def write(who):
        told = []
        for step in range(100):
            together.wait()
            try:
                told.append(tables.write_mark(spark, path, "m", f"{who}-{step}", after=step))
            except tables.Moved:
                told.append(None)
            together.wait()
        return told

    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(write, "ab")
    for step in range(100):
        assert sorted([a[step] or 0, b[step] or 0]) == [0, step + 1]
    won = "a" if a[-1] else "b"
    assert tables.read_step(spark, path, "m", None) == (100, f"{won}-99")
    assert sorted(os.listdir(f"{path}/m"), key=int) == [str(n) for n in range(1, 101)]


def test_numbers_taken_at_once_differ(spark, tmp_path):
    path = str(tmp_path / "marks")
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda _: tables.take_number(spark, path, "load"), range(40)))
    assert sorted(taken) == list(range(1, 41))


def test_numbers_are_taken_once(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert [tables.take_number(spark, path, "load") for _ in range(3)] == [1, 2, 3]
    with pytest.raises(tables.Moved):
        tables.write_mark(spark, path, "load", "x", after=1)


RUN = "id string, conversation_id string, cost_usd string, duration_ms string, completed_at string"


def test_a_finished_run_replaces_the_unfinished_one(spark):
    """Without load numbers a missing end is the older copy; with them the later load wins."""
    raw = spark.createDataFrame(
        [("1", "9", None, None, None), ("1", "9", "2.5", "700", "2026-01-02 00:00:00")], RUN)
    for rows in (raw, raw.orderBy(F.desc("completed_at"))):
        assert [r["duration_ms"] for r in staging.stg_runs(rows).collect()] == [700]
        typed = staging.typed(rows, staging.RUNS)
        assert signals.run_costs(typed, dedupe=True).first()["avg_run_duration_ms"] == 700.0
    loads = spark.createDataFrame(
        [("1", "9", "2.5", "700", "2026-01-02 00:00:00", 1), ("1", "9", "3.5", "800", None, 2)],
        RUN + ", _load bigint")
    kept = staging.stg_runs(loads)
    assert [r["duration_ms"] for r in kept.collect()] == [800] and "_load" not in kept.columns


def test_an_edited_message_keeps_its_last_load(spark):
    schema = "id string, conversation_id string, message_type string, content string, " \
        "sequence_number string, created_at string, _load bigint"
    for texts in (("a", "Quality Score: 3"), ("Quality Score: 3", "a")):
        raw = spark.createDataFrame(
            [("1", "9", "tool_result", text, "1", "2026-01-01 00:00:00", load)
             for load, text in enumerate(texts)], schema)
        kept = staging.stg_messages(raw).collect()
        assert [r["content"] for r in kept] == [texts[1]]
        found = signals.message_signals(staging.typed(raw, staging.MESSAGES), dedupe=True).first()
        assert found["code_review_count"] == (texts[1] != "a")


def test_an_edited_conversation_keeps_its_last_load(spark):
    raw = spark.createDataFrame(
        [("1", "new", "2026-01-01 00:00:00", 2), ("1", "old", "2026-01-03 00:00:00", 1)],
        "id string, title string, updated_at string, _load bigint")
    assert [r["title"] for r in staging.stg_conversations(raw).collect()] == ["new"]


def test_ledger_columns_added_later_are_null_on_old_rows(spark, tmp_path):
    path = str(tmp_path / "ledger")
    old = spark.createDataFrame([(1, "v1")], "conversation_id bigint, prompt_version string")
    new = spark.createDataFrame(
        [(2, "v2", True)],
        "conversation_id bigint, prompt_version string, flag_dev_acknowledged boolean")
    tables.append_ledger(old, path)
    tables.append_ledger(new, path)
    rows = {r["conversation_id"]: r["flag_dev_acknowledged"]
            for r in tables.read_ledger(spark, path).collect()}
    assert rows == {1: None, 2: True}


def ledger_row(conversation, at, version="v1", outcome="success_clean"):
    return (conversation, outcome, version, "m", "consultation", day(at))


LEDGER = ("conversation_id bigint, outcome string, prompt_version string, model string, "
          "conversation_type string, classified_at timestamp_ntz")


@pytest.mark.parametrize("keys", [outcomes.FACT_KEYS, outcomes.HISTORY_KEYS])
def test_folded_outcomes_equal_the_whole_ledger(spark, tmp_path, keys):
    """Also where a later load brings older rows, ties, and rows without a version or a time."""
    rng, ledger, base = random.Random(4), str(tmp_path / "ledger"), str(tmp_path / "newest")
    everything = []
    for load in range(4):
        rows = [ledger_row(rng.randint(0, 30), rng.randint(1, 9), rng.choice(["v1", "v2", None]),
                           rng.choice("ab")) for _ in range(40)]
        rows += [(*row[:5], None) for row in rows[:2]]
        everything += rows
        frame = spark.createDataFrame(rows, LEDGER)
        tables.append_ledger(frame, ledger, by_version=False, load=load)
        got = outcomes.fold_newest(spark, ledger, base, keys, frame.schema, buckets=4)
        whole = outcomes.with_lineage(spark.createDataFrame(everything, LEDGER))
        if len(keys) > 1:
            whole = whole.filter("prompt_version IS NOT NULL")
        want = latest_by(whole, keys, ["classified_at"]).select(*got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        # Files of loads that are folded are not opened any more.
        for file in os.listdir(f"{ledger}/_load={load}"):
            if file.startswith("part-"):
                (tmp_path / "ledger" / f"_load={load}" / f".{file}.crc").unlink()
                (tmp_path / "ledger" / f"_load={load}" / file).write_bytes(b"spoilt")
    again = outcomes.fold_newest(spark, ledger, base, keys, frame.schema, buckets=4)
    assert again.count() == got.count()


def test_upsert_last_of_the_batch_wins(spark):
    schema = "k int, v string, line int"
    target = spark.createDataFrame([(1, "old"), (2, "kept")], "k int, v string")
    batch = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (3, "new", 3)], schema)
    merged = upsert(target, batch, ["k"], ["line"])
    rows = sorted((r["k"], r["v"]) for r in merged.collect())
    assert rows == [(1, "last"), (2, "kept"), (3, "new")]
    assert sorted((r["k"], r["v"]) for r in upsert(merged, batch, ["k"], ["line"]).collect()) == rows


TABLE = "k int, v string, at int"


def test_keyed_table_equals_a_dictionary(spark, tmp_path):
    path, rng, want = str(tmp_path / "t"), random.Random(8), {}
    assert keyed.read(spark, path, TABLE).count() == 0
    for load in range(5):
        rows = [(rng.choice([None, *range(60)]), f"{load}-{i}", i) for i in range(40)]
        keyed.merge(spark.createDataFrame(rows, "k int, v string, at int").repartition(3), path, TABLE,
                    ["k"], [F.desc("at")], buckets=16 + load)
        want.update({k: (v, at) for k, v, at in rows})
        got = {r["k"]: (r["v"], r["at"]) for r in keyed.read(spark, path, TABLE).collect()}
        assert got == want
    assert keyed.merge(spark.createDataFrame([], TABLE), path, TABLE, ["k"], []) == []
    # Without precedence of the batch an older row changes nothing.
    key = next(iter(want))
    keyed.merge(spark.createDataFrame([(key, "old", -1)], TABLE), path, TABLE, ["k"], [F.desc("at")],
                batch_wins=False)
    assert {r["k"]: r["v"] for r in keyed.read(spark, path, TABLE).collect()}[key] == want[key][0]


def test_a_load_rewrites_only_the_buckets_that_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(5000).selectExpr("CAST(id AS INT) k", "'a' v", "0 at")
    assert len(keyed.merge(first, path, TABLE, ["k"], [])) == 64

    def state():
        return {(d, f): os.stat(f"{path}/{d}/{f}").st_mtime_ns
                for d in os.listdir(path) if d.startswith("_bucket=") for f in os.listdir(f"{path}/{d}")}

    before = state()
    batch = spark.range(10).selectExpr("CAST(id * 7 AS INT) k", "'b' v", "1 at")
    touched = keyed.merge(batch, path, TABLE, ["k"], [])
    after = state()
    assert len(touched) <= 10
    changed = {d for d, _ in before.items() ^ after.items() for d in d[:1]}
    assert changed == {f"_bucket={b}" for b in touched}
    assert keyed.read(spark, path, TABLE).groupBy("v").count().orderBy("v").collect() == [("a", 4990), ("b", 10)]


def record(number, **changes):
    return json.dumps({
        "id": f"http://arxiv.org/abs/{number}v1//", "title": f"t{number}", "summary": "s",
        "published": "2024-05-06T07:08:09+02:00", "authors": ["A", "B"], "categories": [], **changes})


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_jsonl_lines(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a.jsonl", record(1), "", "  ", "broken{", json.dumps({"id": "x"}),
          record(2, published="yesterday"), record(3, title=""))
    decoded = papers.decode_lines(papers.read_lines(spark, str(folder)))
    problems = sorted(r["problem"] or "" for r in decoded.collect())
    assert problems == ["", "", "bad date", "broken json", "missing field"]
    rows = {r["paper_id"]: r for r in papers.papers_from(decoded, "2026-01-01").collect()}
    assert set(rows) == {"1v1", "3v1"}
    # The zone is dropped, not applied.
    assert rows["1v1"]["published_date"] == datetime.datetime(2024, 5, 6, 7, 8, 9)
    assert rows["1v1"]["authors"] == ["A", "B"] and rows["1v1"]["categories"] == []


def test_paper_loads_move_the_marker(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path / "papers")
    write(folder, "f1.jsonl", record(1), record(2))
    write(folder, "f2.jsonl", record(1, title="newer"), record(1, title="newest"))
    write(folder, "notes.txt", "ignored")
    summary = papers.load_new_files(spark, str(folder), base, "2026-01-01").first()
    assert (summary["files_processed"], summary["rows_loaded"]) == (2, 4)

    def titles():
        rows = papers.current_papers(spark, f"{base}/papers").collect()
        return {r["paper_id"]: r["title"] for r in rows}

    assert titles() == {"1v1": "newest", "2v1": "t2"}
    # A late file under an earlier name is skipped by the marker.
    write(folder, "f0.jsonl", record(9))
    write(folder, "f3.jsonl", record(2, title="again"))
    papers.load_new_files(spark, str(folder), base, "2026-01-02")
    assert titles() == {"1v1": "newest", "2v1": "again"}
    # A file without a single good line does not move it.
    write(folder, "f4.jsonl", "broken{")
    papers.load_new_files(spark, str(folder), base, "2026-01-03")
    assert tables.read_mark(spark, f"{base}/_marks", "papers", None) == "f3.jsonl"


FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
  <title>results</title>
  <entry>
    <id>http://arxiv.org/abs/1</id>
    <title>  A &amp; B
    title </title>
    <summary>one</summary>
    <published>2024-01-01T00:00:00Z</published>
    <author><name>Ada</name></author><author><name>Bob</name></author>
    <category term="cs.LG"/><category term="cs.DB"/>
  </entry>
  <entry>
    <id>http://arxiv.org/abs/2</id>
    <title></title>
    <published>2024-01-02T00:00:00Z</published>
    <author><name>Eve</name></author>
    <category term="cs.LG"/>
  </entry>
</feed>
"""


def test_atom_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    rows = papers.read_feed(spark, str(tmp_path / "feed.xml")).orderBy("id").collect()
    assert [r["title"].split() for r in rows] == [["A", "&", "B", "title"], []]
    assert rows[0]["title"][0] == "A" and rows[0]["title"][-1] == "e"
    assert [r["summary"] for r in rows] == ["one", ""]
    assert [r["authors"] for r in rows] == [["Ada", "Bob"], ["Eve"]]
    assert [r["categories"] for r in rows] == [["cs.LG", "cs.DB"], ["cs.LG"]]


def test_records_round_trip_through_jsonl(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    rows = papers.read_feed(spark, str(tmp_path / "feed.xml"))
    tables.write_jsonl(rows, str(tmp_path / "out"))
    back = spark.read.schema(papers.RECORD_SCHEMA).json(str(tmp_path / "out"))
    assert sorted(back.collect()) == sorted(rows.collect())


def test_topics_keep_the_first_arrival(spark):
    first = spark.createDataFrame([("x", "a", 1)], "id string, title string, place int")
    second = spark.createDataFrame([("x", "b", 0), ("y", "c", 1)], first.schema)
    rows = papers.keep_first(papers.union_topics([first, second]), ["topic", "place"])
    assert sorted((r["id"], r["title"]) for r in rows.collect()) == [("x", "a"), ("y", "c")]
