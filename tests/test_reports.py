"""Report rules, checks and plan shapes."""

import datetime
import io
import os
from contextlib import redirect_stdout
from functools import reduce

import pytest
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.catalog import fixtures as X
from talkmeter.catalog.queries import REGISTRY
from talkmeter.functions import labels, text
from talkmeter.operators import checks, histogram, queue
from talkmeter.plans import marts, reports, telemetry

FACT = (
    "conversation_id bigint, conversation_type string, outcome string, total_cost_usd "
    "decimal(10,4), run_count bigint, conversation_created_at timestamp_ntz, reasoning string, "
    "flag_dev_acknowledged boolean, " + ", ".join(f"{d} int" for d in V.RUBRIC)
)


def fact(spark, rows):
    """Rows of (id, type, outcome, cost, created_at)."""
    from decimal import Decimal

    return spark.createDataFrame(
        [(c, t, o, None if cost is None else Decimal(str(cost)), 1, at, f"r{c}", c % 2 == 0, 1, 2, 3, None)
         for c, t, o, cost, at in rows], FACT)


def days(*numbers):
    return [datetime.datetime(2026, 1, 5) + datetime.timedelta(days=n) for n in numbers]


def evaluate(spark, function, value):
    column = F.lit(value).cast("string")
    return spark.range(1).select(function(column)).first()[0]


@pytest.mark.parametrize(
    "outcome, tier, gate",
    [
        ("success_clean", "success", "allow"),
        ("success_with_correction", "success", "allow"),
        ("success_iterative", "success", "allow"),
        ("inconclusive", "inconclusive", "block"),
        ("failure_wrong_direction", "failure", "block_review"),
        # In no list of the gate, so it blocks.
        ("failure_schema_gap", "failure", "block"),
        ("anything_new", "failure", "block"),
        (None, "failure", "block"),
    ],
)
def test_tiers_and_gate(spark, outcome, tier, gate):
    assert evaluate(spark, labels.outcome_tier, outcome) == tier
    assert evaluate(spark, labels.gate_decision, outcome) == gate


@pytest.mark.parametrize(
    "rate, base, band",
    [(0.9, 1.0, "stable"), (0.89, 1.0, "moderate"), (0.75, 1.0, "significant"),
     (0.951, 0.83, "moderate"), (None, 1.0, "unknown"), (1.0, None, "unknown")],
)
def test_bands(spark, rate, base, band):
    column = labels.drift_band(F.lit(rate).cast("double"), F.lit(base).cast("double"))
    assert spark.range(1).select(column).first()[0] == band


@pytest.mark.parametrize(
    "content, pattern, hit",
    [("a SCHEMA_prefetch_tool", V.PREFETCH_CALL, True), ("schemaXprefetchYtool", V.PREFETCH_CALL, True),
     ("schemaprefetchtool", V.PREFETCH_CALL, False), ("USE\n the Table", "%use%table%", True),
     ("table use", "%use%table%", False), ("a%b", "%a\\%b%", True)],
)
def test_matches_is_ilike(spark, content, pattern, hit):
    lowered = F.lower(F.lit(content))
    row = spark.range(1).select(text.matches(lowered, pattern), F.lit(content).ilike(pattern)).first()
    assert row[0] == row[1] == hit


def test_cost_split_has_no_anomalous_bucket_on_the_fact(spark, sf_dir):
    rows = REGISTRY["cost_by_period"](spark, sf_dir)
    assert [r["bucket"] for r in rows.select("bucket").distinct().collect()] == ["normal"]


def test_short_span_defaults_to_months(spark):
    short = fact(spark, [(i, "generation", "success_clean", 1, at) for i, at in enumerate(days(0, 119))])
    long = fact(spark, [(i, "generation", "success_clean", 1, at) for i, at in enumerate(days(1, 122))])
    first = {r["period"] for r in reports.period_bin_sizes(short).collect()}
    assert first == {datetime.datetime(2026, 1, 1), datetime.datetime(2026, 5, 1)}
    weeks = {r["period"] for r in reports.period_bin_sizes(long).collect()}
    assert weeks == {datetime.datetime(2026, 1, 5), datetime.datetime(2026, 5, 4)}
    assert all(r["is_sparse"] for r in reports.period_bin_sizes(long).collect())


def test_time_axis_falls_back(spark):
    columns = fact(spark, []).drop("conversation_created_at")
    assert reports.time_axis(columns) == (None, False)
    assert reports.time_axis(columns.withColumn("classified_at", F.lit(None))) == ("classified_at", True)
    with pytest.raises(ValueError, match="no time column"):
        reports.period_bin_sizes(columns)
    assert reports.has_costs(columns) and not reports.has_costs(columns.drop("total_cost_usd"))


def test_recent_shares(spark):
    rows = [(i, "generation", "success_clean", 1, at) for i, at in enumerate(days(*range(10)))]
    rows += [(99, "generation", "inconclusive", 1, None)]
    got = {r["outcome_tier"]: r for r in reports.tier_drift_recent(fact(spark, rows), 2).collect()}
    # A row without a time counts as the newest.
    assert got["inconclusive"]["recent_share"] == 0.5
    assert got["success"]["delta"] == pytest.approx(0.5 - 10 / 11)
    assert "failure" not in got


def test_outliers(spark):
    rows = [(i, "generation", "success_clean", 1, None) for i in range(20)]
    rows += [(50, "generation", "success_clean", 100, None)]
    found = reports.cost_outliers(fact(spark, rows)).collect()
    assert [r["conversation_id"] for r in found] == [50]
    stats = reports.cost_outlier_stats(fact(spark, rows)).first()
    assert stats["above_threshold"] == 1 and stats["mean_cost"] == pytest.approx(120 / 21)


def test_reports_on_an_empty_fact(spark):
    empty = fact(spark, [])
    assert reports.tier_rates(empty).first()["classified"] == 0
    assert [r["count"] for r in reports.gate_counts(empty).collect()] == [0, 0, 0]
    assert reports.cost_outliers(empty).count() == 0
    assert reports.tier_drift_recent(empty).count() == 0
    assert reports.outcome_mix_by_period(empty).count() == 0
    assert reports.worst_concentration(empty).count() == 0


def test_explorer(spark):
    rows = fact(spark, [(7, "generation", "success_clean", 1, None), (8, "diagnostic", "inconclusive", 1, None)])
    found = reports.explorer_filter(rows, ["success_clean"], ["generation"], " 7 ,, 8")
    assert [r["conversation_id"] for r in found.collect()] == [7]
    missing = reports.explorer_unmatched_ids(rows, " 7 ,, 8, x", ["success_clean"])
    assert sorted(r["conversation_id"] for r in missing.collect()) == ["8", "x"]
    assert reports.explorer_filter(rows).count() == 2


def test_outcome_distribution_names_missing_outcomes(spark):
    rows = fact(spark, [(1, "generation", None, 1, None), (2, "generation", None, 1, None),
                        (3, "generation", "success_clean", 1, None)])
    got = [(r["outcome"], r["count"]) for r in reports.outcome_distribution(rows).collect()]
    assert got == [("error", 2), ("success_clean", 1)]


def test_nulls_of_the_folded_key_need_no_count_per_key(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "b"), (2, "c")], "k int, v string")
    report = checks.table_report("t", rows, ["k"], ["k", "v"])
    assert {(r["check"], r["column"]): r["failing"] for r in report.collect()} == {
        ("unique", "k"): 1, ("not_null", "k"): 2, ("not_null", "v"): 1,
    }
    plan = io.StringIO()
    with redirect_stdout(plan):
        report.explain(True)
    assert "failing_0" in plan.getvalue() and "failing_1" not in plan.getvalue()
    empty = checks.table_report("t", rows.limit(0), ["k"], ["k"]).collect()
    assert sorted((r["check"], r["failing"]) for r in empty) == [("not_null", 0), ("unique", 0)]


def test_bucketed_marts_are_sorted_once(spark, tmp_path):
    """Buckets hold rows in order of the key, without a sort that the writer asks for."""
    from talkmeter.sources import tables

    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), F.col("id").alias("v"))
    before = spark.conf.get(tables.WRITERS)
    tables.publish(rows, str(tmp_path), bucket_by="k", buckets=4)
    assert spark.conf.get(tables.WRITERS) == before
    folder = next(name for name in os.listdir(tmp_path) if name.startswith("version=1"))
    files = [f"{tmp_path}/{folder}/{f}" for f in os.listdir(tmp_path / folder) if f.endswith(".parquet")]
    assert len(files) == 4
    for file in files:
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)
    details = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {tables.table_name(folder)}").collect()}
    assert details["Bucket Columns"] == "[`k`]" and details.get("Sort Columns", "[]") == "[]"
    assert sorted(map(tuple, tables.current(spark, str(tmp_path), rows.schema).collect())) == sorted(
        map(tuple, rows.collect())
    )


def test_checks_find_what_is_wrong(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, None), (2, "z"), (None, "a"), (None, "b")], "k int, v string")
    assert [(r["key"], r["rows"]) for r in checks.duplicate_keys(rows, "k").collect()] == [("1", 2)]
    assert {r["column"]: r["failing"] for r in checks.null_counts(rows, ["k", "v"]).collect()} == {
        "k": 2, "v": 1}
    found = checks.unexpected_values(rows, "v", ["a", "b"])
    assert [(r["value"], r["rows"]) for r in found.collect()] == [("z", 1)]
    report = checks.table_report("t", rows, ["k"], ["v"], {"v": ["a", "b"]})
    assert {(r["check"], r["column"]): r["failing"] for r in report.collect()} == {
        ("unique", "k"): 1, ("not_null", "v"): 1, ("accepted_values", "v"): 1}


def test_quantile_edges(spark):
    """One value per case: first bucket, inside a bucket, beyond the last bound."""
    rows = spark.createDataFrame(
        [("a", 0.5), ("b", 15.0), ("c", 500.0), ("d", 1.0), ("d", 500.0)], "g string, v double")
    wide = histogram.wide_histogram(rows, ["g"], F.col("v"), V.LATENCY_BUCKETS)
    got = {r["g"]: r["p50"] for r in
           wide.select("g", histogram.quantile(0.5, V.LATENCY_BUCKETS).alias("p50")).collect()}
    assert got == {"a": 0.5, "b": 15.0, "c": 120.0, "d": 1.0}


def test_counters_skip_errors_and_false_flags(spark):
    schema = ("conversation_type string, outcome string, error_type string, retry_count int, "
              "flag_dev_acknowledged boolean")
    rows = [("generation", "success_clean", None, 0, True), ("generation", None, None, 1, False),
            ("generation", None, "timeout", 2, None)]
    got = {(r["metric"], r["label_1"], r["label_2"]): r["value"]
           for r in telemetry.counters(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        ("outcomes", "generation", "success_clean"): 1, ("outcomes", "generation", "unknown"): 1,
        ("errors", "generation", "timeout"): 1, ("retries", "generation", None): 3,
        ("dev_acknowledged", "success_clean", None): 1}


# --- plan shapes ---------------------------------------------------------------------


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_signals_scan_the_messages_once_and_only_what_they_need(spark, sf_dir):
    from talkmeter.plans import signals

    plan = plan_of(signals.message_signals(X.messages(spark, sf_dir)))
    assert plan.count("Location: ") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    assert plan.count("Arguments: hashpartitioning") == 1 and "SortAggregate" not in plan


def test_raw_signals_shuffle_no_text(spark, sf_dir):
    from talkmeter.plans import signals

    raw = X.repeated(X.messages(spark, sf_dir), "conversation_id")
    plan = plan_of(signals.message_signals(raw, dedupe=True))
    assert "WindowGroupLimit" in plan
    for block in plan.split("\n\n"):
        if "Exchange" in block.split("\n")[0] and "Input" in block:
            assert "content#" not in block and "lowered#" not in block


def test_incremental_read_pushes_the_mark(spark, sf_dir):
    from talkmeter.sources import incremental

    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS id", "o_orderdate AS updated_at")
    assert "GreaterThan(o_orderdate" in plan_of(incremental.changed_since(rows, "1998-01-01 00:00:00"))


def test_latest_rows_are_pruned_before_the_shuffle(spark, sf_dir):
    plan = plan_of(REGISTRY["latest_outcomes"](spark, sf_dir))
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_small_queue_is_sent_to_the_scan(spark, sf_dir):
    messages = X.dialogues(spark, sf_dir)
    ids = spark.range(3).select(F.col("id").alias("conversation_id"))
    small = queue.only_queued(messages, ids)
    assert "BroadcastHashJoin" in plan_of(small)
    # A queue above Spark's own limit is joined by key, by the same plan.
    many = spark.range(5_000_000).select(F.col("id").alias("conversation_id"))
    assert "SortMergeJoin" in plan_of(queue.only_queued(messages, many))
    assert small.count() == messages.filter("conversation_id < 3").count()


def test_no_query_but_the_judge_runs_python(spark, sf_dir):
    """Native expressions throughout; also no cross join anywhere."""
    for name in ("fct_outcomes", "transcripts_capped", "fct_concept_drift", "papers_upsert",
                 "cost_outliers", "tier_drift_recent", "latency_quantiles", "eval_units"):
        plan = plan_of(REGISTRY[name](spark, sf_dir))
        assert "Python" not in plan and "InPandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize("width, seconds", [("1 minute", 60), ("5 minutes", 300), ("10 minutes", 600)])
def test_error_rate_follows_the_width(spark, width, seconds):
    start = datetime.datetime(2024, 1, 1, 12, 0)
    rows = [(start + datetime.timedelta(seconds=6 * i), "a", "timeout") for i in range(10)]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, conversation_type string, error_type string")
    found = telemetry.error_rate(events, width).collect()
    assert [(r["errors"], r["errors_per_second"]) for r in found] == [(10, 10 / seconds)]


def test_drift_reads_the_ledger_once(spark, sf_dir):
    plan = plan_of(REGISTRY["fct_concept_drift"](spark, sf_dir))
    assert plan.count("Location: ") == 1


def test_registry_folds_by_hash(spark, sf_dir):
    assert "SortAggregate" not in plan_of(REGISTRY["dim_judge_version"](spark, sf_dir))


def test_eval_units_move_no_text_in_windows(spark, sf_dir):
    plan = plan_of(REGISTRY["eval_units"](spark, sf_dir))
    assert "Window" not in plan and plan.count("lineitem.parquet") == 1


def test_reports_read_marts_and_equal_the_direct_form(spark, sf_dir, tmp_path):
    from talkmeter.catalog.queries import fact, standing_marts

    built = standing_marts(spark, sf_dir)
    assert set(built) == set(marts.BUILDERS)
    direct, mart = fact(spark, sf_dir), built["fct_outcomes"]
    assert mart.schema.simpleString() == direct.schema.simpleString()
    assert mart.exceptAll(direct).count() == 0 and direct.exceptAll(mart).count() == 0
    drift = REGISTRY["fct_concept_drift"](spark, sf_dir)
    assert built["fct_concept_drift"].exceptAll(drift).count() == 0
    assert "lineitem" not in plan_of(REGISTRY["tier_drift_recent"](spark, sf_dir))


def test_fact_and_history_join_as_they_lie(spark, sf_dir):
    """Bucketed by conversation, the marts need no exchange, neither when built nor when read."""
    from talkmeter.catalog.queries import mart_inputs, standing_marts

    built = standing_marts(spark, sf_dir)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = marts.BUILDERS["fct_outcomes"](mart_inputs(spark, sf_dir), built)
        counts = built["outcome_history"].groupBy("conversation_id").count()
        for rows in (fact, built["fct_outcomes"].join(counts, "conversation_id", "left")):
            rows.count()
            plan = plan_of(rows)
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_search_by_id_opens_only_the_buckets_of_its_ids(spark, tmp_path):
    from talkmeter.sources import tables

    rows = spark.range(20_000).selectExpr(
        "id AS conversation_id", "'consultation' AS conversation_type", "'success_clean' AS outcome",
        "CAST(id AS STRING) AS reasoning")
    tables.publish(rows, str(tmp_path), bucket_by="conversation_id", buckets=64)
    mart = tables.current(spark, str(tmp_path), rows.schema)
    found = reports.explorer_filter(mart, id_text="7, 0123, +5, 19999, x, 7.0, 99999999999999999999999")
    assert sorted(r["reasoning"] for r in found.collect()) == ["19999", "7"]
    plan = plan_of(found)
    assert "In(conversation_id" in plan[plan.index("PushedFilters"):].split("\n")[0]
    assert reports.explorer_filter(mart, id_text="nope").count() == 0
    gone = reports.explorer_unmatched_ids(mart, "7, 07, nope")
    assert sorted(r["conversation_id"] for r in gone.collect()) == ["07", "nope"]
    # Spoil all files but the two that hold the ids: they are not opened.
    own = {r[0].rsplit("/", 1)[1] for r in found.select(F.input_file_name()).collect()}
    files = [f for f in tmp_path.glob("version=*/part-*") if f.name not in own]
    assert len(own) == 2 and len(files) == 62
    for file in files:
        (file.parent / f".{file.name}.crc").unlink()
        file.write_bytes(b"spoilt")
    again = reports.explorer_filter(mart, id_text="7, 19999")
    assert sorted(r["reasoning"] for r in again.collect()) == ["19999", "7"]


def test_sketched_windows_of_many_latencies_have_the_right_rank(spark):
    from talkmeter.plans import telemetry

    events = spark.range(59_400).selectExpr(
        "timestamp_seconds(id % 900) AS ts", "'consultation' AS conversation_type",
        "CAST(pow(pmod(id * 7919, 59400), 1.5) AS DOUBLE) AS latency_s")
    stored = telemetry.latency_sketches(events)
    assert stored.selectExpr("max(length(sketch)) n").first()["n"] < 20_000
    quantiles = telemetry.sketched_quantiles(stored).cache()
    assert quantiles.selectExpr("max(latencies) n").first()["n"] == 19_800
    checked = telemetry.sketched_ranks(events, quantiles).collect()
    assert len(checked) == 19 and all(r["p50_in_bound"] and r["p95_in_bound"] for r in checked)


def test_version_parts_add_up_in_any_loads(spark, sf_dir):
    """Bitmaps of repeated conversations, over types and loads, count each once; parts may be merged."""
    from talkmeter.plans import outcomes

    ledger = X.ledger(spark, sf_dir)
    loads = [ledger.filter(f"pmod(hash(classified_at), 4) = {n}") for n in range(4)] + [ledger.limit(50)]
    parts = reduce(lambda a, b: a.unionByName(b), [outcomes.version_parts(part) for part in loads])
    whole = outcomes.judge_versions(reduce(lambda a, b: a.unionByName(b), loads))
    for form in (parts, outcomes.merged_parts(parts, "classified_as_type")):
        got = outcomes.judge_versions_of(form)
        assert sorted(map(str, got.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    odd = spark.createDataFrame(
        [(None, "v", None), (-5, "v", "e"), (-5, "v", None), (2**40, "v", None), (2**40, "w", None)],
        "conversation_id bigint, prompt_version string, error string"
    ).selectExpr("*", "'m' AS model", "'h' AS prompt_hash", "'t' AS conversation_type",
                 "TIMESTAMP_NTZ'2026-01-01' AS classified_at")
    got = outcomes.judge_versions_of(outcomes.version_parts(odd)).select(outcomes.judge_versions(odd).columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, outcomes.judge_versions(odd).collect()))


def test_a_bucketed_version_opens_in_a_session_that_did_not_write_it(spark, tmp_path):
    from talkmeter.sources import tables

    base = str(tmp_path / "t")
    rows = spark.range(100).selectExpr("id AS conversation_id", "CAST(id AS STRING) AS v")
    tables.publish(rows, base, bucket_by="conversation_id", buckets=4)
    mark = tables.read_mark(spark, f"{base}/_pointer", "version", None)
    spark.sql(f"DROP TABLE {tables.table_name(mark.split('|')[0])}")  # external: the files stay
    other = tables.current(spark, base, rows.schema)
    assert other.dtypes == rows.dtypes and sorted(other.collect()) == sorted(rows.collect())
    assert "Exchange" not in plan_of(other.groupBy("conversation_id").count())


def test_short_conversations_shuffle_their_text_once(spark, sf_dir):
    """Also where nothing is broadcast: one exchange by conversation carries the lines."""
    from talkmeter.operators import transcripts

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = transcripts.lines(X.dialogues(spark, sf_dir), V.CONSULTATION_LIMITS)
        ids = spark.range(5).select(F.col("id").alias("conversation_id"))
        plan = plan_of(transcripts.short_transcripts(rows, ids))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    exchanges = [b for b in plan.split("\n\n") if b.lstrip().startswith("(") and ") Exchange" in b.split("\n")[0]]
    assert sum("line#" in b for b in exchanges) == 1


def test_wide_marts_are_not_fused_and_built_when_asked_for(spark, sf_dir, tmp_path):
    """Rows of over forty columns run as operators side by side; a report builds its own marts only."""
    from talkmeter.catalog.queries import fct_outcomes_mart, standing_marts

    tables_of = str(tmp_path / "sf")
    os.symlink(sf_dir, tables_of)
    fact = fct_outcomes_mart(spark, tables_of)
    assert len(fact.columns) > 40 and "* ColumnarToRow" not in plan_of(fact)
    assert set(standing_marts(spark, tables_of, "fct_outcomes")) == {
        "conversation_types", "latest_outcomes", "fct_outcomes",
    }
    direct = REGISTRY["fct_outcomes"](spark, sf_dir)
    assert fact.exceptAll(direct).count() == 0 and direct.exceptAll(fact).count() == 0


def test_eval_rows_search_a_text_once(spark, sf_dir):
    """No filter repeats the searches; each text is lower-cased in one place of the plan."""
    from talkmeter.plans import extensions

    rows = extensions.eval_rows(X.messages(spark, sf_dir))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
    kinds = {"tool_call", "tool_result", "user"}
    wanted = X.messages(spark, sf_dir).filter(F.col("message_type").isin(kinds))
    assert rows.count() == wanted.filter("message_type = 'user' OR tool_use_id IS NOT NULL").count()
