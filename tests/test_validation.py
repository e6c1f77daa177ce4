"""Validation ledger, drift bands and the gate on golden rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.catalog import fixtures as X
from talkmeter.functions import labels
from talkmeter.operators import checks
from talkmeter.plans import validation
from talkmeter.sources import tables

LAST_RUN = datetime.datetime(2026, 6, 1)
# The human labels (fixed values).
SEED = """conversation_id,expected_outcome,expected_question_understanding,expected_resource_exhaustion,expected_answer_grounding,expected_actionability,labeler,labeled_at,label_cohort,is_blind,difficulty
643,inconclusive,,,,,expert,2026-06-17,cohort_2026_06,false,easy
691,success_clean,,,,,expert,2026-06-17,cohort_2026_06,false,easy
701,failure_abandoned,,,,,expert,2026-06-17,cohort_2026_06,false,medium
530,success_clean,,,,,expert,2026-06-17,cohort_2026_06,false,easy
225,success_with_correction,,,,,expert,2026-06-17,cohort_2026_06,false,medium
724,failure_knowledge_gap,,,,,expert,2026-06-17,cohort_2026_06,true,hard
"""


@pytest.fixture(scope="module")
def seed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("seed") / "labels.csv"
    path.write_text(SEED)
    return tables.read_labels(spark, str(path))


def replies(spark, rows):
    schema = "conversation_id bigint, outcome string, " + ", ".join(
        f"{d} int" for d in V.RUBRIC) + ", char_count bigint, error string"
    return spark.createDataFrame(
        [(c, o, 3, 2, 1, None, 100, e) for c, o, e in rows], schema)


def run(spark, seed, rows):
    return validation.validation_rows(
        seed, replies(spark, rows), "r1", "2026-06-18 00:00:00", "v1", "m", "h")


GOLDEN = [(530, "success_clean", None), (643, "inconclusive", None), (691, "success_clean", None),
          (701, "failure_wrong_direction", None), (225, None, "ValueError: x"),
          (724, "success_clean", None)]


def test_seed_types_and_checks(spark, seed):
    assert seed.count() == 6
    row = seed.filter("conversation_id = 724").first()
    assert (row["is_blind"], row["labeled_at"], row["expected_actionability"]) == (
        True, datetime.date(2026, 6, 17), None)
    report = checks.table_report(
        "labels", seed, [], ["conversation_id", "labeler"],
        {"expected_outcome": V.SEED_OUTCOMES, "difficulty": V.DIFFICULTIES})
    assert report.filter("failing > 0").count() == 0


def test_golden_run(spark, seed):
    rows = {r["conversation_id"]: r for r in run(spark, seed, GOLDEN).collect()}
    passed = {c: r["outcome_passed"] for c, r in rows.items()}
    assert passed == {530: True, 643: True, 691: True, 701: False, 225: False, 724: False}
    assert rows[225]["error"] == "ValueError: x" and rows[225]["char_count"] is None
    assert rows[530]["answer_grounding_abs_error"] is None


def test_console_counts_errors_the_mart_does_not(spark, seed):
    ledger = run(spark, seed, GOLDEN)
    console = validation.headline_agreement(ledger).first()
    assert (console["passed"], console["cases"]) == (3, 5)
    mart = validation.concept_drift(validation.validation_fact(ledger)).first()
    assert (mart["n_passed"], mart["n_cases"], mart["error_count"]) == (3, 4, 1)
    assert mart["outcome_agreement_rate"] == 0.75
    assert (mart["blind_agreement_rate"], mart["n_blind_cases"]) == (0.0, 1)
    assert mart["question_understanding_match_rate"] is None
    assert validation.blind_cases(ledger).first()["conversation_id"] == 724


def test_label_without_reply_is_an_error_row(spark, seed):
    rows = run(spark, seed, GOLDEN[:2]).filter("conversation_id = 701").first()
    assert (rows["error"], rows["outcome_passed"]) == ("no judge result", False)


def test_duplicate_inserts_collapse(spark, seed):
    ledger = run(spark, seed, GOLDEN)
    twice = ledger.unionByName(ledger.withColumn("run_at", F.col("run_at") - F.expr("INTERVAL 1 DAY")))
    fact = validation.validation_fact(twice)
    assert fact.count() == 6
    assert fact.select("run_at").distinct().first()["run_at"] == datetime.datetime(2026, 6, 18)


# Agreement rate per weekly run and judge version, and the band that belongs to it (fixed values).
SERIES = [
    ("v1", 1.00, "stable"), ("v1", 0.95, "stable"), ("v1", 0.90, "stable"), ("v1", 0.92, "stable"),
    ("v1", 0.80, "moderate"), ("v1", 0.70, "significant"), ("v1", 0.85, "moderate"),
    ("v1", 0.92, "stable"), ("v1", 0.95, "stable"), ("v2", 0.83, "stable"), ("v2", 0.90, "stable"),
    ("v2", 0.95, "moderate"),
]


def series(spark):
    first = {"v1": 1.00, "v2": 0.83}
    rows = [
        (f"run_{i:02d}", version, LAST_RUN - datetime.timedelta(weeks=11 - i), rate, first[version],
         rate - first[version], band)
        for i, (version, rate, band) in enumerate(SERIES)
    ]
    return spark.createDataFrame(
        rows, "validation_run_id string, prompt_version string, run_at timestamp_ntz, "
        "outcome_agreement_rate double, baseline_agreement_rate double, "
        "agreement_delta_vs_baseline double, band string")


def test_bands_of_the_series(spark):
    rows = series(spark).withColumn(
        "got", labels.drift_band(F.col("outcome_agreement_rate"), F.col("baseline_agreement_rate")))
    assert rows.filter("NOT got <=> band").count() == 0


def test_series_passes_the_gate_and_its_dip_does_not(spark):
    assert validation.drift_gate(series(spark)).count() == 0
    dip = series(spark).filter("validation_run_id <= 'run_05'")
    with pytest.raises(checks.GateFailed, match="1 failing rows in (.*)") as failed:
        checks.require_empty(validation.drift_gate(dip), "drift")
    written = spark.read.parquet(str(failed.value).split(" in ")[1])
    assert [r["prompt_version"] for r in written.collect()] == ["v1"]


def test_gate_is_strict(spark):
    one = series(spark).limit(1)
    edge = one.withColumn("agreement_delta_vs_baseline", F.lit(-0.10))
    assert validation.drift_gate(edge).count() == 0
    assert validation.drift_gate(
        edge.withColumn("agreement_delta_vs_baseline", F.lit(-0.1001))).count() == 1


def test_first_run_without_rate_gives_unknown(spark, sf_dir):
    """A NULL first rate is the baseline: later runs are unknown, not re-based."""
    fact = validation.validation_fact(X.validation_ledger(spark, sf_dir))
    spoiled = fact.withColumn(
        "is_scored", F.col("is_scored") & (F.col("validation_run_id") != "run_00"))
    rows = validation.concept_drift(spoiled).filter("prompt_version = 'v1'").collect()
    assert {r["drift_band"] for r in rows} == {"unknown"}


def test_rate_range_check_finds_bad_rates(spark):
    rates = series(spark)
    assert checks.rates_out_of_range(rates).count() == 0
    rate = F.col("outcome_agreement_rate")
    bad = rates.withColumn("outcome_agreement_rate", F.when(rate == 1.0, 1.01).otherwise(rate))
    assert checks.rates_out_of_range(bad).count() == 1
    negative = rates.withColumn("outcome_agreement_rate", F.lit(-0.01))
    assert checks.rates_out_of_range(negative).count() == 12
