"""Telemetry aggregates over judge-call and load events.

The same functions serve batch frames and streams where the operator allows it;
``streaming.telemetry`` adds watermarks and sinks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from talkmeter import vocabulary as V
from talkmeter.operators import histogram


def counter_increments(events: DataFrame) -> DataFrame:
    """Every counter increment an event causes: (metric, label_1, label_2, step).

    One scan feeds all counters; the caller groups and sums.
    """

    def step(metric: str, condition: Column, first: Column, second: Column, by: Column) -> Column:
        entry = F.struct(
            F.lit(metric).alias("metric"), first.alias("label_1"),
            second.alias("label_2"), by.cast("bigint").alias("step"),
        )
        return F.when(condition, entry)

    kind, outcome = F.col("conversation_type"), F.col("outcome")
    none, one = F.lit(None).cast("string"), F.lit(1)
    fine = F.col("error_type").isNull()
    steps = F.array(
        step("outcomes", fine, kind, F.coalesce(outcome, F.lit("unknown")), one),
        step("errors", ~fine, kind, F.col("error_type"), one),
        step("retries", F.col("retry_count") > 0, kind, none, F.col("retry_count")),
        step("dev_acknowledged", fine & F.col("flag_dev_acknowledged"),
             F.coalesce(outcome, F.lit("unknown")), none, one),
    )
    return events.select(F.inline(F.array_compact(steps)))


def counters(events: DataFrame) -> DataFrame:
    return (
        counter_increments(events)
        .groupBy("metric", "label_1", "label_2")
        .agg(F.sum("step").alias("value"))
    )


def rows_fetched(loads: DataFrame) -> DataFrame:
    return loads.groupBy("table_name").agg(F.sum("rows").alias("rows_fetched"))


def latency_histogram(events: DataFrame) -> DataFrame:
    return histogram.long_histogram(
        events, ["conversation_type"], F.col("latency_s"), V.LATENCY_BUCKETS
    )


def insert_latency_histogram(loads: DataFrame) -> DataFrame:
    return histogram.long_histogram(loads, ["table_name"], F.col("insert_s"), V.INSERT_BUCKETS)


def long_scores(events: DataFrame, keep: list[str]) -> DataFrame:
    """One row per event and scored dimension."""
    scores = events.select(*keep, *V.RUBRIC).unpivot(keep, V.RUBRIC, "dimension", "score")
    return scores.filter(F.col("score").isNotNull())


def score_histogram(events: DataFrame) -> DataFrame:
    scores = long_scores(events, ["conversation_type"])
    return histogram.long_histogram(
        scores, ["conversation_type", "dimension"], F.col("score"), V.SCORE_BUCKETS
    )


def window_start(window: str = "window") -> Column:
    return F.col(f"{window}.start").cast("timestamp_ntz").alias("window_start")


def as_instant(events: DataFrame) -> DataFrame:
    """Event time as ``timestamp``; windows with watermarks need it.

    A column that already is one stays untouched, since a cast would drop its
    watermark.
    """
    if isinstance(events.schema["ts"].dataType, TimestampType):
        return events
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def latency_quantiles(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """p50 and p95 per type and window, estimated from the latency buckets."""
    wide = histogram.wide_histogram(
        as_instant(events),
        [F.window("ts", width).alias("window"), "conversation_type"],
        F.col("latency_s"),
        V.LATENCY_BUCKETS,
    )
    return wide.select(
        window_start(),
        "conversation_type",
        histogram.quantile(0.50, V.LATENCY_BUCKETS).alias("p50"),
        histogram.quantile(0.95, V.LATENCY_BUCKETS).alias("p95"),
    )


def latency_quantiles_native(events: DataFrame, accuracy: int = 10000) -> DataFrame:
    """p50 and p95 per type from the raw values (mergeable quantile sketch)."""
    return events.groupBy("conversation_type").agg(
        F.percentile_approx("latency_s", 0.50, accuracy).alias("p50"),
        F.percentile_approx("latency_s", 0.95, accuracy).alias("p95"),
    )


def quantile_ranks(events: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Do the sketched quantiles have the rank they should, within its error bound?

    Shares of the values below and up to each quantile, per type; one row per
    type comes from the sketch, so it is joined by broadcast.
    """
    bound = 1 / accuracy
    sketched = F.broadcast(latency_quantiles_native(events, accuracy))
    value = F.col("latency_s")

    def share(condition: Column) -> Column:
        return F.avg(condition.cast("double"))

    rows = events.filter(value.isNotNull()).join(sketched, "conversation_type")
    return rows.groupBy("conversation_type").agg(
        *[
            ((share(value < F.col(name)) - bound <= q) & (q <= share(value <= F.col(name)) + bound))
            .alias(f"{name}_in_bound")
            for name, q in (("p50", 0.50), ("p95", 0.95))
        ]
    )


def error_rate(
    events: DataFrame, width: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    """Errors per second by type and class in each window, over the window's own length."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    errors = as_instant(events).filter(F.col("error_type").isNotNull())
    counted = errors.groupBy(window.alias("window"), "conversation_type", "error_type").agg(
        F.count("*").alias("errors")
    )
    return counted.select(
        window_start(),
        "conversation_type",
        "error_type",
        "errors",
        (
            F.col("errors")
            / (F.unix_seconds(F.col("window.end")) - F.unix_seconds(F.col("window.start")))
        ).alias("errors_per_second"),
    )


def score_means(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Mean score per dimension and day: sum over count, as a rate of both."""
    scores = long_scores(as_instant(events), ["ts"])
    return (
        scores.groupBy(F.window("ts", width).alias("window"), "dimension")
        .agg(F.sum("score").alias("total"), F.count("score").alias("scores"))
        .select(
            window_start(), "dimension", (F.col("total") / F.col("scores")).alias("mean_score")
        )
    )


def trailing(folded: DataFrame, at: str, step: int, width: int) -> DataFrame:
    """Rows folded per step of ``step`` seconds, once for each trailing window they lie in.

    ``at`` is the step's first second; ``window_end`` replaces it. A window of
    ``width`` seconds ends at every step and holds the steps before its end. What
    is copied are folded rows, not events.
    """
    ends = F.sequence(F.col(at) + step, F.col(at) + width, F.lit(step).cast("bigint"))
    return folded.withColumn("window_end", F.explode(ends)).drop(at)


def step_start(seconds: int) -> Column:
    second = F.unix_seconds(F.col("ts"))
    return second - F.pmod(second, F.lit(seconds))


def window_end() -> Column:
    return F.timestamp_seconds("window_end").cast("timestamp_ntz").alias("window_end")


def score_means_trailing(events: DataFrame, step: int = 3600, width: int = 86_400) -> DataFrame:
    """Mean score per dimension over the ``width`` seconds before each step."""
    scores = long_scores(as_instant(events), ["ts"])
    folded = scores.groupBy(step_start(step).alias("step"), "dimension").agg(
        F.sum("score").alias("total"), F.count("score").alias("scores")
    )
    windows = trailing(folded, "step", step, width).groupBy("window_end", "dimension").agg(
        F.sum("total").alias("total"), F.sum("scores").alias("scores")
    )
    return windows.select(
        window_end(), "dimension", (F.col("total") / F.col("scores")).alias("mean_score"), "scores"
    )


def latency_quantiles_trailing(events: DataFrame, step: int = 60, width: int = 300) -> DataFrame:
    """p50 and p95 per type over the ``width`` seconds before each step, from the latency buckets."""
    folded = histogram.wide_histogram(
        as_instant(events), [step_start(step).alias("step"), "conversation_type"],
        F.col("latency_s"), V.LATENCY_BUCKETS,
    )
    counts = [name for name in folded.columns if name.startswith("le_")]
    windows = trailing(folded, "step", step, width).groupBy("window_end", "conversation_type").agg(
        *[F.sum(name).alias(name) for name in counts]
    )
    return windows.select(
        window_end(), "conversation_type",
        histogram.quantile(0.50, V.LATENCY_BUCKETS).alias("p50"),
        histogram.quantile(0.95, V.LATENCY_BUCKETS).alias("p95"),
    )


def latency_sketches(events: DataFrame, step: int = 60, k: int = 800) -> DataFrame:
    """One KLL sketch of the latencies per step and type: a few kilobytes, whatever a step holds."""
    timed = as_instant(events).filter(F.col("latency_s").isNotNull())
    return timed.groupBy(step_start(step).alias("step"), "conversation_type").agg(
        F.kll_sketch_agg_double(F.col("latency_s").cast("double"), k).alias("sketch")
    )


def sketched_quantiles(sketches: DataFrame, step: int = 60, width: int = 300) -> DataFrame:
    """p50 and p95 per type over the ``width`` seconds before each step, from stored sketches.

    Any window of whole steps can be asked for later; no latency is read again.
    """
    merged = trailing(sketches, "step", step, width).groupBy("window_end", "conversation_type").agg(
        F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select(
        window_end(), "conversation_type", F.kll_sketch_get_n_double("sketch").alias("latencies"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.50)).alias("p50"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.95)).alias("p95"),
    )


def sketched_ranks(
    events: DataFrame, quantiles: DataFrame, step: int = 60, width: int = 300, bound: float = 0.01
) -> DataFrame:
    """Do sketched quantiles have the rank they should among the latencies of their windows?"""
    value = F.col("latency_s").cast("double")
    timed = as_instant(events).filter(value.isNotNull()).select(
        step_start(step).alias("step"), "conversation_type", value.alias("latency_s")
    )
    spread = trailing(timed, "step", step, width).select(window_end(), "conversation_type", "latency_s")
    slack = F.lit(bound) + 1 / F.col("latencies")

    def share(condition: Column) -> Column:
        return F.avg(condition.cast("double"))

    keys = ["window_end", "conversation_type", "latencies"]
    return spread.join(quantiles, keys[:2]).groupBy(*keys).agg(*[
        ((share(F.col("latency_s") < F.col(name)) - slack <= q)
         & (q <= share(F.col("latency_s") <= F.col(name)) + slack)).alias(f"{name}_in_bound")
        for name, q in (("p50", 0.50), ("p95", 0.95))
    ])


def success_rate(events: DataFrame) -> DataFrame:
    """Outcomes that start with ``success`` over all outcomes."""
    outcomes = events.filter(F.col("error_type").isNull())
    label = F.coalesce("outcome", F.lit("unknown"))
    hit = F.count_if(label.startswith("success"))
    return outcomes.agg((hit / F.nullif(F.count("*"), F.lit(0))).alias("success_rate"))


def totals(events: DataFrame) -> DataFrame:
    fine = F.col("error_type").isNull()
    return events.agg(
        F.count_if(fine).alias("classified"),
        F.count_if(fine & F.col("flag_dev_acknowledged")).alias("dev_acknowledged"),
    )


def watermark_age(rows: DataFrame, now: str | Column, column: str = "updated_at") -> DataFrame:
    """Seconds between the given clock and the newest loaded change."""
    moment = (F.lit(now) if isinstance(now, str) else now).cast("timestamp")
    newest = F.max(column).cast("timestamp")
    return rows.agg((F.unix_timestamp(moment) - F.unix_timestamp(newest)).alias("age_seconds"))
