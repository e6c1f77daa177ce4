"""Telemetry aggregates as streams: the batch plans behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame

from talkmeter.plans import telemetry


def timed(events: DataFrame, delay: str) -> DataFrame:
    """Event time as ``timestamp`` with the given allowance for late rows."""
    return telemetry.as_instant(events).withWatermark("ts", delay)


def counters(events: DataFrame) -> DataFrame:
    """Running counters (update mode); the state is one row per label set."""
    return telemetry.counters(events)


def error_rate(events: DataFrame, delay: str = "10 minutes", slide: str | None = None) -> DataFrame:
    return telemetry.error_rate(timed(events, delay), slide=slide)


def latency_quantiles(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return telemetry.latency_quantiles(timed(events, delay))


def score_means(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return telemetry.score_means(timed(events, delay))
