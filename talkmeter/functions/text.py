"""Text predicates and transcript pieces as native column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkmeter import vocabulary as V


def matches(lowered: Column, pattern: str) -> Column:
    """Case-insensitive LIKE on text that is already lower-cased.

    ``ILIKE`` lower-cases its input on every use; with some twenty patterns per
    message that dominates. Here the caller lowers once. Catalyst turns
    ``%word%`` into a substring search; a pattern with ``_`` or an inner ``%``
    stays a regular expression, so its literal fragments are searched first and
    most rows never reach the regex.
    """
    pattern = pattern.lower()
    test = lowered.like(pattern)
    fragments = [part for part in pattern.replace("_", "%").split("%") if part]
    if len(fragments) > 1 and "\\" not in pattern:
        for fragment in reversed(fragments):
            test = lowered.contains(fragment) & test
    return test


def matches_any(lowered: Column, patterns: list[str]) -> Column:
    return reduce(or_, [matches(lowered, pattern) for pattern in patterns])


def review_score(content: Column) -> Column:
    """First number after the score words, case-sensitive; NULL without one."""
    return F.regexp_extract(content, V.REVIEW_SCORE_REGEX, 1).try_cast("int")


def cut_message(kind: Column, content: Column, limits: dict[str, int]) -> Column:
    """Message text shortened by kind; kinds without a limit stay whole."""
    text = F.coalesce(content, F.lit(""))
    shortened = text
    for name, limit in limits.items():
        shortened = F.when(
            (kind == name) & (F.length(text) > limit),
            F.concat(F.substring(text, 1, limit), F.lit(V.CUT_SUFFIX)),
        ).otherwise(shortened)
    return shortened


def transcript_line(kind: Column, content: Column, limits: dict[str, int]) -> Column:
    """``[kind] text``; a missing kind is spelt the way it is printed there."""
    return F.concat(
        F.lit("["),
        F.coalesce(kind, F.lit("None")),
        F.lit("] "),
        cut_message(kind, content, limits),
    )


def cut_notice(dropped: Column) -> Column:
    return F.concat(F.lit("\n\n... ["), dropped.cast("string"), F.lit(" chars truncated] ...\n\n"))


def id_from_url(url: Column) -> Column:
    """Last path segment after trailing slashes are removed."""
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def split_ids(text: str) -> list[str]:
    """Search box text to a list of ids: trimmed, empty parts dropped."""
    return [part.strip() for part in text.split(",") if part.strip()]
