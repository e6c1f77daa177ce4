"""Surrogate keys and judge fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(first: Column, second: Column) -> Column:
    """md5 of ``first-second``; NULL as soon as one part is NULL."""
    return F.md5(F.concat(first.cast("string"), F.lit("-"), second.cast("string")))


def prompt_hash(model: Column, prompt: Column) -> Column:
    """Eight hex digits that change with the model or the prompt."""
    return F.substring(F.sha2(F.concat(model, F.lit("\n"), prompt), 256), 1, 8)


def prompt_version(judge: str, model: Column, prompt: Column) -> Column:
    return F.concat(F.lit(f"{judge}_"), prompt_hash(model, prompt))
