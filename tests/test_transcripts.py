"""Block-wise transcripts against plain string assembly."""

import random

import pytest

from talkmeter import vocabulary as V
from talkmeter.operators import transcripts

SCHEMA = ("id bigint, conversation_id bigint, message_type string, content string, "
          "sequence_number int")
LIMITS = {"tool_result": 9, "tool_call": 4, "user": 12}


def assembled(rows, limits):
    lines = []
    order = sorted(rows, key=lambda r: (2**31 if r[4] is None else r[4], r[0]))
    for _, _, kind, content, _ in order:
        limit = limits.get(kind)
        if limit and content and len(content) > limit:
            content = content[:limit] + V.CUT_SUFFIX
        lines.append(f"[{kind}] {content or ''}")
    return "\n\n".join(lines)


def capped(text, cap, head, tail):
    if len(text) <= cap:
        return text
    dropped = len(text) - head - tail
    return f"{text[:head]}\n\n... [{dropped} chars truncated] ...\n\n{text[-tail:]}"


def random_rows(seed, conversations=6):
    pick = random.Random(seed)
    rows = []
    for conversation in range(conversations):
        for _ in range(pick.choice([1, 2, 5, 40])):
            content = pick.choice(
                [None, "", "é" * pick.randint(1, 30), "ab\ncd" * pick.randint(1, 8), "😀x" * 9])
            rows.append((
                len(rows), conversation, pick.choice([*V.MESSAGE_KINDS, None, "odd"]), content,
                pick.choice([None, pick.randint(0, 60)]),
            ))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", [1, 4, 512])
@pytest.mark.parametrize("cap, head, tail", [(60, 40, 20), (100, 30, 50), (30, 25, 20), (10**6, 5, 5)])
def test_capped_equals_assembled(spark, seed, block, cap, head, tail):
    rows = random_rows(seed)
    got = {
        r["conversation_id"]: (r["char_count"], r["transcript"])
        for r in transcripts.capped_transcripts(
            spark.createDataFrame(rows, SCHEMA), LIMITS, cap, head, tail, block
        ).collect()
    }
    for conversation in {r[1] for r in rows}:
        text = assembled([r for r in rows if r[1] == conversation], LIMITS)
        assert got[conversation] == (len(text), capped(text, cap, head, tail))


@pytest.mark.parametrize("block", [1, 7, 512])
@pytest.mark.parametrize("part_chars", [15, 1_000_000])
def test_parts_join_to_the_whole_text(spark, block, part_chars):
    rows = random_rows(9)
    rows += [(1000 + i, 77, "user", "x" * 8, None) for i in range(50)]  # none has a position
    parts = transcripts.transcript_parts(
        spark.createDataFrame(rows, SCHEMA), LIMITS, block, part_chars).collect()
    longest = max(len(assembled([r], LIMITS)) for r in rows)
    assert all(p["part_chars"] <= part_chars + longest for p in parts)
    texts = {}
    for part in sorted(parts, key=lambda p: (p["part"], p["piece"])):
        texts.setdefault(part["conversation_id"], []).append(part["text"])
    for conversation, pieces in texts.items():
        expected = assembled([r for r in rows if r[1] == conversation], LIMITS)
        assert "\n\n".join(pieces) == expected


def test_no_messages_give_no_transcript(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert transcripts.capped_transcripts(empty).count() == 0
    assert transcripts.transcript_parts(empty).count() == 0


def test_long_conversation_keeps_only_head_and_tail(spark):
    """One conversation of 200,000 messages next to a short one."""
    from pyspark.sql import functions as F

    rows = spark.range(200_001).select(
        "id", F.when(F.col("id") < 200_000, 1).otherwise(2).cast("bigint").alias("conversation_id"),
        F.lit("thinking").alias("message_type"),
        F.concat(F.lit("message "), F.col("id").cast("string")).alias("content"),
        F.col("id").cast("int").alias("sequence_number"),
    )
    got = {r["conversation_id"]: r for r in transcripts.capped_transcripts(rows).collect()}
    text = "\n\n".join(f"[thinking] message {i}" for i in range(200_000))
    assert got[1]["char_count"] == len(text)
    assert got[1]["transcript"] == capped(text, 30000, 20000, 10000)
    assert got[2]["transcript"] == "[thinking] message 200000"
