"""Transcripts that loads have built up equal those that are built at once."""

import functools
import random

import pytest
from pyspark.sql import functions as F
from test_transcripts import LIMITS, SCHEMA, assembled, capped, random_rows

from talkmeter.operators import running_transcripts as rt

CAPS = [(60, 40, 20), (100, 30, 50), (30, 25, 20), (10**6, 5, 5), (40, 40, 0)]


@pytest.mark.parametrize("cap, head, tail", CAPS)
def test_pairs_join_in_any_grouping(spark, cap, head, tail):
    rng, cases = random.Random(cap), []
    for _ in range(150):
        texts = [rng.choice("aé😀z") * rng.choice([0, 1, 5, 20, 45, 70, 130]) for _ in range(3)]
        cases.append((texts, capped("\n\n".join(texts), cap, head, tail) if tail else None))
    rows = [[(len(t), capped(t, cap, head, tail) if tail else t[:head] + (
        "" if len(t) <= cap else f"\n\n... [{len(t) - head} chars truncated] ...\n\n")) for t in texts]
        for texts, _ in cases]
    df = spark.createDataFrame(
        [(i, *[v for pair in row for v in pair]) for i, row in enumerate(rows)],
        "i int, n0 bigint, t0 string, n1 bigint, t1 string, n2 bigint, t2 string")
    a, b, c = ((F.col(f"n{k}"), F.col(f"t{k}")) for k in range(3))
    join = functools.partial(rt.joined_pair, cap=cap, head=head, tail=tail)
    forms = [join(join(a, b), c), join(a, join(b, c))]
    got = df.select("i", *[x.alias(f"{m}{k}") for k, f in enumerate(forms) for m, x in zip("nt", f)]).collect()
    for r in got:
        texts, want = cases[r.i]
        assert (r.n0, r.t0) == (r.n1, r.t1)
        assert r.n0 == len("\n\n".join(texts)) and (want is None or r.t0 == want)


def stored(spark, path):
    return {r.conversation_id: (r.char_count, r.transcript) for r in rt.current(spark, path).collect()}


def wanted(rows, cap, head, tail):
    texts = {c: assembled([r for r in rows if r[1] == c], LIMITS) for c in {r[1] for r in rows}}
    return {c: (len(t), capped(t, cap, head, tail)) for c, t in texts.items()}


@pytest.mark.parametrize("cap, head, tail", [(60, 40, 20), (100, 30, 50)])
def test_loads_that_follow_each_other(spark, tmp_path, cap, head, tail):
    path, settings = str(tmp_path / "t"), dict(cap=cap, head=head, tail=tail, limits=LIMITS, buckets=4)
    rows = [(*r[:4], n) for n, r in enumerate(random_rows(5, 12))]
    for low, high in ((0, 30), (30, 35), (35, 200)):
        part = spark.createDataFrame([r for r in rows if low <= r[4] < high], SCHEMA)
        rt.load(part, path, whole=False, **settings)
        assert stored(spark, path) == wanted([r for r in rows if r[4] < high], cap, head, tail)
    before = stored(spark, path)
    late = spark.createDataFrame([rows[0]], SCHEMA)
    with pytest.raises(Exception, match="don't follow"):
        rt.load(late, path, whole=False, **settings)
    assert stored(spark, path) == before


def test_a_load_of_whole_conversations_changes_only_these(spark, tmp_path):
    path, settings = str(tmp_path / "t"), dict(cap=60, head=40, tail=20, limits=LIMITS)
    rows = random_rows(6, 40)
    assert len(rt.load(spark.createDataFrame(rows, SCHEMA), path, **settings)) > 10
    edited = [(*r[:3], "edited", r[4]) for r in rows if r[1] == 3]
    touched = rt.load(spark.createDataFrame(edited, SCHEMA), path, **settings)
    assert len(touched) == 1
    assert stored(spark, path) == wanted([r for r in rows if r[1] != 3] + edited, 60, 40, 20)
    assert rt.load(spark.createDataFrame([], SCHEMA), path, **settings) == []


def test_short_conversations_are_collected_once(spark, sf_dir, monkeypatch):
    """Without a conversation above the cap no blocks are made, and ends need no pass of their own."""
    from talkmeter.catalog import fixtures as X
    from talkmeter.operators import transcripts

    monkeypatch.setattr(transcripts, "block_offsets", None)
    rows = rt.states(X.messages(spark, sf_dir))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan
    position = F.coalesce("sequence_number", F.lit(2**31 - 1)).cast("bigint")
    ends = X.messages(spark, sf_dir).groupBy("conversation_id").agg(F.min(position), F.max(position))
    found = rows.select("conversation_id", "first_position", "last_position")
    assert found.exceptAll(ends).count() == 0 and ends.exceptAll(found).count() == 0
