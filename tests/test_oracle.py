"""Every registered query equals its independent SQL."""

import pytest
from compare import compare, database

from talkmeter.catalog.oracles import ORACLES
from talkmeter.catalog.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_each_query_has_an_oracle():
    assert set(ORACLES) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, REGISTRY[name], ORACLES[name], sf_dir) == ""


def test_native_quantiles_have_the_right_rank(spark, con, sf_dir):
    """The sketch returns observed values; check the share of rows up to them."""
    from talkmeter.catalog import fixtures as X
    from talkmeter.plans import telemetry

    rows = telemetry.latency_quantiles_native(X.judge_events(spark, sf_dir)).collect()
    assert len(rows) == 3
    for kind, p50, p95 in rows:
        for q, value in ((0.5, p50), (0.95, p95)):
            upto, below = con.execute(
                f"WITH {X.CTE_JUDGE_EVENTS} SELECT avg((latency_s <= {value})::INT), "
                f"avg((latency_s < {value})::INT) FROM judge_e WHERE conversation_type = '{kind}'"
            ).fetchone()
            assert below - 0.001 <= q <= upto + 0.001
