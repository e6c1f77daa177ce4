"""Queries of the corpus operators equal their SQL, and all are registered."""

import re

import pytest
from compare import compare, database

import __spark_entry__
import corpus_pipeline
from talkmeter.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    query = catalog.QUERIES[name]
    assert compare(spark, database(sf_dir), query, catalog.ORACLES[name], sf_dir) == ""


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 14))
    names = __spark_entry__.queries()
    assert set(catalog.QUERIES) < set(names) and names["pipeline"] is corpus_pipeline.run
