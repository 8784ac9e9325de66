from __future__ import annotations

import pytest

from pulsegrid.plans.registry import ORACLES, QUERIES

from oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert_same(QUERIES[name](spark, sf_dir), con, ORACLES[name])


def test_sample_has_the_exact_size(spark, sf_dir):
    assert QUERIES["sample_n"](spark, sf_dir).count() == 50


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
