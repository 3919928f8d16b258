"""Every registered query against its DuckDB oracle on the smallest scale
(the driver repeats this at sf0.01); queries without an oracle must run."""

import pytest

import __spark_entry__ as E
from oracle_harness import check

ORACLES = sorted(E.oracle_sql())
NO_ORACLE = sorted(set(E.queries()) - set(ORACLES) - {"clean_pipeline", "impute_area"})


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ORACLES)
def test_matches_oracle(spark, small_dir, name):
    r = check(spark, name, small_dir)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", NO_ORACLE)
def test_rows_only_queries_run(spark, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    assert df.count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
