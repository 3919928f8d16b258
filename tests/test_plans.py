"""Physical-plan properties that matter at scale."""

import re

import pytest

import __spark_entry__ as E
from tidyrent.fixtures import listings_raw
from tidyrent.operators import dedupe as D
from tidyrent.operators.quantiles import exact_quantiles
from tidyrent.plans.catalog import typed_stage

SLOW = {"clean_pipeline", "impute_area"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SLOW))
def test_no_cross_or_nested_loop_joins(spark, small_dir, name):
    p = plan(E.queries()[name](spark, small_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", p), name


def test_scans_are_pruned(spark, small_dir):
    p = plan(listings_raw(spark, small_dir))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", p))
    assert schemas == {"struct<o_orderkey:bigint,o_custkey:bigint>", "struct<c_custkey:bigint>"}


def test_keep_first_combines_map_side(spark, small_dir):
    p = plan(D.keep_first(typed_stage(spark, small_dir), ["distrito", "dormitorios"]))
    assert "partial_min_by" in p


def test_quantiles_never_buffer_whole_groups(spark, small_dir):
    t = typed_stage(spark, small_dir)
    p = plan(exact_quantiles(t, ["distrito"], "precio", [0.25, 0.5]))
    assert "percentile(" not in p and "median(" not in p
