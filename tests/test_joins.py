"""Layers derived from tables that look small are not gathered in the driver to be broadcast."""

import re

import pytest

from soundline.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _joins(df, key):
    """Kinds of the joins whose first key is named so."""
    return set(re.findall(rf"(\w+Join)(?: \(\d+\))? \[{key}#", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("name", ["edge_soft_obstruction_depth", "edge_min_depth", "region_edges", "shape_edge_min_depth", "shape_holds_edge", "shape_node_depth"])
def test_layers_are_not_broadcast(spark, name):
    plan = QUERIES[name](spark, SF)
    assert _joins(plan, "cx") == {"SortMergeJoin"}


def test_region_edges_is_no_single_plan(spark):
    """All attributes in one plan of over 70 joins took more of the driver's memory than their rows."""
    plan = QUERIES["region_edges"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\w+Join ", plan)) <= 20
