import pytest
from compare import of_spark, of_sql

from soundline.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert of_spark(QUERIES[name](spark, SF)) == of_sql(ORACLE[name], SF)


def test_every_query_is_compared():
    """Those without SQL have brute-force tests: test_skeleton, test_kernels."""
    assert set(QUERIES) - set(ORACLE) == {"skeleton_network", "navmesh_triangulate"}
