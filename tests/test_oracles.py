"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from geoloom.operators import service
from tests.conftest import FOLDER
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_unreachable_demand_is_refused_beyond_the_tolerance(spark):
    cells = spark.createDataFrame([(1, 90.0), (2, 10.0)], "cell_id long, demand_kw double")
    pairs = spark.createDataFrame([(1, 5.0)], "cell_id long, dist_m double")
    with pytest.raises(ValueError, match="no server in range"):
        service.unreachable_check(cells, pairs, 0.05)
    assert [r.cell_id for r in service.unreachable_check(cells, pairs, 0.2).collect()] == [1]


def test_entry_has_one_row(spark):
    assert entry.entry(spark).count() == 1


JOINS = ["radius_join", "spatial_join_within", "semi_join_near_line", "anti_join_uncovered", "eligible_pairs", "overlay_intersection",
         "site_restrictions_join", "rasterize_mask", "join_results_metadata", "roc_auc", "first_tile_wins", "sample_per_source"]


@pytest.mark.parametrize("name", JOINS)
def test_no_cartesian_product(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = entry.queries()["confusion_counts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string,value:double>" in plan
