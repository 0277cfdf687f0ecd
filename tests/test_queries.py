"""Every registered query against its SQL, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry
from treeledger import oracles, queries

# Those of the training-data subpackage have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in queries.QUERIES}
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return compare.database(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, data, con, name):
    assert compare.check(spark, con, name, QUERIES[name], SQL[name], data) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


SPLIT_JOINS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@pytest.mark.parametrize(
    "name",
    ["window_children", "list_children", "validate_parents", "serve_listing", "create_folders", "commit_files", "bulk_copy"],
)
def test_with_shuffled_and_split_joins(spark, data, con, name):
    """As on large inputs: nothing small enough to broadcast, skewed partitions split."""
    for key, value in SPLIT_JOINS.items():
        spark.conf.set(key, value)
    try:
        assert compare.check(spark, con, name, QUERIES[name], SQL[name], data) == ""
    finally:
        for key in SPLIT_JOINS:
            spark.conf.unset(key)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_plans(spark, data):
    from treeledger import fixtures as X
    from treeledger.operators import listing, paging
    from treeledger.plans.copying import copy_plan
    from treeledger.sources import store

    nodes = X.star_nodes(spark, data)
    # Rows in line meet the counts per folder without another shuffle of theirs.
    plan = final_plan(paging.page_children(nodes))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Filters reach the scan, and only needed columns are read.
    plan = final_plan(store.scan_nodes(spark, X.node_store(spark, data), "s1").select("location_path"))
    assert "PartitionFilters: [isnotnull(world" in plan and "ReadSchema: struct<location_path:string>" in plan
    plan = final_plan(listing.list_folder(nodes, "s1", "root"))
    assert "EqualTo(parent_id,root)" in plan and "Exchange" not in plan
    plan = final_plan(copy_plan(nodes, "primary", "s1"))
    assert plan.count("PartitionFilters: [isnotnull(world") == 2 and "parent_path" not in plan
