"""Scale properties of the physical plans, kept as regression tests."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_frame_counts_pushes_filter_and_prunes(spark):
    plan = _plan(spark, "frame_counts")
    assert "PushedFilters: [In(l_linenumber, [2,3,5,7])" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert "partial_count" in plan                       # map-side combine before the shuffle


def test_dashboard_grid_is_one_global_aggregate(spark):
    plan = _plan(spark, "sentiment_counts")
    assert "hashpartitioning" not in plan and "Join" not in plan
    assert "ReadSchema: struct<embedding:array<float>>" in plan


def test_encode_is_shuffle_free(spark):
    plan = _plan(spark, "encode_docs")
    assert "MapInArrow" in plan
    assert "hashpartitioning" not in plan


def test_token_counts_combine_map_side(spark):
    plan = _plan(spark, "token_counts")
    assert "partial_count" in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1          # one shuffle, of sums per task


def test_row_index_has_no_single_partition_window_over_data(spark):
    plan = _plan(spark, "val_loss")
    # the only single-partition exchanges are the offsets table (one row per
    # partition) and the final one-row average, never the input rows
    assert "rangepartitioning" not in plan or "Scan ExistingRDD" in plan
    assert "Scan ExistingRDD" in plan                    # reads the checkpointed rows


def test_latest_frame_has_no_sort_aggregate(spark):
    assert "SortAggregate" not in _plan(spark, "latest_frame")


def test_narrow_document_queries_do_not_repartition(spark):
    for name in ("preview", "recent_rows", "confusion", "union_cameras"):
        assert "RoundRobinPartitioning" not in _plan(spark, name), name
