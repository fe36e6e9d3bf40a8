"""Plan shape: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from catalog_engine.operators import aggregates as AG
from catalog_engine.operators import ranking as R
from catalog_engine.operators import store as IO
from catalog_engine.sources import tables as TB
from tests.conftest import SF_SMALL

QUERIES = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.startswith("q_")))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_partial_aggregation_before_shuffle(spark):
    prep = TB.analysis_store(spark, SF_SMALL)
    p = plan(AG.top_tokens(prep, "style", 10))
    assert "partial_count" in p and "TakeOrderedAndProject" in p
    p = plan(AG.label_stats(prep))
    assert "partial_avg" in p
    raw = TB.release_store(spark, SF_SMALL)
    p = plan(IO.first_per_key(raw.withColumn("_pos", raw.id), "release_id", "_pos"))
    assert "partial_min" in p and "SortAggregate" not in p


def test_insert_joins_before_it_aggregates(spark):
    raw = TB.release_store(spark, SF_SMALL)
    p = plan(IO.new_rows(raw, raw.withColumn("_pos", raw.id), "release_id", "_pos"))
    assert "LeftAnti" in p and "SortAggregate" not in p and "min_by" not in p


def test_leaderboard_scans_once(spark):
    """The prior is a scalar subquery over the same groups."""
    lb = R.leaderboard(TB.release_store(spark, SF_SMALL).withColumnRenamed("rating_coefficient", "rating_coeff"), "artist")
    assert "Subquery" in plan(lb)


def test_scan_reads_only_needed_columns(spark):
    prep = TB.analysis_store(spark, SF_SMALL)
    p = plan(AG.top_tokens(prep, "genre", 10))
    assert "ReadSchema: struct<genre:string>" in p


def test_page_window_runs_after_limit(spark):
    lb = R.leaderboard(TB.release_store(spark, SF_SMALL).withColumnRenamed("rating_coefficient", "rating_coeff"),
                       "artist")
    p = plan(R.leaderboard_page(lb, 3))
    assert p.index("Window") < p.index("TakeOrderedAndProject(limit=30")


def test_top_n_broadcast_is_bounded(spark):
    """Every explicit broadcast in the trend plans sits on a limited input."""
    p = plan(QUERIES["q_label_trend"](spark, SF_SMALL))
    assert "BroadcastExchange" in p
    assert "TakeOrderedAndProject(limit=10" in p


def test_lines_reach_their_order_without_collected_buffers(spark):
    p = plan(TB.order_facts(spark, SF_SMALL))
    dealt = [x for x in p.splitlines() if "hashpartitioning(l_orderkey" in x]
    assert any("REPARTITION_BY_COL" in x for x in dealt) and "collect_set" not in p
