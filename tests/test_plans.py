"""Physical plan properties: pushdown, pruning, partial aggregation, no Python, no pair joins."""

import pytest

from hitlens.operators.charts import top_position_counts
from hitlens.plans.fixtures import Tables
from hitlens.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chart_report_pushes_filter_and_prunes(spark, scratch):
    # A stored ranking (as the reports read it in production).
    path = scratch + "/ranking"
    Tables(spark, SF_SMALL).chart().write.parquet(path)
    report = top_position_counts(spark.read.parquet(path), year="1997", k=10)
    text = plan(report)
    assert "PushedFilters: [IsNotNull(position), IsNotNull(date), EqualTo(position,1)" in text
    assert "ReadSchema: struct<position:int,track:string,artist:string,date:string>" in text
    assert "TakeOrderedAndProject" in text
    assert "partial_count" in text


def final_plan(df):
    """Run the DataFrame's own plan so AQE's final physical plan is returned."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pair_joins(spark, name):
    text = final_plan(QUERIES[name](Tables(spark, SF_SMALL)))
    assert "isFinalPlan=true" in text or "AdaptiveSparkPlan" not in text
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text, f"{name} uses {node}"


def test_region_report_prunes_partitions(spark, scratch):
    from hitlens.operators.charts import top_artists
    from hitlens.plans.fixtures import StoredTables

    stored = StoredTables.materialize(spark, SF_SMALL, scratch + "/stored")
    text = plan(top_artists(stored.chart(), "NATION_7"))
    assert "PartitionFilters: [isnotnull(region" in text and "(region" in text and "= NATION_7)" in text
    assert "ReadSchema: struct<artist:string,streams:bigint>" in text
    from hitlens.operators.charts import top_songs

    dated = plan(top_songs(stored.chart(), "1997-09-01", region="NATION_7"))
    assert "EqualTo(date,1997-09-01)" in dated and "PartitionFilters: [isnotnull(region" in dated


def test_enriched_ranking_is_joined_without_a_shuffle(spark, scratch):
    from hitlens.operators.enrich import enrich_ranking
    from hitlens.plans.fixtures import StoredTables

    stored = StoredTables.materialize(spark, SF_SMALL, scratch + "/stored")
    text = final_plan(enrich_ranking(stored.chart(), stored.extension()))
    assert "BroadcastHashJoin" in text and "LeftOuter, BuildRight" in text
    assert "Exchange hashpartitioning" not in text  # the ranking side is read in place


def test_requests_meet_candidates_and_works_at_once(spark):
    import re

    from hitlens.operators.resolve import related_works
    from hitlens.plans.registry import ARTIST_ORDER, WORK_ORDER

    t = Tables(spark, SF_SMALL)
    text = final_plan(related_works(t.requests(), t.artist_candidates(), t.work_candidates(), ARTIST_ORDER, WORK_ORDER))
    assert re.search(r"Join \[a#\d+, s#\d+\], \[a#\d+, s#\d+\], Inner", text)
    assert "ReadSchema: struct<a:string,arid:string," in text and "ReadSchema: struct<s:string,arid:string," in text
    assert "SortAggregate" not in text  # the reductions are read, not made again


def test_containment_answers_are_read_not_recomputed(spark):
    from hitlens.operators.enrich import containment_match, last_matches

    t = Tables(spark, SF_SMALL)
    needles = t.chart().selectExpr("lower(artist) la", "lower(track) lt").distinct()
    text = final_plan(containment_match(needles, last_matches(t.extension())))
    assert "ReadSchema: struct<la:string,lt:string,country:string,begin_area:string>" in text
    assert "Exchange" not in text and "Generate" not in text
