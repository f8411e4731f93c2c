"""Work of one task stays bounded: rows are dealt by the size of the input, not by a fixed number."""

import glob
import time

import pytest

from hitlens.plans import files, fixtures, registry
from hitlens.plans.fixtures import Tables
from hitlens.session import SHUFFLE_CLEANUP, Intermediates, shuffles_released
from hitlens.sinks import files as sink_files
from hitlens.sources import read_extension, read_ranking
from tests.conftest import SF_SMALL, rows

EXT = "ord long, artist string, song string, country string, starting_place string"


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_tenth_of_the_ordinals_is_written_by_several_tasks(spark, uncoalesced):
    rows = [(10 * i + 1, f"A{i}", f"S{i}", "CL", "P") for i in range(400)] + [(7, "B", "T", None, None)]
    paths = files.extension_parts(spark.createDataFrame(rows, EXT))
    assert [p.rsplit("=", 1)[1] for p in paths] == ["1", "7"]
    assert len(glob.glob(paths[0].removeprefix("file:") + "/part-*")) > 1
    back = read_extension(spark, paths, skip=2).orderBy("ord").collect()
    assert [(r.artist, r.song) for r in back] == [(f"A{i}", f"S{i}") for i in range(400)] + [("B", "T")]


def test_headerless_parts_grow_with_the_chart(spark, monkeypatch):
    assert Tables(spark, SF_SMALL).chart_parts().rdd.getNumPartitions() == 5
    monkeypatch.setattr(fixtures, "PER_TASK", 600)
    n = fixtures.table(spark, SF_SMALL, "lineitem").count() // 600
    assert n > 5 and Tables(spark, SF_SMALL).chart_parts().rdd.getNumPartitions() == n


def test_tasks_that_aggregate_the_chart_grow_with_the_line_items(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "PER_TASK", 100)
    n = fixtures.table(spark, SF_SMALL, "lineitem").count() // 100
    plan = Tables(spark, SF_SMALL).chart()._jdf.queryExecution().executedPlan().toString()
    assert n > 8 and any("REPARTITION_BY_NUM" in line and f", {n})" in line for line in plan.splitlines())


RANKING = "position int, track string, artist string, streams long, url string, date string, region string"


def test_names_are_shuffled_once_and_finished_rows_never(spark):
    for chart in (Tables(spark, SF_SMALL).chart(), Tables(spark, SF_SMALL).chart_parts()):
        plan = chart._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
        assert not any("RoundRobin" in line or "hashpartitioning(track" in line for line in exchanges)
        assert sum("hashpartitioning(date" in line for line in exchanges) == 1


@pytest.mark.parametrize("parts", [False, True])
def test_what_the_stored_names_are_made_of_is_not_shuffled_again(spark, parts):
    tables, derived = Intermediates(spark), Tables(spark, SF_SMALL)
    made = derived.chart_parts if parts else derived.chart
    chart = made(tables)
    assert len(tables.paths) == 1 and "chart-named" in tables.paths[0]
    plan = chart._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in line for line in plan.splitlines()) == 1 and "l_orderkey" not in plan
    assert chart.rdd.getNumPartitions() == made().rdd.getNumPartitions() and rows(chart) == rows(made())
    tables.drop()


@pytest.mark.parametrize("name", ["report_headerless_parts", "top_position_counts_from_csv", "enrich_ranking_from_files"])
def test_stored_names_are_dropped_when_the_file_is_written(spark, monkeypatch, name):
    stored, dropped = [], []
    keep, drop = Intermediates.stored, Intermediates.drop
    monkeypatch.setattr(Intermediates, "stored", lambda self, df, name: (keep(self, df, name), stored.append(self.paths[-1]))[0])
    monkeypatch.setattr(Intermediates, "drop", lambda self: (dropped.extend(self.paths), drop(self))[1])
    registry.QUERIES[name](Tables(spark, SF_SMALL))
    named = [p for p in stored if "chart-named" in p]
    assert len(named) == 1 and named[0] in dropped and not glob.glob(named[0].removeprefix("file:"))


def test_parts_of_one_name_are_one_track_of_the_chart(spark, scratch):
    def put(name, schema, *rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/{name}.parquet")

    put("nation", "n_nationkey int, n_name string", (1, "N"), (2, "N"))
    put("customer", "c_custkey long, c_nationkey int", (1, 1), (2, 2), (3, None))
    put("orders", "o_orderkey long, o_custkey long, o_orderdate string", (1, 1, "1997-03-04"), (2, 2, "1997-03-05"), (3, 3, "1997-03-05"))
    # Parts 1 and 2 share a name; so do 5 and 10, whose name is null, and the two rows of part 21.
    put("part", "p_partkey long, p_name string, p_brand string", (1, "a", "B"), (2, "a", "B"), (5, None, "B"), (10, None, "B"), (21, "c", "B"), (21, "c", "B"))
    put("lineitem", "l_orderkey long, l_partkey long, l_quantity double",
        *[(o, p, float(q)) for o, p, q in ((1, 1, 1), (1, 1, 2), (2, 2, 4), (1, 5, 8), (2, 10, 16), (1, 21, 32), (3, 1, 64), (1, 99, 128), (1, None, 1))], (2, 1, None))
    got = Tables(spark, scratch).chart_parts().collect()
    assert sorted((r.position, r.track, r.artist, r.streams) for r in got if r.track) == [(1, "c 5", "B", 64), (3, "a 0", "B", 7)]
    assert [(r.position, r.artist, r.streams, r.date, r.region, r.url) for r in got if not r.track] == [(2, "B, Jr.", 24, "1997-03-01", "N", None)]


@pytest.mark.parametrize("header", [True, False])
def test_the_chart_is_written_compressed_in_bounded_files(spark, monkeypatch, header):
    monkeypatch.setattr(sink_files, "COMPRESSED_ROWS", 30)
    chart = spark.createDataFrame([(i, f'T "{i}", x', "A", i, "u\u00e9", "1997-01-01", "N") for i in range(200)], RANKING).coalesce(2)
    path = files.chart_csv(chart, header=header)
    assert len(glob.glob(path.removeprefix("file:") + "/part-*.csv.gz")) >= 7
    assert rows(read_ranking(spark, path).drop("ord")) == sorted(tuple(map(str, r)) for r in chart.collect())


def test_the_extension_is_written_compressed_in_order(spark, monkeypatch):
    monkeypatch.setattr(sink_files, "COMPRESSED_ROWS", 15)
    ext = [(i, f"A{i}", f"S{i}", "CL" if i % 3 else None, "P" if i % 2 and i % 3 else None) for i in range(200)]
    path = files.extension_lines(spark.createDataFrame(ext[::-1], EXT))
    assert len(glob.glob(path.removeprefix("file:") + "/part-*.gz")) >= 14
    back = read_extension(spark, path).orderBy("ord").collect()
    assert [(r.artist, r.song, r.country, r.starting_place) for r in back] == [e[1:] for e in ext]


def test_written_steps_leave_no_shuffle_files(spark):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.splitlines() if "/shuffle_" in f}

    before, tables = shuffled(), Intermediates(spark)
    mine = tables.stored(spark.range(1000).repartition(3, "id"), "steps")
    chart = spark.createDataFrame([(i, "T", "A", i, "u", "1997-01-01", "N") for i in range(50)], RANKING)
    read = read_ranking(spark, files.chart_csv(chart.repartition(3, "position")))
    ext = read_extension(spark, files.extension_lines(spark.createDataFrame([(i, "A", "S", "C", "P") for i in range(50)], EXT)))
    for _ in range(20):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert (mine.count(), read.count(), ext.count()) == (1000, 50, 50)
    tables.drop()


def test_the_session_keeps_its_setting(spark):
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        1 / 0
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    with shuffles_released(spark):
        pass
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.unset(SHUFFLE_CLEANUP)
