import pytest

from hitlens.operators.charts import top_artists, top_position_counts, top_songs

COLS = "position string, track string, artist string, streams string, url string, date string, region string"


def ranking(spark, data):
    return spark.createDataFrame(data, COLS)


def test_top_position_counts_ties_and_labels(spark):
    data = [
        ("1", "S", "A", "10", "u", "2017-01-01", "cl"),
        ("1", "S", "A", "10", "u", "2017-01-02", "ar"),
        ("1", "T", "B", "10", "u", "2017-01-01", "ar"),
        ("1", "", "A", "10", "u", "2017-03-01", "cl"),
        ("2", "S", "A", "10", "u", "2017-01-01", "us"),
        ("1", "S", "A", "10", "u", "2016-01-01", "us"),
    ]
    out = [tuple(r) for r in top_position_counts(ranking(spark, data), year="2017").collect()]
    assert out == [(2, "S#A"), (1, "#A"), (1, "T#B")]


def test_top_k_keeps_order(spark):
    data = [("1", f"S{i}", "A", "1", "u", "2017-01-01", "cl") for i in range(5)]
    out = [tuple(r) for r in top_position_counts(ranking(spark, data), year="2017", k=2).collect()]
    assert out == [(1, "S0#A"), (1, "S1#A")]


def test_top_songs_and_artists(spark):
    data = [
        ("1", "S", "A", "5", "u", "2017-12-25", "cl"),
        ("2", "S", "A", "7", "u", "2017-12-25", "ar"),
        ("3", "T", "B", "20", "u", "2017-12-25", "cl"),
        ("4", "T", "B", "x", "u", "2017-12-24", "cl"),  # malformed, but filtered out
    ]
    df = ranking(spark, data)
    assert [tuple(r) for r in top_songs(df, "2017-12-25").collect()] == [(20, "T#B"), (12, "S#A")]
    assert [tuple(r) for r in top_songs(df, "2017-12-25", region="ar").collect()] == [(7, "S#A")]
    assert [tuple(r) for r in top_songs(df, "2017-12-24", region="cl").filter("false").collect()] == []


def test_malformed_streams_in_kept_row_fails(spark):
    df = ranking(spark, [("1", "S", "A", "x", "u", "2017-12-25", "cl")])
    with pytest.raises(Exception):
        top_artists(df, "cl").collect()


def test_sums_do_not_wrap(spark):
    big = str(2**31 - 1)
    df = ranking(spark, [("1", "S", "A", big, "u", "d", "cl"), ("2", "S", "A", big, "u", "d", "cl")])
    assert top_artists(df, "cl").first()[0] == 2 * (2**31 - 1)


def test_exclude_regions(spark):
    data = [("1", "S", "A", "5", "u", "2017-12-25", "global"), ("1", "S", "A", "7", "u", "2017-12-25", "cl")]
    df = ranking(spark, data)
    assert [tuple(r) for r in top_songs(df, "2017-12-25", exclude_regions=["global"]).collect()] == [(7, "S#A")]
    assert top_position_counts(df, "2017", exclude_regions=["global"]).first()[0] == 1
