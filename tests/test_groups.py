from hitlens.operators.groups import lines_of, series_mean, word_count
from tests.conftest import rows


def test_series_mean_rules(spark):
    data = [
        ("8.0", "Show", "2001", "TV_SERIES", "e1"),
        ("6.0", "Show", "2001", "TV_SERIES", ""),       # empty episode with more fields: kept
        ("1.0", "Show", "2001", "TV_SERIES", "null"),   # literal null: dropped
        ("1.0", "Show", "2001", "TV_SERIES", None),     # row too short: skipped
        ("9.0", "Film", "1999", "MOVIE", "x"),
    ]
    df = spark.createDataFrame(data, "rating string, series string, year string, type string, episode string")
    assert rows(series_mean(df)) == [("Show#2001", 7.0)]


def test_word_count_both_conventions(spark):
    df = spark.createDataFrame([("a b  ",), ("",), ("  ",), (" a",)], "value string")
    assert rows(word_count(df, keep_trailing=True)) == [("", 7), ("a", 2), ("b", 1)]
    assert rows(word_count(df, keep_trailing=False)) == [("", 2), ("a", 2), ("b", 1)]


def test_lines_of_splits_texts(spark):
    df = spark.createDataFrame([(1, "x y\nz"), (2, "z")], "doc_id long, text string")
    assert rows(word_count(lines_of(df))) == [("x", 1), ("y", 1), ("z", 2)]
