from pyspark.sql import functions as F

from hitlens.functions import label, normalise_artist, split_words, strip_commas


def test_split_words_variants(spark):
    df = spark.createDataFrame([("a b  ",), ("",), ("  ",), (" a",)], "v string")
    kept = [r[0] for r in df.select(split_words("v", True)).collect()]
    trimmed = [r[0] for r in df.select(split_words("v", False)).collect()]
    assert kept == [["a", "b", "", ""], [""], ["", "", ""], ["", "a"]]
    assert trimmed == [["a", "b"], [""], [], ["", "a"]]


def test_normalise_is_one_pass(spark):
    df = spark.createDataFrame([("Simon & Garfunkel",), ("A   B",), ("X&&Y",)], "v string")
    out = [r[0] for r in df.select(normalise_artist("v")).collect()]
    assert out == ["simon garfunkel", "a  b", "xy"]


def test_label_keeps_empty_and_nulls_propagate(spark):
    df = spark.createDataFrame([("", "A"), ("t", None)], "a string, b string")
    out = [r[0] for r in df.select(label("a", "b")).collect()]
    assert out == ["#A", None]


def test_strip_commas(spark):
    df = spark.createDataFrame([("Me, Myself, I",)], "v string")
    assert df.select(strip_commas("v")).first()[0] == "Me Myself I"


def test_lower_is_unicode(spark):
    df = spark.createDataFrame([("İ",)], "v string")
    assert df.select(F.length(F.lower("v"))).first()[0] == 2
