"""The derived tables have the sizes FIXTURES.md documents (sf0.001)."""

from hitlens.plans import fixtures
from tests.conftest import SF_SMALL


def test_documented_sizes(spark):
    t = fixtures.Tables(spark, SF_SMALL)
    chart = t.chart()
    assert chart.count() == 5893
    assert chart.select("artist", "track").distinct().count() == 200
    assert chart.where("position = 1 AND date LIKE '1997%'").count() == 148
    assert t.requests().count() == 34
    assert fixtures.artist_hits(spark, SF_SMALL).count() == 30
    assert fixtures.work_hits(spark, SF_SMALL).count() == 737
    assert t.series().where("type = 'TV_SERIES'").select("year").distinct().count() == 15
