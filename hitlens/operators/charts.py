"""Ranking reports over a daily chart (columns position, track, artist, streams, date, region).

Each report is ``where -> groupBy -> partial/final aggregate -> sort``. The
filter reaches the scan (Parquet ``PushedFilters``), only the referenced
columns are read, and the aggregation is combined map-side before the one
shuffle on the label, so a hot song or artist costs one row per task, not
one row per stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.constants import TOP_POSITION, TOP_YEAR
from hitlens.functions import label, parsed, text_equals


def _ordered(df: DataFrame, value: str, key: str, k: int | None) -> DataFrame:
    # Ties on the value are ordered by the key so the report is deterministic.
    out = df.orderBy(F.col(value).desc(), F.col(key).asc())
    return out.limit(k) if k is not None else out


def _streams_total(ranking: DataFrame) -> F.Column:
    # Text streams are parsed after the filter, so a malformed value in a row
    # that the report never looks at is ignored, and one in a kept row fails
    # the job, as an integer parse would.
    return F.sum(parsed(ranking, "streams", "bigint")).alias("streams")


def _without(cond: F.Column, exclude_regions: Sequence[str]) -> F.Column:
    # Worldwide reports count every region; a feed that also carries a
    # worldwide pseudo-region can drop it here.
    return cond & ~F.col("region").isin(list(exclude_regions)) if exclude_regions else cond


def top_position_counts(
    ranking: DataFrame,
    year: str = TOP_YEAR,
    position: int = TOP_POSITION,
    k: int | None = None,
    exclude_regions: Sequence[str] = (),
) -> DataFrame:
    """How many times each ``track#artist`` held ``position`` in a date containing ``year``.

    All regions are counted together. Returns ``(n, label)`` ordered by ``n``
    descending, then label; ``k`` keeps the top ``k`` rows only.
    """
    cond = text_equals(ranking, "position", position) & F.col("date").contains(year)
    rows = ranking.where(_without(cond, exclude_regions))
    counts = rows.groupBy(label("track", "artist").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return _ordered(counts.select("n", "label"), "n", "label", k)


def top_songs(
    ranking: DataFrame,
    date: str,
    region: str | None = None,
    k: int | None = None,
    exclude_regions: Sequence[str] = (),
) -> DataFrame:
    """Total streams per ``track#artist`` on ``date`` (optionally in one ``region``)."""
    cond = F.col("date") == F.lit(date)
    if region is not None:
        cond = cond & (F.col("region") == F.lit(region))
    totals = ranking.where(_without(cond, exclude_regions)).groupBy(label("track", "artist").alias("label")).agg(
        _streams_total(ranking)
    )
    return _ordered(totals.select("streams", "label"), "streams", "label", k)


def top_artists(ranking: DataFrame, region: str, k: int | None = None) -> DataFrame:
    """Total streams per artist in ``region`` over every date."""
    totals = ranking.where(F.col("region") == F.lit(region)).groupBy("artist").agg(_streams_total(ranking))
    return _ordered(totals.select("streams", "artist"), "streams", "artist", k)
