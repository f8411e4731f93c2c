"""Per-group mean (series ratings) and word count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.constants import NULL_EPISODE, SERIES_TYPE
from hitlens.functions import label, parsed, split_words


def series_mean(
    ratings: DataFrame,
    series_type: str = SERIES_TYPE,
    excluded_episode: str = NULL_EPISODE,
) -> DataFrame:
    """Mean rating per ``series#year`` over rows of ``series_type`` with an episode.

    Input columns: rating, series, year, type, episode (text, as read from
    the TSV). ``episode`` is null only for rows too short to have one; such
    rows are skipped. An empty episode is kept; the literal text ``null`` is
    not. ``avg`` keeps a (sum, count) buffer that is merged map-side, so a
    series with a third of all episodes still aggregates in parallel.
    """
    cond = (
        (F.col("type") == F.lit(series_type))
        & F.col("episode").isNotNull()
        & (F.col("episode") != F.lit(excluded_episode))
    )
    return (
        ratings.where(cond)
        .groupBy(label("series", "year").alias("label"))
        .agg(F.avg(parsed(ratings, "rating", "double")).alias("mean_rating"))
    )


def word_count(lines: DataFrame, column: str = "value", keep_trailing: bool = True) -> DataFrame:
    """Occurrences of each word when every line is split on single spaces.

    ``keep_trailing`` selects between the two split conventions (see
    ``split_words``). Counting is partial per task before the shuffle on the
    word, so frequent words never concentrate raw rows in one task.
    """
    words = lines.select(F.explode(split_words(column, keep_trailing)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def lines_of(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row per line of every text (split on newline), column ``value``."""
    return texts.select(F.explode(F.split(F.col(column), "\n", -1)).alias("value"))
