"""Registered queries: one per job/operator of the blueprint, over the derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.constants import SERIES_TYPE
from hitlens.functions import strip_commas
from hitlens.operators.candidates import flatten_artists, flatten_works
from hitlens.operators.charts import top_artists, top_position_counts, top_songs
from hitlens.operators.enrich import containment_match, enrich_ranking, last_matches
from hitlens.operators.groups import series_mean, word_count
from hitlens.operators.resolve import distinct_pairs, related_works, resolve_pairs
from hitlens.plans import files
from hitlens.plans.fixtures import Tables, padded_lines
from hitlens.session import Intermediates
from hitlens.sources import (
    RESOLVED_FIELDS,
    parse_delimited,
    raw_lines,
    read_delimited,
    read_extended_ranking,
    read_extension,
    read_lines,
    read_ranking,
    read_response_dump,
    read_series,
)

# Fixed report parameters for the derived chart (its dates are month starts
# in 1995-2001 and its regions are nation names).
YEAR = "1997"
HOLIDAY_DATE = "1997-12-01"
REGION = "NATION_7"
REGION_DATE = "1997-09-01"
TOP_K = 10

ARTIST_ORDER = ("page", "pos")
WORK_ORDER = ("page", "pos", "item")


def _resolution_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return t.requests(), t.artist_candidates(), t.work_candidates()


def q_related_works(t: Tables) -> DataFrame:
    req, artists, works = _resolution_inputs(t)
    rel = related_works(req, artists, works, ARTIST_ORDER, WORK_ORDER)
    return rel.select("artist", "song", "arid", "score", "hit.result_artist", "hit.country", "hit.starting_place")


def q_resolve_pairs(t: Tables) -> DataFrame:
    req, artists, works = _resolution_inputs(t)
    return resolve_pairs(req, artists, works, ARTIST_ORDER, WORK_ORDER)


def q_containment_match(t: Tables) -> DataFrame:
    chart = t.chart()
    needles = chart.select(F.lower("artist").alias("la"), F.lower("track").alias("lt")).distinct()
    return containment_match(needles, last_matches(t.extension()))


def q_hot_key_match(t: Tables) -> DataFrame:
    """Needles of which every key is frequent: the artist and the song of each are in thousands of origins."""
    return containment_match(t.hot_needles(), last_matches(t.extension()))


def q_enrich_from_resolved(t: Tables) -> DataFrame:
    """Ranking -> distinct pairs -> resolution -> resolved pairs as the origin table -> enrichment.

    The resolved file's order is (artist, song); the struct ordinal keeps it.
    """
    chart = t.chart()
    # The worklist is a file of its own in the original job: written once, read by the resolution's steps.
    pairs = Intermediates(t.spark).stored(distinct_pairs(chart), "pairs")
    resolved = resolve_pairs(pairs, t.chart_artist_hits(), t.chart_work_hits())
    origins = resolved.select(F.struct("artist", "song").alias("ord"), "artist", "song", "country", "starting_place")
    return enrich_ranking(chart, origins)


def q_strip_commas(t: Tables) -> DataFrame:
    chart = t.chart()
    return chart.select("position", *[strip_commas(c).alias(c) for c in ("track", "artist")], "streams",
                        *[strip_commas(c).alias(c) for c in ("url", "date", "region")])


def _chart_file(t: Tables, chart: Callable[[Intermediates], DataFrame], header: bool = True) -> str:
    tables = Intermediates(t.spark)
    path = files.chart_csv(chart(tables), header=header)
    tables.drop()
    return path


def q_top_position_counts_from_csv(t: Tables) -> DataFrame:
    return top_position_counts(read_ranking(t.spark, _chart_file(t, t.chart)), year=YEAR)


def q_enrich_ranking_from_files(t: Tables) -> DataFrame:
    ranking = read_ranking(t.spark, _chart_file(t, t.chart))
    extension = read_extension(t.spark, files.extension_lines(t.extension()))
    return enrich_ranking(ranking, extension).drop("ord")


def q_series_mean_from_tsv(t: Tables) -> DataFrame:
    ratings = read_series(t.spark, files.series_tsv(t.series()))
    return series_mean(ratings, SERIES_TYPE).select("label", F.round("mean_rating", 6).alias("mean_rating"))


def q_word_count_from_text(t: Tables) -> DataFrame:
    return word_count(read_lines(t.spark, files.text_lines(padded_lines(t.texts()))))


def q_enrich_origin_totals(t: Tables) -> DataFrame:
    """Streams and rows of one region by origin: the ranking is cut before it is enriched."""
    enriched = enrich_ranking(t.chart().where(F.col("region") == REGION), t.extension())
    return enriched.groupBy("country", "begin_area").agg(F.sum("streams").alias("streams"), F.count(F.lit(1)).alias("n"))


def q_report_headerless_parts(t: Tables) -> DataFrame:
    return top_position_counts(read_ranking(t.spark, _chart_file(t, t.chart_parts, header=False)), year=YEAR)


def q_report_tuples_read_back(t: Tables) -> DataFrame:
    return read_lines(t.spark, files.tuples(top_artists(t.chart(), region=REGION), "streams", "artist"))


def q_mean_tuples_read_back(t: Tables) -> DataFrame:
    return read_lines(t.spark, files.tuples(word_count(padded_lines(t.texts())), "word", "n"))


def q_resolved_parts_read_back(t: Tables) -> DataFrame:
    """Resolved pairs written in several headered part files: every row comes back."""
    path = files.resolved_csv(q_resolve_pairs(t).repartition(6))
    return read_delimited(t.spark, path, RESOLVED_FIELDS).select(*RESOLVED_FIELDS)


def q_odd_rows_read_back(t: Tables) -> DataFrame:
    """Padded, quoted and empty fields survive the nine-column CSV."""
    return read_extended_ranking(t.spark, files.extended_csv(t.odd_rows())).drop("ord")


def q_ragged_lines(t: Tables) -> DataFrame:
    lines = raw_lines(t.spark, files.text_lines(t.ragged_lines()))
    return parse_delimited(lines, ["a", "b"]).select("a", "b", "width")


def q_flatten_works_from_dump(t: Tables) -> DataFrame:
    """All work pages as elements of two dump files, read by many tasks."""
    return flatten_works(read_response_dump(t.spark, files.response_dump(t.work_documents())))


def q_texts_with_line_breaks(t: Tables) -> DataFrame:
    """Whole texts as quoted fields over many lines."""
    path = files.quoted_csv(t.texts(), ["doc_id", "text"])
    return read_delimited(t.spark, path, ["doc_id", "text"]).select("doc_id", "text")


def q_extension_skipping_two(t: Tables) -> DataFrame:
    """Many origin folders, each of which loses its first two records."""
    return read_extension(t.spark, files.extension_parts(t.extension()), skip=2).select("artist", "song", "country", "starting_place")


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "top_position_counts": lambda t: top_position_counts(t.chart(), year=YEAR),
    "top_position_counts_top10": lambda t: top_position_counts(t.chart(), year=YEAR, k=TOP_K),
    "top_songs_on_date": lambda t: top_songs(t.chart(), date=HOLIDAY_DATE),
    "top_songs_region_date": lambda t: top_songs(t.chart(), date=REGION_DATE, region=REGION),
    "top_artists_region": lambda t: top_artists(t.chart(), region=REGION),
    "top_artists_region_top10": lambda t: top_artists(t.chart(), region=REGION, k=TOP_K),
    "series_mean": lambda t: series_mean(t.series(), SERIES_TYPE).select(
        "label", F.round("mean_rating", 6).alias("mean_rating")),
    "word_count": lambda t: word_count(padded_lines(t.texts()), keep_trailing=True),
    "word_count_trimmed": lambda t: word_count(padded_lines(t.texts()), keep_trailing=False),
    "distinct_pairs": lambda t: distinct_pairs(t.chart()),
    "flatten_artists": lambda t: flatten_artists(t.artist_documents()),
    "flatten_works": lambda t: flatten_works(t.work_documents()),
    "related_works": q_related_works,
    "resolve_pairs": q_resolve_pairs,
    "containment_match": q_containment_match,
    "hot_key_match": q_hot_key_match,
    "enrich_ranking": lambda t: enrich_ranking(t.chart(), t.extension()),
    "enrich_artist_totals": lambda t: top_artists(enrich_ranking(t.chart(), t.extension()), region=REGION),
    "enrich_origin_totals": q_enrich_origin_totals,
    "strip_commas": q_strip_commas,
    "enrich_from_resolved": q_enrich_from_resolved,
    # The same jobs fed through the file sources (written, then read back).
    "top_position_counts_from_csv": q_top_position_counts_from_csv,
    "enrich_ranking_from_files": q_enrich_ranking_from_files,
    "series_mean_from_tsv": q_series_mean_from_tsv,
    "word_count_from_text": q_word_count_from_text,
    # Written by the sinks, then read back.
    "report_headerless_parts": q_report_headerless_parts,
    "report_tuples_read_back": q_report_tuples_read_back,
    "mean_tuples_read_back": q_mean_tuples_read_back,
    "resolved_parts_read_back": q_resolved_parts_read_back,
    "odd_rows_read_back": q_odd_rows_read_back,
    "ragged_lines": q_ragged_lines,
    "flatten_works_from_dump": q_flatten_works_from_dump,
    "texts_with_line_breaks": q_texts_with_line_breaks,
    "extension_skipping_two": q_extension_skipping_two,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}
