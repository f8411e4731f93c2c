"""Command line for the jobs: ``python -m hitlens <job> <inputs...> <output> [options]``.

Each job reads its input files, runs the operator and writes the output in
the original format (``(value,key)`` tuple text for reports, headered CSV
for tables). Run under ``spark-submit`` on a cluster; without a master it
runs locally.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from hitlens import constants as C
from hitlens.operators import (
    distinct_pairs,
    enrich_ranking,
    flatten_artists,
    flatten_works,
    resolve_pairs,
    series_mean,
    top_artists,
    top_position_counts,
    top_songs,
    word_count,
)
from hitlens.session import shared_dir
from hitlens.sinks import write_csv, write_extended_ranking, write_resolved, write_tuples
from hitlens.sources import read_extension, read_lines, read_pairs, read_ranking, read_response_dump, read_response_files, read_series


def _job(jobs, name: str, help_text: str, *positional: str) -> argparse.ArgumentParser:
    job = jobs.add_parser(name, help=help_text)
    for arg in positional:
        job.add_argument(arg)
    return job


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m hitlens")
    jobs = p.add_subparsers(dest="job", required=True)

    j = _job(jobs, "top-position-counts", "times each title#artist held a position in a year", "ranking", "output")
    j.add_argument("--year", default=C.TOP_YEAR)
    j.add_argument("--position", type=int, default=C.TOP_POSITION)
    j.add_argument("--top", type=int, help="keep the first K rows only")

    j = _job(jobs, "top-songs", "total streams per title#artist on a date", "ranking", "output")
    j.add_argument("--date", default=C.HOLIDAY_DATE)
    j.add_argument("--region", help="one region only")
    j.add_argument("--top", type=int, help="keep the first K rows only")

    j = _job(jobs, "top-artists", "total streams per artist in a region", "ranking", "output")
    j.add_argument("--region", default=C.HOME_REGION)
    j.add_argument("--top", type=int, help="keep the first K rows only")

    j = _job(jobs, "series-mean", "mean rating per series#year", "ratings", "output")
    j.add_argument("--type", default=C.SERIES_TYPE)

    j = _job(jobs, "word-count", "occurrences of each space-separated word", "text", "output")
    j.add_argument("--drop-trailing", action="store_true", help="JVM split rule: no trailing empty words")

    _job(jobs, "distinct-pairs", "unique (artist, song) pairs of a ranking", "ranking", "output")
    j = _job(jobs, "resolve", "best-matching artist for each (artist, song) pair",
             "pairs", "artist_pages", "work_pages", "output")
    j.add_argument("--dump", action="store_true", help="the pages are elements of dump files, not files of their own")

    j = _job(jobs, "enrich", "append country and begin area to every ranking row", "ranking", "origins", "output")
    j.add_argument("--skip", type=int, help="drop the first N records of the origins instead of a spelled header")
    return p


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    a = _parser().parse_args(list(argv))
    if a.job == "top-position-counts":
        report = top_position_counts(read_ranking(spark, a.ranking), a.year, a.position, a.top)
        write_tuples(report, a.output, "n", "label")
    elif a.job == "top-songs":
        write_tuples(top_songs(read_ranking(spark, a.ranking), a.date, a.region, a.top), a.output, "streams", "label")
    elif a.job == "top-artists":
        write_tuples(top_artists(read_ranking(spark, a.ranking), a.region, a.top), a.output, "streams", "artist")
    elif a.job == "series-mean":
        write_tuples(series_mean(read_series(spark, a.ratings), a.type), a.output, "label", "mean_rating")
    elif a.job == "word-count":
        counts = word_count(read_lines(spark, a.text), keep_trailing=not a.drop_trailing)
        write_tuples(counts, a.output, "word", "n")
    elif a.job == "distinct-pairs":
        write_csv(distinct_pairs(read_ranking(spark, a.ranking)), a.output, columns=["artist", "song"])
    elif a.job == "resolve":
        read_pages = read_response_dump if a.dump else read_response_files
        artists = flatten_artists(read_pages(spark, a.artist_pages))
        works = flatten_works(read_pages(spark, a.work_pages))
        resolved = resolve_pairs(read_pairs(spark, a.pairs), artists, works, ("page", "pos"), ("page", "pos", "item"))
        write_resolved(resolved, a.output)
    elif a.job == "enrich":
        write_extended_ranking(enrich_ranking(read_ranking(spark, a.ranking), read_extension(spark, a.origins, skip=a.skip)), a.output)


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    spark = SparkSession.builder.appName("hitlens").getOrCreate()
    shared_dir(spark)  # fail early on a cluster without spark.checkpoint.dir
    run(spark, sys.argv[1:] if argv is None else argv)


if __name__ == "__main__":
    main()
