"""Spark-native analytics for daily song rankings and artist metadata.

Pure ``DataFrame -> DataFrame`` operators; the caller owns the session.
"""

from hitlens.operators import (
    containment_match,
    distinct_pairs,
    enrich_ranking,
    flatten_artists,
    flatten_works,
    last_matches,
    lines_of,
    related_works,
    resolve_pairs,
    series_mean,
    top_artists,
    top_position_counts,
    top_songs,
    word_count,
)
from hitlens.sinks import (
    write_csv,
    write_extended_ranking,
    write_ranking_table,
    write_resolved,
    write_table,
    write_tuples,
)
from hitlens.sources import (
    read_extended_ranking,
    read_extension,
    read_lines,
    read_pairs,
    read_ranking,
    read_response_files,
    read_series,
    read_xml_documents,
)

__version__ = "0.1.0"

__all__ = [
    "containment_match",
    "distinct_pairs",
    "enrich_ranking",
    "flatten_artists",
    "flatten_works",
    "last_matches",
    "lines_of",
    "read_extended_ranking",
    "read_extension",
    "read_lines",
    "read_pairs",
    "read_ranking",
    "read_response_files",
    "read_series",
    "read_xml_documents",
    "related_works",
    "resolve_pairs",
    "series_mean",
    "top_artists",
    "top_position_counts",
    "top_songs",
    "word_count",
    "write_csv",
    "write_extended_ranking",
    "write_ranking_table",
    "write_resolved",
    "write_table",
    "write_tuples",
]
