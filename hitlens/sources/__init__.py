"""File sources: quoted/ragged CSV with file order, naive TSV, text lines, XML columns."""

from hitlens.sources.delimited import (
    EXTENDED_FIELDS,
    PAIR_FIELDS,
    RANKING_FIELDS,
    RESOLVED_FIELDS,
    parse_delimited,
    raw_lines,
    read_delimited,
    read_extended_ranking,
    read_extension,
    read_lines,
    read_pairs,
    read_ranking,
    read_series,
    records,
    skip_records,
)
from hitlens.sources.xml import read_response_dump, read_response_files, read_xml_documents

__all__ = [
    "EXTENDED_FIELDS",
    "PAIR_FIELDS",
    "RANKING_FIELDS",
    "RESOLVED_FIELDS",
    "parse_delimited",
    "raw_lines",
    "read_delimited",
    "read_extended_ranking",
    "read_extension",
    "read_lines",
    "read_pairs",
    "read_ranking",
    "read_series",
    "records",
    "skip_records",
    "read_response_dump",
    "read_response_files",
    "read_xml_documents",
]
