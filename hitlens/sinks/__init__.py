"""Sinks: tuple text files, headered CSV, Parquet."""

from hitlens.sinks.files import (
    write_csv,
    write_extended_ranking,
    write_ranking_table,
    write_resolved,
    write_table,
    write_tuples,
)

__all__ = [
    "write_csv",
    "write_extended_ranking",
    "write_ranking_table",
    "write_resolved",
    "write_table",
    "write_tuples",
]
