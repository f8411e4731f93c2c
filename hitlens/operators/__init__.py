"""User-level jobs: chart reports, group means, word count, candidate
flattening, pair resolution and origin enrichment."""

from hitlens.operators.candidates import flatten_artists, flatten_works
from hitlens.operators.charts import top_artists, top_position_counts, top_songs
from hitlens.operators.enrich import containment_match, enrich_ranking, last_matches
from hitlens.operators.groups import lines_of, series_mean, word_count
from hitlens.operators.resolve import distinct_pairs, related_works, resolve_pairs

__all__ = [
    "containment_match",
    "distinct_pairs",
    "enrich_ranking",
    "flatten_artists",
    "flatten_works",
    "last_matches",
    "lines_of",
    "related_works",
    "resolve_pairs",
    "series_mean",
    "top_artists",
    "top_position_counts",
    "top_songs",
    "word_count",
]
