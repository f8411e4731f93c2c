"""Resolve (artist, song) pairs to the best-matching candidate artist.

Per request (artist A, song S), with ``a = normalise_artist(A)`` and
``s = lower(S)``:

* candidates: artist hits for query ``a`` (ordered), works: work hits for
  query ``s`` (ordered);
* work-backed: a candidate and a work with the same artist id (``''`` ids
  join each other), the candidate's lower-cased name containing ``a`` and
  the work's lower-cased title containing ``s``; score
  ``|len(name) - len(a)| + |len(title) - len(s)|``; best = lowest score,
  then earliest candidate, then earliest work;
* otherwise artist-only: the candidate's lower-cased name contains ``a`` or
  the original ``A``; score ``|len(name) - len(A)|``; best = lowest score,
  then earliest candidate;
* otherwise blanks.

The work-backed score is a sum of a candidate term and a work term that are
independent once the artist id is fixed. So per (query, artist id) only the
best candidate and the best work can be part of the answer, and the id join
is 1:1 between those two reductions: no candidate x work product is formed,
even for a shared or empty id. Both reductions and the per-request pick are
``min``/``min_by`` aggregations, combined map-side before their shuffle.

Fan-out: hits of queries that nobody asks for are pruned first. Request,
candidate and work then form a triangle - request (a, s), candidate (a, id),
work (s, id) - and a plan of two joins in one order could make an intermediate
far larger than its inputs: an id with thousands of candidates and thousands of
works multiplies when it is joined on the id first. So ids are split by
their degrees. A **light** id has at most ``LIGHT`` candidates or at most
``LIGHT`` works: joined on the id it makes at most ``LIGHT`` rows per row of
the larger side. A **heavy** id goes through the requests, each of which meets
only the candidates of its own artist query. No intermediate is larger than
``LIGHT`` x (candidates + works) + requests x candidates of one query. The
empty id is no id to meet on; there, the one best candidate and the one best
work of a request's two queries are looked up by query. The artist-only arm
runs once per distinct artist, not per pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.functions import blank_if_null, length_gap, normalise_artist
from hitlens.session import Intermediates

# Candidates or works up to which an id is joined on the id.
LIGHT = 8

RESULT_FIELDS = ("result_artist", "country", "starting_place")


def distinct_pairs(ranking: DataFrame, artist: str = "artist", track: str = "track") -> DataFrame:
    """Unique (artist, song) pairs of a ranking: the resolution worklist."""
    return ranking.select(F.col(artist).alias("artist"), F.col(track).alias("song")).distinct()


def _order(cols: Sequence[str], prefix: str) -> list[F.Column]:
    return [F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(cols)]


def _candidates(artist_hits: DataFrame, artist_order: Sequence[str]) -> DataFrame:
    return artist_hits.select(
        F.col("query"),
        blank_if_null("arid").alias("arid"),
        F.lower(blank_if_null("name")).alias("lname"),
        F.struct(
            blank_if_null("name").alias("result_artist"),
            blank_if_null("country").alias("country"),
            blank_if_null("begin_area").alias("starting_place"),
        ).alias("hit"),
        F.struct(*_order(artist_order, "a")).alias("a_ord"),
    )


def best_candidates_per_id(artist_hits: DataFrame, artist_order: Sequence[str] = ("ord",)) -> DataFrame:
    """Per (query, arid): the name-matching candidate with the lowest name term, then earliest."""
    c = _candidates(artist_hits, artist_order).where(F.col("lname").contains(F.col("query")))
    rank = F.struct(length_gap("lname", "query").alias("cs"), F.col("a_ord"))
    return c.groupBy("query", "arid").agg(F.min_by(F.struct(rank.alias("r"), "hit"), rank).alias("b")).select(
        "query", "arid", F.col("b.r.cs").alias("cs"), F.col("b.r.a_ord").alias("a_ord"), F.col("b.hit").alias("hit")
    )


def best_works_per_id(work_hits: DataFrame, work_order: Sequence[str] = ("ord",)) -> DataFrame:
    """Per (query, arid): the title-matching work with the lowest title term, then earliest."""
    w = work_hits.select(
        "query",
        blank_if_null("arid").alias("arid"),
        F.lower(blank_if_null("title")).alias("ltitle"),
        F.struct(*_order(work_order, "w")).alias("w_ord"),
    ).where(F.col("ltitle").contains(F.col("query")))
    rank = F.struct(length_gap("ltitle", "query").alias("ws"), F.col("w_ord"))
    return w.groupBy("query", "arid").agg(F.min(rank).alias("b")).select(
        "query", "arid", F.col("b.ws").alias("ws"), F.col("b.w_ord").alias("w_ord")
    )


def _keyed_requests(requests: DataFrame) -> DataFrame:
    return requests.select("artist", "song").distinct().select(
        "artist", "song", normalise_artist("artist").alias("a"), F.lower("song").alias("s")
    )


def heavy_ids(cands: DataFrame, works: DataFrame, light: int = LIGHT) -> DataFrame:
    """(arid): ids with more than ``light`` candidates and more than ``light`` works.

    Counts are combined map-side; candidates and works have one row per (query, id).
    """
    many = [side.where("arid <> ''").groupBy("arid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > light).select("arid") for side in (cands, works)]
    return many[0].join(many[1], "arid")


def by_light_id(req: DataFrame, cands: DataFrame, works: DataFrame, heavy: DataFrame) -> DataFrame:
    """Requests with the candidates and works that share a light id: on the id first."""
    of_id = cands.where("arid <> ''").join(heavy, "arid", "left_anti").join(works, "arid")
    return req.join(of_id, ["a", "s"])


def by_heavy_id(req: DataFrame, cands: DataFrame, works: DataFrame, heavy: DataFrame) -> DataFrame:
    """Requests with the candidates and works that share a heavy id: each request's own candidates first."""
    asked = req.join(cands.join(heavy, "arid", "left_semi"), "a")
    return asked.join(works.join(heavy, "arid", "left_semi"), ["s", "arid"])


def related_works(
    requests: DataFrame,
    artist_hits: DataFrame,
    work_hits: DataFrame,
    artist_order: Sequence[str] = ("ord",),
    work_order: Sequence[str] = ("ord",),
    light: int = LIGHT,
) -> DataFrame:
    """Best work-backed candidate per (request, artist id).

    The reductions run now and are written to the shared folder, from which the
    result reads them; ``drop_stored`` removes the tables named ``resolve-``.

    Columns: artist, song, arid, score, a_ord, w_ord, hit (struct of the result fields).
    """
    req = _keyed_requests(requests)
    artist_hits = artist_hits.join(req.select(F.col("a").alias("query")).distinct(), "query", "left_semi")
    work_hits = work_hits.join(req.select(F.col("s").alias("query")).distinct(), "query", "left_semi")
    # Each is read several times below: written once, not reduced again for every use.
    tables = Intermediates(requests.sparkSession)
    cands = tables.stored(best_candidates_per_id(artist_hits, artist_order).withColumnRenamed("query", "a"), "resolve-candidates")
    works = tables.stored(best_works_per_id(work_hits, work_order).withColumnRenamed("query", "s"), "resolve-works")
    heavy = tables.stored(heavy_ids(cands, works, light), "resolve-heavy")
    # At most one row per query on each side.
    blank = req.join(cands.where("arid = ''"), "a").join(works.where("arid = ''").drop("arid"), "s")
    columns = ["artist", "song", "arid", "cs", "ws", "a_ord", "w_ord", "hit"]
    found = by_light_id(req, cands, works, heavy).select(columns).unionByName(by_heavy_id(req, cands, works, heavy).select(columns))
    return found.unionByName(blank.select(columns)).select(
        "artist", "song", "arid", (F.col("cs") + F.col("ws")).alias("score"), "a_ord", "w_ord", "hit")


def resolve_pairs(
    requests: DataFrame,
    artist_hits: DataFrame,
    work_hits: DataFrame,
    artist_order: Sequence[str] = ("ord",),
    work_order: Sequence[str] = ("ord",),
    keep: Sequence[str] = ("ord",),
) -> DataFrame:
    """(artist, song, result_artist, country, starting_place) for every request row.

    Columns of ``keep`` that the requests have (the file ordinal by default)
    come first, so that the result can be written in input order.

    ``artist_hits``: query, name, country, arid, begin_area + ``artist_order`` columns.
    ``work_hits``: query, arid, title + ``work_order`` columns.

    The distinct pairs are written first: the reductions read them in turn, and what made the requests isn't run again for each.
    """
    pairs = Intermediates(requests.sparkSession).stored(requests.select("artist", "song").distinct(), "resolve-requests")
    related = related_works(pairs, artist_hits, work_hits, artist_order, work_order)
    backed = related.groupBy("artist", "song").agg(
        F.min_by("hit", F.struct("score", "a_ord", "w_ord")).alias("backed")
    )

    # Artist-only arm depends on the original artist alone, not the song.
    originals = pairs.select("artist").distinct().select("artist", normalise_artist("artist").alias("a"))
    asked = originals.select(F.col("a").alias("query")).distinct()
    cands = _candidates(artist_hits.join(asked, "query", "left_semi"), artist_order).withColumnRenamed("query", "a")
    only = (
        originals.join(cands, "a")
        .where(F.col("lname").contains(F.col("a")) | F.col("lname").contains(F.col("artist")))
        .groupBy("artist")
        .agg(F.min_by("hit", F.struct(length_gap("lname", "artist"), F.col("a_ord"))).alias("only"))
    )

    best = F.coalesce(F.col("backed"), F.col("only"))
    kept = [c for c in keep if c in requests.columns]
    return (
        requests.select(*kept, "artist", "song")
        .join(backed, ["artist", "song"], "left")
        .join(only, "artist", "left")
        .select(*kept, "artist", "song", *[blank_if_null(best[f]).alias(f) for f in RESULT_FIELDS])
    )
