"""Flatten stored candidate documents (artist and work search responses) to rows.

Documents are parsed with the built-in ``from_xml`` against an explicit
schema. Declaring every repeatable element as an array turns the
"one element or a list" ambiguity of XML into one shape: a single element
becomes a one-element array, a missing one becomes null (no rows). Each
document is flattened independently, so the work is spread over all tasks
and nothing is gathered per query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.constants import (
    ARTIST,
    ARTIST_LIST,
    ARTIST_TARGET,
    BEGIN_AREA,
    RELATION,
    RELATION_LIST,
    TARGET_TYPE,
    WHITE_SPACE,
    WORK,
    WORK_LIST,
)
from hitlens.functions import blank_if_null

# Attributes are read with the "_" prefix; repeatable elements are arrays.
ARTIST_SCHEMA = (
    f"`{ARTIST_LIST}` STRUCT<{ARTIST}: ARRAY<STRUCT<"
    f"_id: STRING, name: STRING, country: STRING, `{BEGIN_AREA}`: STRUCT<name: STRING>>>>"
)
WORK_SCHEMA = (
    f"`{WORK_LIST}` STRUCT<{WORK}: ARRAY<STRUCT<"
    f"title: STRING, `{RELATION_LIST}`: ARRAY<STRUCT<`_{TARGET_TYPE}`: STRING, "
    f"{RELATION}: ARRAY<STRUCT<{ARTIST}: ARRAY<STRUCT<_id: STRING, name: STRING>>>>>>>>>"
)
# Attribute values keep their surrounding spaces; element text is trimmed below.
# A page that is no XML fails the job: a lost page would look like "no hits".
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}


def _text(c: F.Column) -> F.Column:
    """Element text without surrounding white space; absent or blank text is ``''``."""
    return F.btrim(blank_if_null(c), F.lit(WHITE_SPACE))


def _explode_present(df: DataFrame, keep: Sequence[str], array: F.Column, pos: str, value: str) -> DataFrame:
    """``posexplode`` that parses each document once.

    For a plain ``posexplode`` Spark infers a ``size(array) > 0`` filter and
    places it below the projection, which evaluates ``from_xml`` a second
    time per document. The outer form infers nothing; its one null row for
    an empty or missing list is dropped after the explode instead.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, value))
    return rows.where(F.col(pos).isNotNull())


def flatten_artists(docs: DataFrame, doc: str = "doc", keep: Sequence[str] = ("query", "page")) -> DataFrame:
    """One row per artist element: ``keep`` + (pos, name, country, arid, begin_area).

    ``pos`` is the element's position in its document; absent attributes are ``''``.
    """
    parsed = docs.select(*keep, F.from_xml(F.col(doc), ARTIST_SCHEMA, XML_OPTIONS).alias("x"))
    rows = _explode_present(parsed, keep, F.col("x")[ARTIST_LIST][ARTIST], "pos", "a")
    a = F.col("a")
    return rows.select(
        *keep,
        "pos",
        _text(a["name"]).alias("name"),
        _text(a["country"]).alias("country"),
        blank_if_null(a["_id"]).alias("arid"),
        _text(a[BEGIN_AREA]["name"]).alias("begin_area"),
    )


def flatten_works(docs: DataFrame, doc: str = "doc", keep: Sequence[str] = ("query", "page")) -> DataFrame:
    """One row per artist related to a work: ``keep`` + (pos, item, arid, name, title).

    Walks work -> relation-list (target type ``artist`` only) -> relation ->
    artist, carrying the work title down. ``pos`` is the work's position in
    its document and ``item`` the artist's position within the work, so
    (page, pos, item) is the document order of the unrolled list.
    """
    parsed = docs.select(*keep, F.from_xml(F.col(doc), WORK_SCHEMA, XML_OPTIONS).alias("x"))
    works = _explode_present(parsed, keep, F.col("x")[WORK_LIST][WORK], "pos", "w")
    artists = F.flatten(
        F.transform(
            F.filter(F.col("w")[RELATION_LIST], lambda rl: rl[f"_{TARGET_TYPE}"] == F.lit(ARTIST_TARGET)),
            lambda rl: F.flatten(
                F.transform(
                    # A list or relation without content has no artists; it must not hide its siblings.
                    F.coalesce(rl[RELATION], F.array().cast(f"array<struct<{ARTIST}:array<struct<_id:string,name:string>>>>")),
                    lambda r: F.coalesce(r[ARTIST], F.array().cast("array<struct<_id:string,name:string>>")),
                )
            ),
        )
    )
    rows = _explode_present(works.select(*keep, "pos", F.col("w")["title"].alias("title"), artists.alias("_arts")),
                            [*keep, "pos", "title"], F.col("_arts"), "item", "a")
    return rows.select(
        *keep,
        "pos",
        "item",
        blank_if_null(F.col("a")["_id"]).alias("arid"),
        _text(F.col("a")["name"]).alias("name"),
        _text(F.col("title")).alias("title"),
    )
