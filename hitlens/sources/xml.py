"""Stored search-response documents.

A table of (query, page, doc) rows, where ``doc`` is one XML response page,
is the stored form of the candidate lookups; it is parsed by
``hitlens.operators.candidates`` with ``from_xml``. Fetching the pages over
HTTP is not part of this library. Pages may be rows of a table, small files of
their own, or elements of dump files of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_xml_documents(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    columns: Sequence[str] = ("query", "page", "doc"),
) -> DataFrame:
    """Read stored response pages (Parquet by default, or JSON lines)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format(fmt).load(paths).select(*columns)


def read_response_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per stored response file: (query, page, doc).

    Each file is read whole (a response page is small). Files are named
    ``<query>.xml`` or ``<query>.<page>.xml``; the page number (0 when
    absent) keeps the pages of one query in order. Files are independent
    rows, so parsing them spreads over all tasks.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.option("wholetext", True).text(paths)
    pattern = r"^(.*?)(?:\.(\d+))?(?:\.[^.]*)?$"
    # The metadata file name is URI-encoded; a literal '+' must survive decoding.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    page = F.regexp_extract(name, pattern, 2)
    return files.select(
        F.regexp_extract(name, pattern, 1).alias("query"),
        F.when(page == "", F.lit(0)).otherwise(page).cast("bigint").alias("page"),
        F.col("value").alias("doc"),
    )


def read_response_dump(
    spark: SparkSession,
    path: str | Sequence[str],
    row_tag: str = "response",
    query: str = "query",
    page: str = "page",
) -> DataFrame:
    """Pages of dump files: (query, page, doc), one row per ``row_tag`` element.

    A dump is any number of elements such as
    ``<response query="a b" page="0"><metadata>...</metadata></response>``, with
    or without an element around them all. Records end at the closing tag,
    which splits a file of any size: an element that crosses a border between
    splits belongs to the one where it starts. The attributes are carried to
    the page (a missing query is ``''``, a missing page 0). ``doc`` is the
    content as it stands. The closing tag must not occur inside an element (in
    a comment or a CDATA section), nor may elements of this tag be nested or
    empty tags. The content of an element that its file leaves open is no XML
    and fails when it is flattened.
    """
    paths = [path] if isinstance(path, str) else list(path)
    close = f"</{row_tag}>"
    parts = spark.read.option("lineSep", close).text(paths)
    attributes = r"""((?:\s+[\w:.-]+\s*=\s*(?:"[^"]*+"|'[^']*+'))*+)"""
    pattern = rf"(?s)<{re.escape(row_tag)}{attributes}\s*+>(.*)\z"
    found = parts.select(*[F.regexp_extract("value", pattern, i).alias(name) for i, name in ((1, "attributes"), (2, "doc"))], "value")
    found = found.where(F.col("value").rlike(rf"<{re.escape(row_tag)}(?=[\s>])"))
    bad = F.raise_error(F.concat(F.lit("no page: "), F.left("value", F.lit(200)))).cast("string")
    found = found.withColumn("doc", F.when(F.col("value").rlike(pattern), F.col("doc")).otherwise(bad))
    read = F.from_xml(F.concat(F.lit("<p"), F.col("attributes"), F.lit("/>")), f"`_{query}` STRING, `_{page}` BIGINT", {"mode": "FAILFAST"})
    named = found.select(read.alias("p"), "doc")
    return named.select(
        F.coalesce(F.col("p")[f"_{query}"], F.lit("")).alias("query"), F.coalesce(F.col("p")[f"_{page}"], F.lit(0).cast("bigint")).alias("page"), "doc")
