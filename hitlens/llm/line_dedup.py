"""Corpus-wide line dedup over levelled sorted runs of line hashes.

Runs are bucketed and sorted by line hash and hold each line once, with its
documents and its largest document. Each batch of documents, bucketed alike, is
merge-anti-joined with the runs; the lines that none of them holds become a run
of its own, and what the batch adds to known lines is kept beside the runs. Full
levels are merged, two runs at a time, into a run of the next level, and the
additions with each other. As all have the same buckets, only a batch's own lines
are ever exchanged, and none of these joins sorts. Lines that the whole index
finds frequent are then dropped. DataFrame functions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm.common import BLANKS, ascii_lower, boxed, own, stored
from hitlens.session import drop_stored, stored_table_path

LEAST_CHARS = 40
LEAST_DOCS = 5
#: Runs per level before they are merged into one run of the next level.
FANOUT = 4
#: Batches that one table is cut into, enough to compact a level twice.
BATCHES = 2 * FANOUT + 1
HASH = ("h1", "h2")


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hashes(key: Column) -> list[Column]:
    """A 128-bit hash of the key."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def document_lines(docs: DataFrame, key: str, text: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, text_hash, h1, h2): each long line key of each document, once a document."""
    long = lambda x: F.char_length(x) >= least_chars
    keys = F.array_distinct(F.filter(F.transform(F.filter(lines_of(own(text)), long), line_key), long))
    # The outer form: the other pushes a filter that computes the array once more.
    found = docs.select(own(key).alias("doc"), F.xxhash64(own(text)).alias("text_hash"), F.explode_outer(keys).alias("line"))
    return found.where(F.col("line").isNotNull()).select("doc", "text_hash", *_hashes(F.col("line")))


@contextmanager
def _known_order(spark: SparkSession) -> Iterator[None]:
    """Let bucketed scans of one file a bucket keep the order that it was written in; the setting is put back."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """Levelled sorted runs of (h1, h2, n_docs, max_doc) with disjoint hashes.

    Runs, batches and additions are tables in the shared folder, all in the same
    ``buckets`` of the hash (as many as the session's shuffle partitions) and sorted
    within. Null documents are smaller than any other.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.additions: list[DataFrame] = []  # what later batches add to lines of the runs
        self._tables: dict[int, tuple[str, str]] = {}

    @property
    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def _write(self, rows: DataFrame, name: str) -> DataFrame:
        table, path = f"hitlens_lines_{uuid.uuid4().hex}", stored_table_path(self.spark, name)
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).format("parquet").saveAsTable(table)
        written = self.spark.table(table)
        self._tables[id(written)] = (table, path)
        return written

    def _delete(self, rows: DataFrame) -> None:
        table, path = self._tables.pop(id(rows))
        self.spark.sql(f"DROP TABLE {table}")
        drop_stored(self.spark, path)

    def drop(self) -> None:
        """Delete all tables of the index."""
        for rows in self.runs + self.additions:
            self._delete(rows)
        self.levels, self.additions = [], []

    def _merged(self, tables: list[DataFrame], name: str) -> DataFrame:
        """One table for several, by merge joins of two; the tables are deleted."""
        while len(tables) > 1:
            pairs = [self._write(self.merge(a, b), name) for a, b in zip(tables[::2], tables[1::2], strict=False)]
            odd = tables[len(pairs) * 2 :]
            for t in tables[: len(pairs) * 2]:
                self._delete(t)
            tables = pairs + odd
        return tables[0]

    @staticmethod
    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        """Both tables' hashes, with the documents of both."""
        some = lambda side: F.coalesce(side["n_docs"], F.lit(0))
        return a.join(b.hint("merge"), list(HASH), "full_outer").select(
            *HASH, (some(a) + some(b)).alias("n_docs"), F.greatest(a["max_doc"], b["max_doc"]).alias("max_doc"))

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(self._merged(full, f"line-run-{level + 1}"), level + 1)

    def add(self, lines: DataFrame) -> None:
        """Add a batch (rows of ``document_lines``)."""
        # This exchange is the only one of a batch; the write makes one file of each bucket.
        counted = lines.groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("doc").alias("max_doc"))
        with _known_order(self.spark):
            batch = self._write(counted, "line-batch")
            if not self.runs:
                self._push(batch, 0)
                return
            fresh = self._write(self.unseen(batch), "line-run-0")
            self.additions.append(self._write(batch.join(fresh.hint("merge"), list(HASH), "left_anti"), "line-additions"))
            self._delete(batch)
            self._push(fresh, 0)
            if len(self.additions) >= self.fanout:
                self.additions = [self._merged(self.additions, "line-additions")]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` whose hash is in no run: a merge-anti-join with each run."""
        return reduce(lambda rows, run: rows.join(run.hint("merge"), list(HASH), "left_anti"), self.runs, lines)

    def frequent(self, least_docs: int = LEAST_DOCS) -> DataFrame:
        """(h1, h2, max_doc) of the lines found in at least ``least_docs`` documents of all batches, written.

        Each run is merge-joined with the additions, merged into one table first.
        """
        if not self.runs:
            raise ValueError("no batch has been added")
        with _known_order(self.spark):
            if self.additions:
                self.additions = [self._merged(self.additions, "line-additions")]
            whole = [self.grown(run) for run in self.runs]
            return stored(reduce(DataFrame.unionByName, [w.where(F.col("n_docs") >= least_docs).select(*HASH, "max_doc") for w in whole]), "frequent-lines")

    def grown(self, run: DataFrame) -> DataFrame:
        """A run with what later batches added to its lines."""
        if not self.additions:
            return run
        more = self.additions[0]
        return run.join(more.hint("merge"), list(HASH), "left").select(
            *HASH, (run["n_docs"] + F.coalesce(more["n_docs"], F.lit(0))).alias("n_docs"), F.greatest(run["max_doc"], more["max_doc"]).alias("max_doc"))


def drop_repeated_lines(docs: DataFrame | list[DataFrame], key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                        least_docs: int = LEAST_DOCS, runs: LineRuns | None = None, batches: int = BATCHES) -> DataFrame:
    """Per row (own columns kept, ``text`` rewritten): n_lines, n_dropped and the text that is left.

    ``docs`` is one table, cut into ``batches`` by a hash of key and text, or a
    list of tables, each a batch. A line whose key has ``least_chars``
    characters and occurs in ``least_docs`` documents stays only in the
    document of the largest key; other lines stay as they are. Each row counts
    as a document: repeated rows count each and, being largest, all keep their
    lines. With ``runs``, the batches join those that this index holds already, and
    its tables stay; else they are deleted. A null key is smaller than any other. A null or empty text has one
    empty line, and a row that loses nothing keeps its text, null included.
    Columns n_lines and n_dropped are replaced. Empty tables give empty results.
    """
    given = docs if isinstance(docs, list) else [docs]
    index = runs or LineRuns(given[0].sparkSession)
    cut = F.pmod(F.xxhash64("doc", "text_hash"), F.lit(batches)).cast("int")
    found = [document_lines(d, key, text, least_chars).withColumn("batch", F.lit(i) if isinstance(docs, list) else cut) for i, d in enumerate(given)]
    # The texts are read once for all batches.
    lines = stored(reduce(DataFrame.unionByName, found), "document-lines", ("batch",))
    for i in range(len(given) if isinstance(docs, list) else batches):
        index.add(lines.where(F.col("batch") == i).drop("batch"))
    frequent = index.frequent(least_docs)
    if runs is None:
        index.drop()
    doomed = (
        lines.join(frequent, list(HASH)).where(~F.col("doc").eqNullSafe(F.col("max_doc")))
        .groupBy(F.col("doc").alias("doomed_doc"), F.col("text_hash").alias("doomed_text"))
        .agg(F.collect_set(F.struct(*HASH)).alias("doomed"))
    )
    whole = reduce(DataFrame.unionByName, given)
    rows = whole.select(boxed(whole), own(key).alias("own_key"), own(text).alias("own_text"))
    met = rows.join(doomed, F.col("own_key").eqNullSafe(F.col("doomed_doc")) & (F.xxhash64("own_text") == F.col("doomed_text")), "left")
    stays = lambda x: (F.char_length(x) < least_chars) | ~F.array_contains(F.col("doomed"), F.struct(*_hashes(line_key(x))))
    n_lines = F.size(lines_of(F.col("own_text")))
    met = met.withColumn("left", F.when(F.col("doomed").isNotNull(), F.filter(lines_of(F.col("own_text")), stays)))
    kept = F.when(F.col("left").isNull(), F.col("own_text")).otherwise(F.array_join("left", "\n"))
    return met.select(
        *[(kept if c == text else F.col("row")[c]).alias(c) for c in whole.columns if c not in ("n_lines", "n_dropped")],
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("left").isNull(), 0).otherwise(n_lines - F.size("left")).cast("long").alias("n_dropped"),
    )


def file_batches(spark: SparkSession, path: str, batches: int = 2) -> list[DataFrame]:
    """A stored table as up to ``batches`` tables of whole files."""
    table = spark.read.parquet(path)
    files = sorted(table.inputFiles())
    if len(files) < batches:
        return [table]
    return [spark.read.schema(table.schema).parquet(*files[i::batches]) for i in range(batches)]


def line_digest(docs: DataFrame) -> DataFrame:
    left = drop_repeated_lines(docs.select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


LINE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT row_id, doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS max_doc FROM k WHERE length(key) >= {LEAST_CHARS} GROUP BY key HAVING count(DISTINCT row_id) >= {LEAST_DOCS}),
s AS (SELECT k.*, f.key IS NULL OR k.doc_id IS NOT DISTINCT FROM max_doc AS stays FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM s GROUP BY row_id
"""
