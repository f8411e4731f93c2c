"""Benchmark decontamination by winnowing.

Of every window of words only the least hash of its k-grams is kept, so a
long text has few distinct fingerprints and equal windows always share theirs.
Training and benchmark fingerprints are joined; a hit is extended to the whole
windows around it, which are then compared word for word. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.llm.common import ascii_lower, boxed, own, stored

WINDOW = 13
GRAM = 5
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
#: Runs of a-z, 0-9 and everything beyond ASCII; then the same before lower-casing.
#: Spelled by what belongs to a word, with letters first: that matches fastest.
WORD = r"[a-z0-9\x{80}-\x{10FFFF}]+"
ANY_CASE_WORD = r"[a-zA-Z0-9\x{80}-\x{10FFFF}]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _item(array: str, at: str) -> str:
    return f"get({array}, {at})"


def with_window_marks(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """``rows`` with the array column ``words``, plus ``marks``: per window of
    ``window`` words (by its first word) the least hash of its ``gram``-grams."""
    grams = f"xxhash64({', '.join(_item('hashes', f'i + {j}') for j in range(gram))})"
    least = f"least({', '.join(_item('grams', f'i + {j}') for j in range(window - gram + 1))}, {_item('grams', 'i')})"
    each = lambda last, body: F.expr(f"IF(size(words) >= {window}, transform(sequence(0, size(words) - {last}), i -> {body}), array())")
    hashed = rows.withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
    hashed = hashed.withColumn("grams", each(gram, grams) if gram > 1 else F.col("hashes"))
    return hashed.withColumn("marks", each(window, least)).drop("hashes", "grams")


def gram_of(window: int) -> int:
    """k-gram length for windows of so many words."""
    return min(GRAM, (window + 1) // 2)


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, span, window): each window of each item; an item of fewer words is one window."""
    words = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("words"))
    some = words.where(F.size("words") > 0).withColumn("span", F.least(F.size("words"), F.lit(window)))
    starts = some.select("item", "span", "words", F.explode(F.expr("sequence(1, size(words) - span + 1)")).alias("at"))
    return starts.select("item", "span", F.expr("slice(words, at, span)").alias("words")).distinct()


def hit_windows(texts: DataFrame, windows: DataFrame, spans: list[int]) -> DataFrame:
    """(doc, text_hash, at, span, items): the windows of ``texts`` (doc, text_hash, text) that items hold.

    Per span: distinct marks meet the marks of the benchmark's windows, which
    finds the documents that may hold one; in those, windows with such a mark
    are compared word by word.
    """
    out = None
    # The outer forms of explode: the others push a filter that recomputes the array below it.
    for span in spans:
        gram = gram_of(span)
        known = stored(windows.where(F.col("span") == span).groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items")), "benchmark-windows")
        marks = with_window_marks(known, span, gram).select(F.col("marks")[0].alias("mark")).distinct()
        rows = texts.withColumn("words", words_of(F.col("text"))).drop("text")
        sparse = with_window_marks(rows, span, gram).select("doc", "text_hash", F.explode_outer(F.array_distinct("marks")).alias("mark"))
        suspects = stored(sparse.join(marks, "mark", "left_semi").groupBy("doc", "text_hash").agg(F.collect_set("mark").alias("suspect_marks")), "suspects")
        same = texts["doc"].eqNullSafe(suspects["doc"]) & (texts["text_hash"] == suspects["text_hash"])
        again = texts.join(suspects, same).select(texts["doc"], texts["text_hash"], texts["text"], "suspect_marks")
        again = with_window_marks(again.withColumn("words", words_of(F.col("text"))).drop("text"), span, gram)
        spot = again.select("doc", "text_hash", "suspect_marks", "words", F.posexplode_outer("marks").alias("at", "mark")).where(F.array_contains("suspect_marks", F.col("mark")))
        extended = spot.select("doc", "text_hash", "at", F.slice("words", F.col("at") + 1, F.lit(span)).alias("words"))
        hits = extended.join(known, "words").select("doc", "text_hash", "at", F.lit(span).alias("span"), "items")
        out = hits if out is None else out.unionByName(hits)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items, items_sha256 and contaminated (replacing columns of these names).

    A word is hit if it lies in a window that some item holds too. Null and
    empty texts have no words and are never contaminated; items without words
    match nothing; a null item id counts as the empty id. Repeated rows get
    equal results each; several items of one id count once. Empty tables on
    either side are allowed.
    """
    windows = stored(benchmark_windows(benchmark, item, item_text, window), "benchmark-spans")
    # At most ``window`` lengths.
    spans = sorted(r.span for r in windows.select("span").distinct().collect()) or [window]
    texts = docs.select(own(key).alias("doc"), F.xxhash64(own(text)).alias("text_hash"), own(text).cast("string").alias("text"))
    hits = hit_windows(texts, windows, spans)
    # At most a row per document: positions and ids are sets within one text.
    found = stored(
        hits.groupBy("doc", "text_hash").agg(
            F.array_sort(F.collect_set(F.struct("at", "span"))).alias("at"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        .select(
            F.col("doc").alias("_doc"), F.col("text_hash").alias("_text_hash"),
            F.expr("size(array_distinct(flatten(transform(at, x -> sequence(x.at, x.at + x.span - 1)))))").cast("long").alias("_n_hit"),
            F.size("items").cast("long").alias("_n_items"), F.sha2(F.array_join("items", ","), 256).alias("_sha")),
        "contaminated-documents")
    n_words = F.regexp_count(F.coalesce(own(text).cast("string"), F.lit("")), F.lit(ANY_CASE_WORD)).cast("long")
    counted = docs.select(boxed(docs), own(key).alias("own_key"), F.coalesce(F.xxhash64(own(text)), F.lit(0)).alias("own_hash"), n_words.alias("words"))
    met = counted.join(found, F.col("own_key").eqNullSafe(F.col("_doc")) & (F.col("own_hash") == F.col("_text_hash")), "left")
    return met.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in RESULTS],
        F.col("words").alias("n_words"),
        F.coalesce("_n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("_n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("_sha", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce((F.col("_n_hit") > 0) & (20 * F.col("_n_hit") >= F.col("words")), F.lit(False)).alias("contaminated"),
    )


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs.select("doc_id", "text"), benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


CONTAMINATION_SQL = rf"""
WITH low AS (
  SELECT 'd' AS side, row_number() OVER () AS row_id, doc_id, '' AS item, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(item_id::VARCHAR, ''), coalesce(text, '') FROM benchmark
),
w AS (
  SELECT side, row_id, doc_id, item, [x FOR x IN regexp_split_to_array(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM low
),
b AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS span, list_slice(w, i, i + least(len(w), {WINDOW}) - 1) AS g
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM w WHERE side = 'b' AND len(w) > 0)
),
spans AS (SELECT DISTINCT span FROM b),
p AS (SELECT row_id, span, w, unnest(generate_series(1, len(w) - span + 1)) AS i FROM w, spans WHERE side = 'd'),
h AS (SELECT row_id, i, b.span, item FROM (SELECT *, list_slice(w, i, i + span - 1) AS g FROM p) p JOIN b ON p.g = b.g),
n AS (SELECT row_id, count(DISTINCT q) AS n FROM (SELECT row_id, unnest(generate_series(i, i + span - 1)) AS q FROM h) GROUP BY row_id),
m AS (SELECT row_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM h GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
  sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM w LEFT JOIN n USING (row_id) LEFT JOIN m USING (row_id) WHERE side = 'd'
"""
