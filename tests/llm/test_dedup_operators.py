"""SimHash, line dedup and decontamination against plain restatements."""

import random
import re

import numpy as np
import pytest
import xxhash

from hitlens.llm import decontaminate, graph, line_dedup, simhash
from tests.llm.data import SMALL, against_sql, as_rows, awkward_documents, small_documents


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [words] if 0 < len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, distance=4):
    """fps: list of (key, fingerprint); smallest key reachable, by union-find over all pairs."""
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= distance:
                parent[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(fps):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return [least.get(top(i)) for i in range(len(fps))]


@pytest.mark.parametrize("docs_of", [awkward_documents, small_documents])
def test_simhash_matches_brute_force(spark, docs_of):
    docs = docs_of(spark)
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    want = [(k, f"{f:016x}", c) for (k, f), c in zip(fps, plain_components(fps), strict=True)]
    assert as_rows(simhash.simhash_digest(docs)) == as_rows(spark.createDataFrame(want, "a long, b string, c long"))
    assert simhash.simhash_digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4, 2048])
def test_all_close_fingerprints_are_linked(spark, block):
    """Random clusters, chains and a dense ball, with buckets dealt into tiny blocks and whole."""
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:25]:
        for _ in range(6):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    ball = rng.getrandbits(64)
    fps |= {ball ^ (1 << b) for b in range(64)}
    chain = rng.getrandbits(64)
    for b in range(0, 60, 4):
        chain ^= 0b1111 << b
        fps.add(chain)
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.node: r.root for r in graph.components(simhash.links(nodes, 4, block)).collect()}
    want = plain_components(list(zip(signed, fps, strict=True)))
    assert [found.get(s, s) for s in signed] == want


def test_segments_leave_one_with_a_single_bit():
    assert simhash.segments(4) == [(0, 21), (21, 21), (42, 22)]
    assert [len(simhash.segments(d)) for d in (1, 2, 3, 5)] == [1, 2, 2, 3]


def test_components_of_chains_hubs_and_repeats(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(50)] + [(7, 3), (7, 3), (900, 900)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{500 + i: 500 for i in range(50)}}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("docs_of", [awkward_documents, small_documents])
def test_line_dedup_matches_sql(spark, docs_of):
    docs = docs_of(spark)
    got, want = against_sql(line_dedup.line_digest(docs), line_dedup.LINE_SQL, documents=docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    assert got == want
    assert sum(r[2] for r in got if len(r) > 2) >= 0


def test_line_batches_and_levels_agree_with_one_batch(spark):
    docs = awkward_documents(spark)
    whole = line_dedup.drop_repeated_lines([docs])
    batches = [docs.where(f"pmod(coalesce(doc_id, 0), 9) = {i}") for i in range(9)]
    runs = line_dedup.LineRuns(spark, fanout=2)
    cut = line_dedup.drop_repeated_lines(batches, runs=runs)
    assert [len(level) for level in runs.levels] == [1, 0, 0, 1] and len(runs.additions) == 1
    assert as_rows(whole) == as_rows(cut) and set(docs.columns) < set(whole.columns)
    assert whole.where("n_dropped > 0").count() > 0
    assert line_dedup.drop_repeated_lines([docs.limit(0)]).count() == 0


def test_one_table_goes_through_levels(spark, scratch):
    """A table in one file is cut into batches too: two full levels are compacted, one run is left at the first."""
    awkward_documents(spark).coalesce(1).write.parquet(f"{scratch}/one")
    docs = spark.read.parquet(f"{scratch}/one")
    runs = line_dedup.LineRuns(spark)
    whole = line_dedup.drop_repeated_lines(docs, runs=runs)
    assert len(docs.inputFiles()) == 1 and [len(level) for level in runs.levels] == [1, 2]
    assert len(runs.additions) < runs.fanout and sum(a.count() for a in runs.additions) > 0
    assert as_rows(whole) == as_rows(line_dedup.drop_repeated_lines([docs]))
    hashes = runs.runs[0].unionByName(runs.runs[1]).unionByName(runs.runs[2])
    assert hashes.count() == hashes.select("h1", "h2").distinct().count()  # a line is in one run only


#: Every name that the operators use inside or return.
INNER = ("row own_key own_text own_hash stay_key stay_text copies doomed doomed_doc doomed_text left words _doc _text_hash _n_hit _n_items _sha _hash _stay _text "
         "_doomed fp root component_id key text_hash doc h1 h2 max_doc n_docs batch mark marks hashes grams a.b `odd` kept bits quality").split()
RESULTS = ("n_lines", "n_dropped", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def with_inner_names(spark):
    from pyspark.sql import functions as F

    docs = awkward_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    names = [*INNER, *RESULTS]
    return docs.select("*", *[F.concat(F.lit(f"{n}!"), F.col("doc_id").cast("string")).alias(n) for n in names])


def unchanged(before, after, but=()):
    """Every kept row of ``after`` has the columns of its document."""
    names = [c for c in before.columns if c not in but]
    rows = {str([r[c] for c in names]) for r in before.collect()}
    assert set(before.columns) <= set(after.columns)
    assert all(str([r[c] for c in names]) in rows for r in after.collect())


def test_no_extra_column_is_lost_or_changed(spark):
    docs = with_inner_names(spark)
    near = simhash.drop_near_duplicates(docs)
    unchanged(docs, near)
    assert near.columns == docs.columns and 0 < near.count() < docs.count()
    lines = line_dedup.drop_repeated_lines(docs)
    unchanged(docs, lines, ("text", "n_lines", "n_dropped"))
    assert lines.count() == docs.count() and lines.schema["n_lines"].dataType.simpleString() == "bigint"
    judged = decontaminate.contamination(docs, spark.createDataFrame(BENCH, "item_id long, text string"))
    unchanged(docs, judged, RESULTS[2:])
    assert judged.count() == docs.count() and {r.contaminated for r in judged.select("contaminated").collect()} == {False}


def test_runs_are_joined_and_merged_without_exchange_or_sort(spark):
    def plan(df):
        with line_dedup._known_order(spark):
            return df._jdf.queryExecution().executedPlan().toString()

    line = "a line that is long enough to be looked at, number {}"
    batch = lambda ids: line_dedup.document_lines(spark.createDataFrame([(i, line.format(i)) for i in ids], "doc_id long, text string"), "doc_id", "text")
    runs = line_dedup.LineRuns(spark)
    for i in range(3):
        runs.add(batch(range(50 * i, 50 * i + 100)))
    assert [r.count() for r in runs.runs] == [100, 50, 50] and len(runs.additions) == 2
    for files in (r.inputFiles() for r in runs.runs + runs.additions):
        buckets = [re.search(r"_(\d{5})\.c", f)[1] for f in files]
        assert len(set(buckets)) == len(buckets) <= runs.buckets  # one file a bucket
    merged = line_dedup.LineRuns.merge(runs.runs[0], runs.additions[0])
    for df in (runs.unseen(runs.additions[1]), merged, runs.grown(runs.runs[0])):
        assert "SortMergeJoin" in plan(df) and "Exchange" not in plan(df) and "Sort [" not in plan(df)
    assert (merged.count(), merged.agg({"n_docs": "sum"}).first()[0]) == (100, 150)
    before, tables = spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering"), len(spark.catalog.listTables())
    assert runs.frequent(2).count() == 100 and runs.frequent(3).count() == 0
    runs.drop()
    assert before == "false" and len(spark.catalog.listTables()) < tables and not runs._tables


def test_file_batches_hold_the_whole_table(spark, scratch):
    docs = awkward_documents(spark)
    docs.repartition(5).write.parquet(f"{scratch}/docs")
    cut = line_dedup.file_batches(spark, f"{scratch}/docs", 3)
    assert len(cut) == 3 and as_rows(cut[0].unionByName(cut[1]).unionByName(cut[2])) == as_rows(docs)


def test_runs_tell_unseen_lines(spark):
    line = "a line that is long enough to be looked at, number {}"
    batch = lambda ids: line_dedup.document_lines(spark.createDataFrame([(i, line.format(i)) for i in ids], "doc_id long, text string"), "doc_id", "text")
    runs = line_dedup.LineRuns(spark)
    runs.add(batch(range(5)))
    runs.add(batch(range(4, 8)))
    assert [r.count() for r in runs.runs + runs.additions] == [5, 3, 1]
    assert sorted(r.doc for r in runs.unseen(batch(range(6, 11))).collect()) == [8, 9, 10]


BENCH = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "Short ITEM"), (3, None), (4, "!!"), (None, "solo"),
         (10, "a b c d e f"), (2, "another text for item two with more than thirteen words in it so that it has windows"), (5, "short item"),
         (6, "é è ê ë à â ä ö ü ß ñ ó í ú É")]
TEXTS = [None, "", "one two three four five six seven eight nine ten eleven twelve thirteen", "ONE,two;three four five six seven eight nine ten eleven twelve Thirteen fourteen fifteen" + " pad" * 10,
         "x short item y", "a b c d e f a b c d e f", "solo", "two three four five six seven eight nine ten eleven twelve thirteen fourteen", "one two three four five six seven eight nine ten eleven twelve",
         "windows another text for item two with more than thirteen words in it so that it has windows " * 3, "é è ê ë à â ä ö ü ß ñ ó í ú É " + "w " * 400, "q " * 13]


def test_contamination_matches_sql(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[2])], "doc_id long, text string").union(
        awkward_documents(spark).select("doc_id", "text"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got, want = against_sql(decontaminate.contamination_digest(docs, bench), decontaminate.CONTAMINATION_SQL,
                            documents=docs.toPandas().astype({"doc_id": "Int64"}), benchmark=bench.toPandas().astype({"item_id": "Int64"}))
    assert got == want and sum(r[-1] for r in got) > 5
    assert decontaminate.contamination_digest(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination_digest(docs.limit(0), bench).count() == 0


def test_contamination_of_given_tables_matches_sql(spark):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got, want = against_sql(decontaminate.contamination_digest(small_documents(spark), bench), decontaminate.CONTAMINATION_SQL,
                            documents=small_documents(spark).toPandas(), benchmark=bench.toPandas())
    assert got == want and any(r[-1] for r in got)


def test_contamination_keeps_foreign_columns(spark):
    docs = awkward_documents(spark)
    out = decontaminate.contamination(docs, spark.createDataFrame(BENCH, "item_id long, text string"))
    assert set(docs.columns) < set(out.columns) and out.count() == docs.count()
    assert as_rows(out, *docs.columns) == as_rows(docs)
