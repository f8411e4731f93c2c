"""The pipeline, stage by stage, against plain restatements on a small corpus."""

import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from hitlens.llm import quality
from hitlens.llm.common import stored
from tests.llm.data import SMALL, as_rows, awkward_documents, small_documents
from tests.llm.test_dedup_operators import plain_components, plain_fingerprint, unchanged, with_inner_names
from tests.llm.test_packing import check_whole_sequences, pieces_of


def plain_quality(rows):
    kept = []
    for r in rows:
        m = dict(zip(quality.MEASURES, quality.measure((r["text"] or "").encode()), strict=True))
        if not any(eval(rule.replace("AND", "and").replace("OR", "or"), {}, m) for rule in quality.RULES.values()):
            kept.append(r)
    return kept


def plain_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, r in enumerate(rows):
        for x in (r["text"] or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(i)
    largest = {k: max(rows[i]["doc_id"] for i in who) for k, who in holders.items() if len(who) >= 5}
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        stay = [x for x in lines if largest.get(key(x), r["doc_id"]) == r["doc_id"]]
        out.append(r if len(stay) == len(lines) else r | {"text": "\n".join(stay), "n_chars": len("\n".join(stay))})
    return out


def plain_near(rows):
    groups = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
    seen, out = set(), []
    for r, c in zip(rows, groups, strict=True):
        if r["doc_id"] == c and c not in seen:
            seen.add(c)
            out.append(r)
    return out


def plain_benchmark(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    known = {tuple(w[i : i + 13]) for w in map(words, items) if w for i in range(max(1, len(w) - 12))}
    out = []
    for r in rows:
        w = words(r["text"])
        hit = {p for n in {len(k) for k in known} for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in known for p in range(i, i + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    own = [c for c in small_documents(spark).columns]
    more = spark.createDataFrame([(5000 + i, f"number {i} of them says: {item} and ends here", "en", "src9", 1) for i in range(3)], "doc_id long, text string, lang string, source string, n_chars long")
    return stored(small_documents(spark).unionByName(more).unionByName(awkward_documents(spark).where("doc_id >= 0").selectExpr("doc_id + 6000 as doc_id", *own[1:])), "corpus")


def test_each_stage_matches_a_plain_restatement(spark, corpus):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    plain = [plain_quality, plain_lines, plain_near, lambda rows: plain_benchmark(rows, items)]
    docs, sizes = corpus, Counter()
    for (name, stage), restated in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        after = stored(stage(spark, docs, SMALL), name)
        want = restated([r.asDict() for r in docs.orderBy("doc_id").collect()])
        assert after.columns == corpus.columns
        assert as_rows(after) == as_rows(spark.createDataFrame([tuple(r.values()) for r in want], corpus.schema)), name
        sizes[name] = docs.count() - after.count()
        docs = after
    assert sizes["quality_rules"] and sizes["simhash_near_dedup"] and sizes["benchmark_decontamination"] and not sizes["line_dedup"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    want = list(pieces_of(docs.select("doc_id", "text").collect(), 2048))
    assert as_rows(packed, "doc_id", "piece", "start", "length", "ids_crc32") == as_rows(spark.createDataFrame(want, "a long, b int, c long, d long, e long"))
    check_whole_sequences(packed.collect(), 2048)


def test_repeated_and_null_rows_pass_through(spark):
    docs = stored(awkward_documents(spark), "awkward")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), "stage")
    assert set(awkward_documents(spark).columns) == set(docs.columns)
    assert docs.count() == docs.select("doc_id").distinct().count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_registered_with_the_operators(spark):
    names = queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert names["pipeline"](spark, SMALL).count() > 0


def test_no_extra_column_is_lost_or_changed_by_a_stage(spark):
    docs = with_inner_names(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SMALL), name)
        assert after.columns == docs.columns and after.schema == docs.schema, name
        unchanged(docs, after, ("text", "n_chars") if name == "line_dedup" else ())
        docs = after
    assert docs.count() and corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()


def test_a_run_goes_on_after_its_last_stage(spark, scratch, monkeypatch):
    whole = as_rows(corpus_pipeline.run(spark, SMALL), "doc_id", "piece", "length", "ids")
    calls = []
    spied = [(name, lambda spark, docs, sf_dir, name=name, stage=stage: calls.append(name) or stage(spark, docs, sf_dir)) for name, stage in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", spied)
    assert as_rows(corpus_pipeline.run(spark, SMALL, scratch), "doc_id", "piece", "length", "ids") == whole
    (Path(scratch) / "benchmark_decontamination" / "_SUCCESS").unlink()
    calls.clear()
    assert as_rows(corpus_pipeline.run(spark, SMALL, scratch), "doc_id", "piece", "length", "ids") == whole
    assert calls == ["benchmark_decontamination", "best_fit_packing"]


def test_packed_ids_are_the_documents_tokens(spark, corpus):
    docs = corpus.limit(60)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in sorted(corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect(), key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    want = {r.doc_id: own.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    assert got == want
