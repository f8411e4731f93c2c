"""Exact substring dedup against counting every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hitlens.llm import suffixes
from tests.llm.data import as_rows, awkward_documents, small_documents


def brute(rows):
    texts = [(k, (t or "").encode()) for k, t in rows]
    n = Counter(t[p : p + 200] for _, t in texts for p in range(len(t) - 199))
    for k, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - 199):
            if n[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        yield k, len(t), int(gone.sum()), int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()), hashlib.sha256(kept).hexdigest()


def planted(seed):
    """Copies, near copies, shared passages, periodic text and repeats within a text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(150)
    texts = [None, "", "x" * 199, "y" * 200, "y" * 201, "z" * 900, "ab" * 300, base, base, passage + passage, "ü" * 99 + "é" * 3 + "ü" * 120]
    for _ in range(25):
        words = base.split(" ")
        words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
        cut = rng.randrange(150)
        texts.append(prose(20) + passage[cut : cut + rng.randint(180, 330)] + prose(20))
    return [(i, t) for i, t in enumerate(texts)] + [(None, base), (7, prose(400))]


@pytest.mark.parametrize("frequent", [5, suffixes.FREQUENT])
def test_matches_counting_every_window(spark, frequent):
    rows = planted(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = as_rows(spark.createDataFrame(list(brute(rows)), "a long, b long, c long, d long, e string"))
    got = suffixes.repeated_spans(docs, frequent=frequent, keep_text=True)
    flat = got.selectExpr("key", "n_bytes", "aggregate(spans, 0L, (s, x) -> s + x.end - x.start) as n_removed", "cast(size(spans) as long) as n_spans", "kept_sha256", "sha2(kept, 256) = kept_sha256 as same")
    assert as_rows(flat, *flat.columns[:5]) == want
    assert all(r.same for r in flat.collect())
    assert sum(r[2] for r in want) > 0


def test_given_documents_match(spark):
    docs = small_documents(spark).select("doc_id", "text").union(awkward_documents(spark).select("doc_id", "text"))
    want = list(brute([tuple(r) for r in docs.collect()]))
    assert as_rows(suffixes.suffix_digest(docs)) == as_rows(spark.createDataFrame(want, "a long, b long, c long, d long, e string"))
    assert suffixes.suffix_digest(docs.limit(0)).count() == 0


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7):
        words = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 40))) for _ in range(k)]
        runs = [iter([(suffixes.common(w[i - 1], x) if i else 0, x, b"", i, 1) for i, x in enumerate(w)]) for w in words]
        got = list(suffixes.merged(runs))
        assert [g[2] for g in got] == sorted(x for w in words for x in w)
        for a, b in zip(got, got[1:], strict=False):
            assert b[0] == suffixes.common(a[2], b[2])


def test_long_texts_are_cut_into_overlapping_segments(monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 2000)
    rng = random.Random(3)
    text = bytes(rng.choice(b"abcd ") for _ in range(9000))
    cut = suffixes.Spans([text, text[:150], text[100:700]])
    monkeypatch.undo()
    suffixes._powers.cache_clear()
    whole = suffixes.Spans([text, text[:150], text[100:700]])

    def windows(s):
        return sorted((t, p, a) for t, f, last, a in zip(s.text, s.first, s.last, s.anchor, strict=True) for p in range(f, last + 1))

    assert windows(cut) == windows(whole)
    assert [p for t, p, _ in windows(whole) if t == 0] == list(range(9000 - 199))


def test_front_coded_runs_round_trip():
    texts = [t.encode() for _, t in planted(4) if t]
    spans = suffixes.Spans(texts)
    found = suffixes.Suffixes(spans, spans.gram)
    back = [(right, left) for _, run in found.runs(7) for _, right, left, _, _ in suffixes.decoded(run)]
    assert back == found.suffixes
    sizes = [len(list(suffixes.decoded(run))) for _, run in found.runs(7)]
    assert len(sizes) == 7 and max(sizes) < 3 * sum(sizes) / 7


def test_repeated_windows_match_comparing_all_pairs():
    rng = random.Random(5)
    length, gram = suffixes.LENGTH, suffixes.GRAM
    tails = [bytes(rng.choice(b"ab") for _ in range(length)) for _ in range(3)]
    heads = [bytes(rng.choice(b"ab") for _ in range(length - gram)) for _ in range(3)]
    found = set()
    while len(found) < 120:
        right, left = rng.choice(tails)[: rng.randint(gram, length)], rng.choice(heads)[rng.randint(0, length - gram) :]
        if rng.random() < 0.3:
            at = rng.randrange(gram, length)
            right = right[:at] + b"c" + right[at + 1 :]
        if len(left) + len(right) >= length:
            found.add((right[:length], left))
    order = sorted(found)
    known = np.array([0] + [suffixes.common(a, b) for (a, _), (b, _) in zip(order, order[1:], strict=False)])
    got = suffixes.repeated_windows(known, np.array([len(r) for r, _ in order]), [x for _, x in order])
    windows = [{o: (left[len(left) - o :] + right)[:length] for o in range(length - len(right), len(left) + 1)} for right, left in order]
    for i, own in enumerate(windows):
        want = [o for o, w in own.items() if any(other.get(o) == w for j, other in enumerate(windows) if j != i)]
        assert np.flatnonzero(got[i]).tolist() == want
    assert got.any() and not got.all(axis=1).any()
