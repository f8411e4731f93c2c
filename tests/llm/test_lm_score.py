"""PPM scores against a plain trie."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hitlens.llm import lm_score
from tests.llm.data import awkward_documents, small_documents


class PlainPpm:
    """Counts per context in a dict; one symbol at a time."""

    def __init__(self, texts):
        self.trie = defaultdict(Counter)
        for t in texts:
            raw = b"\xff" * 4 + t + b"\xff"
            for i in range(4, len(raw)):
                for k in range(5):
                    self.trie[raw[i - k : i]][raw[i]] += 1

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(4, -1, -1):
            seen = self.trie.get(context[4 - k :])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            if symbol in left:
                return p * left[symbol] / (sum(left.values()) + len(left))
            if left:
                p *= len(left) / (sum(left.values()) + len(left))
            excluded = set(seen)
        return p / (256 - len(excluded))

    def score(self, text):
        raw = b"\xff" * 4 + text + b"\xff"
        return sum(math.log10(self.probability(raw[i - 4 : i], raw[i])) for i in range(4, len(raw)))


def expected(rows):
    texts = [(k, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for k, t in rows]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2 for k, _ in texts]
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t) if w] + [None] for _, t in texts]
    counts = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    model = PlainPpm([t.encode() for (_, t), h in zip(texts, held, strict=True) if not h])
    for (k, t), h, ws in zip(texts, held, words, strict=True):
        yield (k, h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), model.score(t.encode()))


def check(docs):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[-1])
    got = sorted((tuple(r) for r in lm_score.lm_digest(docs).collect()), key=key)
    want = sorted(expected([tuple(r) for r in docs.select("doc_id", "text").collect()]), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert [g[6] for g in got] == pytest.approx([w[6] for w in want], rel=1e-9)
    return got


def test_scores_match_a_plain_trie(spark):
    check(awkward_documents(spark))
    docs = small_documents(spark).limit(40)
    whole = check(docs)
    assert {r[1] for r in whole} == {True, False}
    per_byte = [-r[6] / max(1, r[2]) for r in whole]
    assert max(per_byte) < 40


def test_without_training_documents_and_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = check(spark.createDataFrame([(held, "Unseen words")], "doc_id long, text string"))
    assert rows[0][3] == 0 and rows[0][6] == pytest.approx(-13 * math.log10(256))
    assert lm_score.lm_digest(small_documents(spark).limit(0)).count() == 0


def test_probabilities_sum_to_one():
    texts = [b"abracadabra", b"abac", b"cab cab"]
    codes, counts = lm_score.gram_counts(texts)
    for context in (b"abra", b"\xff\xff\xffa", b"zzza", b"zzzz", b"zcab"):
        asked = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)])
        every = np.union1d(codes, asked)
        n = np.zeros(len(every), np.int64)
        n[np.searchsorted(every, codes)] = counts
        pairs = np.zeros((256, 256))
        np.add.at(pairs, ((codes >> 8) & 0xFF, codes & 0xFF), counts)
        p = 10 ** lm_score.ppm_log10(every, n, pairs)[np.searchsorted(every, asked)]
        assert p.sum() == pytest.approx(1)


def test_grams_do_not_cross_texts():
    assert lm_score.grams([b"ab", b"", b"c"]).tolist() == [int.from_bytes(x, "big") for x in (
        b"\xff\xff\xff\xffa", b"\xff\xff\xffab", b"\xff\xffab\xff", b"\xff" * 5, b"\xff\xff\xff\xffc", b"\xff\xff\xffc\xff")]
