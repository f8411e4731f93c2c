"""Tokenising, cutting and best-two-fit packing."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from hitlens.llm import packing
from tests.llm.data import as_rows, awkward_documents, small_documents


def pieces_of(rows, capacity):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        at, n = 0, len(ids) % capacity or capacity
        for piece in range(-(-len(ids) // capacity)):
            part = ids[at : at + n]
            yield key, piece, at, len(part), crc32(np.array(part, "<u4").tobytes())
            at, n = at + n, capacity


def check_whole_sequences(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_matches_the_tokenizer_and_fills_sequences(spark):
    special = spark.createDataFrame([(900, "a<|endoftext|>b"), (901, "ö\U0001f600 " * 3000)], "doc_id long, text string")
    for docs in (awkward_documents(spark).select("doc_id", "text").union(special), small_documents(spark).select("doc_id", "text")):
        got = packing.packing_digest(docs)
        rows = got.collect()
        want = spark.createDataFrame(list(pieces_of(docs.collect(), 2048)), "a long, b int, c long, d long, e long")
        assert as_rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == as_rows(want)
        assert check_whole_sequences(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 2
        assert packing.packing_digest(docs.limit(0)).count() == 0


def test_kept_ids_round_trip(spark):
    docs = small_documents(spark).limit(20)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    back = {}
    for r in packing.token_pieces(docs, keep_ids=True, capacity=100).orderBy("key", "piece").collect():
        back.setdefault(r.key, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert {k: own.decode(v[:-1]) for k, v in back.items()} == {r.doc_id: r.text for r in docs.collect()}


def test_bins_use_every_item_once_and_fit():
    rng = random.Random(5)
    for _ in range(30):
        counts = {}
        for _ in range(rng.randrange(1, 60)):
            counts[rng.randrange(1, 101)] = rng.randrange(1, 50)
        bins = packing.best_two_fit(counts, 100)
        used = {}
        for times, lengths in bins:
            assert sum(lengths) <= 100
            for x in lengths:
                used[x] = used.get(x, 0) + times
        assert used == counts
        spots = [(x, r) for x, a, b, _, _ in packing.placements(bins) for r in range(a, b + 1)]
        assert sorted(spots) == sorted((x, r) for x, n in counts.items() for r in range(n))


def test_shortest_item_makes_way_for_two():
    assert packing.best_two_fit({60: 1, 30: 1, 25: 1, 15: 1}, 100) == [(1, [60, 25, 15]), (1, [30])]


def test_plan_does_not_grow_with_the_items():
    rng = random.Random(9)
    counts = {x: rng.randrange(1, 1000) for x in range(1, 2049)}
    few = packing.best_two_fit(counts)
    many = packing.best_two_fit({x: n * 1000 for x, n in counts.items()})
    assert len(packing.placements(many)) < 3 * len(packing.placements(few))
