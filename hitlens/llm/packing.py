"""Best-two-fit packing of tokenised documents into sequences.

Only piece lengths matter for packing, and there are at most ``capacity`` of
them: bins are planned over the histogram of lengths (with multiplicities),
then every piece finds its bin from its rank among the pieces of its length.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hitlens.llm.common import bounded_batches, stored

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Pieces of one length are numbered in parts of about so many.
PART_ROWS = 4096
#: Parts up to which their first ranks are sent to all tasks (some 24 bytes each).
BROADCAST_PARTS = 1 << 20


class ByteBpe:
    """Ids of a byte-level BPE file, through the faster of two equal encoders.

    Texts that spell out a special token go to the file's own tokenizer,
    which reads it as that token.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.plain = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path = path

    @cached_property
    def own(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.plain.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than the rest."""
    head = n % capacity or capacity
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 tokenizer: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32 and, if asked for, its ids (little-endian unsigned 32-bit)."""
    bounded_batches(docs.sparkSession)
    path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
    kind = docs.schema[key].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            of, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(bpe.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                for p, (start, length) in enumerate(cuts(len(ids), capacity)):
                    raw = ids[start : start + length].tobytes()
                    of.append(i)
                    rows.append((p, start, length, crc32(raw), raw if keep_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [batch.column(0).take(pa.array(of, pa.int64()))] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["key", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + keep_ids], names[: 5 + keep_ids])

    out = f"key {kind.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(cut, out)


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Bins as (how many, lengths in one), using every item of ``counts`` (length -> items).

    A bin is filled greedily, the longest item that fits first. If a gap is
    left, its shortest item makes way for the two unpacked items that fill the
    widened gap best, if they fill it better. A bin repeats as long as its
    items last, so the work depends on the lengths, not on the items.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    every = np.arange(capacity + 1)
    bins = []
    while left.any():
        now, gap, chosen = left.copy(), capacity, []
        below = np.maximum.accumulate(np.where(now > 0, every, 0))  # the longest item of at most so many
        while gap and (length := int(below[gap])):
            take = min(int(now[length]), gap // length)
            chosen += [length] * take
            now[length] -= take
            gap -= take * length
            if not now[length]:
                below = np.maximum.accumulate(np.where(now > 0, every, 0))
        if gap and len(chosen) > 1:
            short = chosen[-1]
            room = gap + short
            first = np.flatnonzero(now[:room])
            second = below[np.minimum(first, room - first)]
            second = np.where((second == first) & (now[first] < 2), below[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            if len(total) and total.max() > short:
                best = int(total.argmax())
                chosen[-1:] = [int(first[best]), int(second[best])]
        lengths, uses = np.unique(chosen, return_counts=True)
        times = int((left[lengths] // uses).min())
        left[lengths] -= times * uses
        bins.append((times, chosen))
    return bins


def placements(bins: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset) of every run of equal placements."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for times, lengths in bins:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            out.append((length, rank, rank + times - 1, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with key, piece, start, length, ids_crc32) plus sequence_id and offset.

    The histogram has at most ``capacity`` rows and the plan a bounded number
    of runs for them, whatever the number of pieces. Equal rows are separate
    pieces; an empty table packs into nothing.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(placements(best_two_fit(counts, capacity)),
                                 "length long, rank_from long, rank_to long, first_sequence long, offset long")
    parts = spark.createDataFrame([(length, -(-n // PART_ROWS)) for length, n in counts.items()], "length long, parts long")
    part = F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.col("parts"))
    # At most ``capacity`` rows.
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", part)
    # A row per part: at most ``capacity`` and one for every PART_ROWS pieces.
    before_it = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before_it), F.lit(0)).alias("before"))
    few = capacity + sum(counts.values()) // PART_ROWS <= BROADCAST_PARTS
    place = F.row_number().over(Window.partitionBy("length", "part").orderBy("key", "piece", "start", "ids_crc32")) - 1
    numbered = dealt.withColumn("place", place)
    ranked = numbered.join(F.broadcast(starts) if few else starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place"))
    return (
        ranked.join(F.broadcast(plan.withColumnRenamed("length", "of")), F.expr("length = of AND rank BETWEEN rank_from AND rank_to"))
        .withColumn("sequence_id", F.expr("first_sequence + rank - rank_from"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   tokenizer: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack. A null text is empty: one piece that holds only the end id."""
    return pack(stored(token_pieces(docs, key, text, capacity, tokenizer, keep_ids), "token-pieces"), capacity)


def packing_digest(docs: DataFrame) -> DataFrame:
    return pack_documents(docs).select(F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
