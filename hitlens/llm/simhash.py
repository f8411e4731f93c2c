"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ
in at most four bits differ in at most one bit of some segment, so with one
bit of it masked out both segments read the same. Every one-wildcard variant
of every segment is indexed, equal variants meet, and the bit distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from hitlens.llm.common import bounded_batches, boxed, own, stored, utf8
from hitlens.llm.graph import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Buckets of more than this many fingerprints are dealt out as pairs of blocks.
BLOCK = 2048
#: Up to so many members all pairs of a bucket are compared at once, else along a spanning forest.
FEW = 8


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words (one shingle of all if there are fewer)."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[size - 1 :].tolist() or [len(joined)]
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)], np.uint64)


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the shingle hashes; without words all bits are unset."""
    h = shingle_hashes(raw, size)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, size: int = SHINGLE) -> DataFrame:
    """(key, fp, text_hash) per row; fp holds the 64 bits as a signed long."""
    bounded_batches(docs.sparkSession)

    @arrow_udf(T.LongType())
    def mark(column: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(raw, size) for raw in utf8(column)], np.uint64).view(np.int64))

    return docs.select(F.col(key).alias("key"), mark(F.col(text).cast("string")).alias("fp"), F.xxhash64(F.col(text)).alias("text_hash"))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one differs by at most one bit."""
    n = distance // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variants(nodes: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """(bucket, fp): every fingerprint under all its one-wildcard segment variants.

    A bucket that may exceed ``block`` members is dealt out: its members fall
    into blocks, and each pair of blocks is a bucket of its own, so that any
    two members still meet and none holds over about two blocks.
    """
    cut = segments(distance)
    segs = F.array(*[F.struct(F.lit(i).alias("seg"), F.lit(bits).alias("bits"),
                              F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1)).alias("value")) for i, (first, bits) in enumerate(cut)])
    parts = nodes.select("fp", F.inline(segs))
    spots = lambda: F.explode(F.expr("sequence(0, bits - 1)")).alias("pos")
    masked = F.expr("value & ~shiftleft(1L, pos)").alias("masked")
    # A crowded bucket has a crowded value on one side of its wildcard at least.
    crowded = parts.groupBy("seg", "bits", "value").agg(F.count("*").alias("n")).where(F.col("n") > block // 2)
    sides = crowded.select("seg", "n", "value", spots()).select("seg", "pos", masked, "n").groupBy("seg", "pos", "masked").agg(F.sum("n").alias("n"))
    dealt = sides.select("seg", "pos", F.ceil((F.col("n") + block // 2) / block).alias("blocks"),
                         F.explode(F.expr("array(masked, masked | shiftleft(1L, pos))")).alias("value"))
    dealt = stored(dealt.groupBy("seg", "value").agg(F.map_from_entries(F.collect_list(F.struct("pos", "blocks"))).alias("dealt")), "crowded-values")
    spread = (
        parts.join(dealt, ["seg", "value"], "left")
        .select("fp", "seg", "value", "dealt", spots())
        .select("fp", F.expr("((seg * 64L + pos) << 23) | (value & ~shiftleft(1L, pos))").alias("variant"),
                F.coalesce(F.element_at("dealt", F.col("pos")), F.lit(1)).alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pairs = spread.select("fp", "variant", "blocks", mine.alias("mine"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"))
    pair = F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")
    return pairs.select(F.shiftleft("variant", 32).bitwiseOR(pair).alias("bucket"), "fp")


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def forest(members: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is connected among ``members``, at most one per member."""
    left, out = np.sort(members), []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            pivot = front.pop()
            near = _near(left, pivot, distance)
            if near.any():
                found = left[near]
                out.append((np.full(len(found), pivot), found))
                front.extend(found)
                left = left[~near]
    return out


def bucket_links(bucket: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole buckets (sorted); each small bucket gives all its pairs, a larger one a spanning forest."""
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(bucket)])))
    out = []
    few = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
    b, f = bucket[few], fp[few]
    for shift in range(1, FEW):
        hit = np.flatnonzero((b[shift:] == b[:-shift]) & _near(f[shift:], f[:-shift], distance)) if len(b) > shift else []
        if len(hit):
            out.append((f[hit], f[hit + shift]))
    for i in np.flatnonzero(sizes > FEW):
        out += forest(fp[starts[i] : starts[i] + sizes[i]], distance)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    u, v = (np.concatenate([pair[i] for pair in out]) for i in (0, 1))
    both = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v)), axis=1), axis=0)
    return both[:, 0], both[:, 1]


def links(nodes: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(u, v) links between distinct fingerprints (column fp) that connect all within ``distance``."""
    bounded_batches(nodes.sparkSession)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_bucket, held_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        names = ["u", "v"]

        def found(bucket: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(bucket) > 1:
                u, v = bucket_links(bucket, fp, distance)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names)

        held = 0
        for batch in batches:
            waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
            held += batch.num_rows
            if held < 1 << 17:  # work on many buckets at a time
                continue
            bucket = np.concatenate([held_bucket, *(w[0] for w in waiting)])
            fp = np.concatenate([held_fp, *(w[1] for w in waiting)])
            waiting, held = [], 0
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            yield from found(bucket[:cut], fp[:cut])
            held_bucket, held_fp = bucket[cut:], fp[cut:]
        yield from found(np.concatenate([held_bucket, *(w[0] for w in waiting)]), np.concatenate([held_fp, *(w[1] for w in waiting)]))

    met = variants(nodes, distance, block).repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(meet, "u long, v long").distinct()


def grouped(docs: DataFrame, key: str, text: str, size: int, distance: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The marked rows (key, fp, text_hash), and (fp, root, component_id) of each distinct fingerprint."""
    marked = stored(fingerprints(docs, key, text, size), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("key").alias("least")), "fingerprint-nodes")
    found = components(links(nodes, distance, block)).withColumnsRenamed({"node": "fp"})
    rooted = found.join(nodes, "fp")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    linked = rooted.join(least, "root").select("fp", "root", "component")
    alone = F.col("root").isNull()
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(alone, F.col("least")).otherwise(F.col("component")).alias("component_id"))
    # Written, so that a join with it reads plain shuffles, whose hot fingerprints Spark can split.
    return marked, stored(named, "fingerprint-components")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Per row: key, fp and component_id, the smallest key reachable over links of at most ``distance`` bits.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other. Rows of equal texts share a fingerprint and meet once, as one node.
    Null keys never win; a component of null keys only has a null id. An empty
    table gives an empty result.
    """
    marked, named = grouped(docs, key, text, size, distance, block)
    return marked.join(named, "fp").select("key", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                         distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """One row of each component, with its own columns: that of the smallest key
    (null is the largest), and of these the smallest text hash. Of repeated
    rows one stays."""
    marked, named = grouped(docs, key, text, size, distance, block)
    # Combined per fingerprint before it meets its component: copies never gather in one task.
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_hash")).alias("first")
    of_fp = marked.groupBy("fp").agg(first)
    of_root = of_fp.join(named, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.key", "first.text_hash")
    repeats = marked.groupBy("key", "text_hash").agg(F.count("*").alias("n")).where("n > 1").withColumnsRenamed({"key": "k", "text_hash": "h"})
    again = F.col("key").eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("h"))
    stay = of_root.join(repeats, again, "left").select(F.col("key").alias("stay_key"), F.col("text_hash").alias("stay_text"), F.coalesce("n", F.lit(1)).alias("copies"))
    stay = stored(stay, "survivors")
    rows = docs.select(boxed(docs), own(key).alias("own_key"), F.xxhash64(own(text)).alias("own_text"))
    same = F.col("own_key").eqNullSafe(F.col("stay_key")) & (F.col("own_text") == F.col("stay_text"))
    only = lambda which: rows.join(stay.where(which), same, "left_semi")
    # A row has copies only if key and text repeat; those alone are regrouped.
    twice = only("copies > 1").dropDuplicates(["own_key", "own_text"])
    return only("copies = 1").unionByName(twice).select("row.*")


def simhash_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
