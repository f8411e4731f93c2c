"""Exact substring dedup by a distributed, common-prefix-aware merge sort of suffixes.

Every window of ``LENGTH`` bytes names one anchor inside it: the position of
its least gram hash, which depends on the window's bytes alone. Equal windows
thus have equal anchors, and only suffixes at anchors are sorted. A packet of
documents sorts its anchored suffixes into runs, the runs are front-coded and
exchanged by ranges, and a loser tree merges them without ever comparing a
prefix again that is known to be common. The lengths that neighbours have in
common, as the merge found them, decide which windows occur twice.

Grams that are found only once in the corpus cannot be part of a repeat, so
their suffixes are not exchanged. Windows around a gram found very often are
counted as windows instead, by a plain shuffle that splits any group.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitlens.llm.common import bounded_batches, stored
from hitlens.llm.packets import packed, packets, unpacked

LENGTH = 200
#: Bytes of an anchor's gram.
GRAM = 64
#: Bytes looked at together; below 2 ** 21, so that a position takes 21 bits.
CHUNK = 1 << 20
#: Grams found more often are handled as windows.
FREQUENT = 1 << 16
#: Suffixes of one range of the merge, about.
RANGE = 50_000
#: Suffixes decided together, about.
BATCH = 20_000
#: Packets are smaller here than elsewhere: their suffixes are objects.
PACKET_BYTES = 8 << 20
_MASK = np.uint64((1 << 21) - 1)


@lru_cache(maxsize=2)
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(CHUNK + 2 * LENGTH, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def rolling(raw: np.ndarray, size: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of every ``size`` bytes of ``raw``."""
    power, inverse = _powers(base)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])))
    return _mixed((sums[size:] - sums[:-size]) * inverse[: len(raw) - size + 1])


def segments(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, first byte, end) that hold every window once, of about ``CHUNK`` bytes each."""
    group, load = [], 0
    for i, t in enumerate(texts):
        for start in range(0, max(len(t) - LENGTH + 1, 0), CHUNK // 2):
            end = min(len(t), start + CHUNK // 2 + LENGTH - 1)
            if load + end - start > CHUNK:
                yield group
                group, load = [], 0
            group.append((i, start, end))
            load += end - start
    if group:
        yield group


class Spans:
    """Maximal runs of consecutive windows that share an anchor, over the texts of a packet."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        parts = [self._of(group) for group in segments(texts)]
        empty = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
        self.text, self.first, self.last, self.anchor, self.gram = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else empty

    def _of(self, group: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b"".join(self.texts[i][a:b] for i, a, b in group), np.uint8)
        sizes = np.array([b - a for _, a, b in group])
        base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        h = rolling(raw, GRAM)
        least = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
        width, window = 1, LENGTH - GRAM + 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
        at = (least & _MASK).astype(np.int64)
        inside = np.zeros(len(at) + 1, np.int64)
        inside[base] += 1
        inside[base + sizes - LENGTH + 1] -= 1
        inside = np.cumsum(inside[:-1]) > 0
        new = np.concatenate(([True], (at[1:] != at[:-1]) | ~inside[:-1])) & inside
        end = np.concatenate(((at[1:] != at[:-1]) | ~inside[1:], [True])) & inside
        first, last = np.flatnonzero(new), np.flatnonzero(end)
        owner = np.searchsorted(base, first, side="right") - 1
        shift = np.array([a for _, a, _ in group])[owner] - base[owner]
        anchor = at[first]
        return np.array([i for i, _, _ in group])[owner], first + shift, last + shift, anchor + shift, h[anchor]


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    low, high, step = start, end, 16
    while a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Suffixes:
    """The different anchored suffixes of a packet, in order, and where they stand.

    A suffix is (gram hash + bytes from the anchor to the end of its last
    window, bytes before the anchor from its first window on).
    """

    def __init__(self, spans: Spans, grams: np.ndarray):
        grams = np.sort(grams)
        some = np.flatnonzero(np.isin(spans.gram, grams))
        places: dict[tuple[bytes, bytes], list[int]] = {}
        columns = (spans.text[some], spans.first[some], spans.last[some], spans.anchor[some])
        # Anchors have small hashes, being the least of their windows; spread them over all ranges.
        heads = (spans.gram[some] * np.uint64(0x9E3779B97F4A7C15)).astype(">u8").tobytes()
        for n, (i, text, first, last, anchor) in enumerate(zip(some.tolist(), *(c.tolist() for c in columns), strict=True)):
            raw = spans.texts[text]
            places.setdefault((heads[8 * n : 8 * n + 8] + raw[anchor : last + LENGTH], raw[first:anchor]), []).append(i)
        self.suffixes = sorted(places)
        self.places = [places[s] for s in self.suffixes]

    def runs(self, ranges: int) -> Iterator[tuple[int, bytes]]:
        """(range, front-coded run) for each range of gram hashes that holds any."""
        start = 0
        of = [int.from_bytes(right[:8], "big") * ranges >> 64 for right, _ in self.suffixes]
        for i in range(1, len(of) + 1):
            if i == len(of) or of[i] != of[start]:
                part = self.suffixes[start:i]
                known = [0] + [common(x[0], y[0]) for x, y in zip(part, part[1:], strict=False)]
                run = (known, [len(r) for r, _ in part], b"".join(r[k:] for (r, _), k in zip(part, known, strict=True)),
                       [len(x) for _, x in part], b"".join(x for _, x in part), start, [min(len(p), 2) for p in self.places[start:i]])
                yield of[start], zstandard.compress(pickle.dumps(run, 5), 1)
                start = i


def decoded(run: bytes) -> Iterator[tuple[int, bytes, bytes, int, int]]:
    """(bytes in common with the one before, right, left, index, occurrences) of each suffix of a run."""
    known, sizes, tails, left_sizes, lefts, first, times = pickle.loads(zstandard.decompress(run))
    at = left_at = 0
    right = b""
    for i, (k, size, left_size, n) in enumerate(zip(known, sizes, left_sizes, times, strict=True)):
        right = right[:k] + tails[at : at + size - k]
        at += size - k
        yield k, right, lefts[left_at : left_at + left_size], first + i, n
        left_at += left_size


def merged(runs: list[Iterator[tuple[int, bytes, bytes, int, int]]]) -> Iterator[tuple[int, int, bytes, bytes, int, int]]:
    """(bytes in common with the one before, run, right, left, index, occurrences) in the order of right.

    A loser tree whose entries know how much they share with the last winner:
    the one that shares more comes first, and only equals are compared, from
    the first byte that isn't known.
    """
    k = len(runs)
    heads = [next(r, None) for r in runs]
    shared = [0] * k  # with the last winner of the matches that the head has lost or won so far
    tree = [-1] * k  # losers; tree[0] is the winner

    def beats(a: int, b: int) -> bool:
        """Whether the head of run a comes before that of run b; the loser learns what it shares with the winner."""
        x, y = heads[a], heads[b]
        if y is None or x is None:
            return y is None
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        n = common(x[1], y[1], shared[a])
        first = (x[1][n:] < y[1][n:]) or (x[1] == y[1] and a < b)
        shared[b if first else a] = n
        return first

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if beats(a, b):
            tree[node] = b
            return a
        tree[node] = a
        return b

    winner = play(1) if k > 1 else 0
    while k and (head := heads[winner]) is not None:
        yield shared[winner], winner, *head[1:]
        heads[winner] = following = next(runs[winner], None)
        if following is not None:
            shared[winner] = following[0]
        node = (winner + k) // 2
        while node:
            if beats(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2


def runs_of(known: np.ndarray, least: int) -> np.ndarray:
    """The number of each sorted string's run: strings whose first ``least`` bytes are the same.

    ``known`` is what each has in common with the one before it.
    """
    return np.cumsum(known < least)


def repeated_windows(known: np.ndarray, sizes: np.ndarray, lefts: list[bytes]) -> np.ndarray:
    """Row i, column o: whether the window of suffix i from ``o`` bytes before its anchor on is one of another suffix too.

    ``known`` holds, for suffixes in the order of the merge, the bytes to the
    right of the anchor that each shares with the one before, ``sizes`` their
    numbers; no right part is looked at again. Two suffixes share a window if
    the least of these between them reaches its end and their left parts agree
    for ``o`` bytes. So the left parts are put in order too, and for each
    offset the suffixes that are in one run on both sides are counted.
    """
    back = [x[::-1] for x in lefts]
    order = sorted(range(len(back)), key=back.__getitem__)
    known_left = np.array([0] + [common(back[a], back[b]) for a, b in zip(order, order[1:], strict=False)])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    left_sizes = np.array([len(x) for x in lefts])
    out = np.zeros((len(order), LENGTH - GRAM + 1), bool)
    for offset in range(out.shape[1]):
        right_run = runs_of(known, LENGTH - offset)
        some = np.flatnonzero((left_sizes >= offset) & (sizes >= LENGTH - offset))
        some = some[np.bincount(right_run[some])[right_run[some]] > 1] if some.size else some
        both = right_run[some] * np.int64(len(order) + 1) + runs_of(known_left, offset)[rank[some]]
        by = np.argsort(both)
        twin = np.flatnonzero(both[by][1:] == both[by][:-1])
        out[some[by[twin]], offset] = out[some[by[twin + 1]], offset] = True
    return out


def decide(runs: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(run, index, packed bits of its repeated windows; empty for all) of the suffixes that have any."""
    held: list[tuple[int, int, int, int, bytes, int]] = []

    def close() -> Iterator[tuple[int, int, bytes]]:
        found = repeated_windows(np.array([h[0] for h in held]), np.array([h[1] for h in held]), [h[4] for h in held])
        for (_, size, run, index, left, n), row in zip(held, found, strict=True):
            marks = row[LENGTH - size : len(left) + 1][::-1]
            if n > 1 or marks.all():
                yield run, index, b""
            elif marks.any():
                yield run, index, np.packbits(marks).tobytes()

    for shared, run, right, left, index, n in merged([decoded(r) for r in runs]):
        if len(held) >= BATCH and shared < 8 + GRAM:  # a batch ends with a gram
            yield from close()
            held = []
        held.append((shared - 8, len(right) - 8, run, index, left, n))
    if held:
        yield from close()


def window_hashes(spans: Spans, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, two hashes) of every window whose anchor has one of the given grams."""
    some = np.flatnonzero(np.isin(spans.gram, grams))
    text, first, h1, h2 = [], [], [], []
    for i in some.tolist():
        a, b = int(spans.first[i]), int(spans.last[i])
        raw = np.frombuffer(spans.texts[spans.text[i]], np.uint8)[a : b + LENGTH]
        text.append(np.full(b - a + 1, spans.text[i]))
        first.append(np.arange(a, b + 1))
        h1.append(rolling(raw, LENGTH))
        h2.append(rolling(raw, LENGTH, 0xC2B2AE3D27D4EB4F))
    if not some.size:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(c) for c in (text, first, h1, h2))


_SIGNED = lambda a: pa.array(a.view(np.int64))
_PACKETS = "packet long, gram long, n long, blob binary"


def _packets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Packets of documents, and the anchor grams that each holds with their numbers."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packet, rows in packets(batches, 1, PACKET_BYTES):
            grams, n = np.unique(Spans([x or b"" for x in rows.column(1).to_pylist()]).gram, return_counts=True)
            size = len(grams) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, packet)), pa.concat_arrays([pa.nulls(1, pa.int64()), _SIGNED(grams)]),
                 pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(n, pa.int64())]), pa.array([packed(rows)] + [None] * len(grams), pa.binary())],
                ["packet", "gram", "n", "blob"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    return stored(rows.mapInArrow(run, _PACKETS), "suffix-packets")


def _texts(table: pa.Table) -> pa.Table:
    return unpacked(table.column("blob").drop_null().to_pylist()[0])


def _spans(table: pa.Table) -> Spans:
    return Spans([x or b"" for x in _texts(table).column("text").to_pylist()])


def _unsigned(table: pa.Table, column: str, where: pa.Array) -> np.ndarray:
    return table.column(column).filter(where).to_numpy().astype(np.int64).view(np.uint64)


def _grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Repeated grams that the packet holds: those sorted as suffixes, and the frequent ones."""
    frequent = table.column("frequent").to_pylist()
    return tuple(_unsigned(table, "gram", pa.array([f is want for f in frequent])) for want in (False, True))


def _with(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` with null columns of these types for those that it lacks, in this order."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in columns.items()])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT, keep_text: bool = False) -> DataFrame:
    """Per row: key, n_bytes, spans (removed byte ranges, maximal), kept_sha256 and, if asked for, the bytes kept.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts
    anywhere else in the table, the same document included. Matches never
    cross documents. Null texts are empty; texts shorter than ``LENGTH`` stay;
    very long ones are cut into overlapping segments inside a task. Repeated
    rows are copies of each other and both go. Keys may be null or repeat.
    """
    held = _packets(docs, key, text)
    # A gram has a row per packet at most.
    of_gram = Window.partitionBy("gram")
    known = stored(
        held.where("gram is not null").select("packet", "gram", F.sum("n").over(of_gram).alias("total"))
        .where("total > 1").select("packet", "gram", (F.col("total") > frequent).alias("frequent")), "repeated-grams")
    blobs = held.where("blob is not null").select("packet", "blob")
    ranges = 1 + known.where("not frequent").count() // RANGE

    asked = dict(packet="long", blob="binary", gram="long", frequent="boolean")
    questions = _with(blobs, **asked).unionByName(_with(known, **asked)).groupBy("packet")

    def sort(table: pa.Table) -> pa.Table:
        packet = table.column("packet")[0].as_py()
        rare, common_grams = _grams(table)
        spans = _spans(table)
        runs = list(Suffixes(spans, rare).runs(ranges)) if len(rare) else []
        _, _, h1, h2 = window_hashes(spans, common_grams)
        pairs, times = np.unique(np.stack((h1, h2), axis=1), axis=0, return_counts=True)
        size = len(runs) + len(pairs)
        lead, tail = [None] * len(runs), [None] * len(pairs)
        return pa.table({
            "packet": pa.array(np.full(size, packet)), "range": pa.array([r for r, _ in runs] + tail, pa.int64()), "run": pa.array([b for _, b in runs] + tail, pa.binary()),
            **{c: pa.concat_arrays([pa.nulls(len(runs), pa.int64()), _SIGNED(pairs[:, j].copy())]) for j, c in enumerate(("h1", "h2"))},
            "n": pa.array(lead + times.tolist(), pa.int64())})

    sorted_runs = stored(questions.applyInArrow(sort, "packet long, range long, run binary, h1 long, h2 long, n long"), "suffix-runs")

    def merge(table: pa.Table) -> pa.Table:
        order = sorted(zip(table.column("packet").to_pylist(), table.column("run").to_pylist(), strict=True))
        rows = [(order[r][0], index, bits) for r, index, bits in decide([run for _, run in order])]
        return pa.table({c: pa.array([x[j] for x in rows], t) for j, (c, t) in enumerate((("packet", pa.int64()), ("suffix", pa.int64()), ("bits", pa.binary())))})

    decided = stored(sorted_runs.where("range is not null").groupBy("range").applyInArrow(merge, "packet long, suffix long, bits binary"), "repeated-suffixes")
    twice = (
        sorted_runs.where("h1 is not null").select("packet", "h1", "h2", F.sum("n").over(Window.partitionBy("h1", "h2")).alias("total"))
        .where("total > 1").select("packet", "h1", "h2"))

    answered = asked | dict(suffix="long", bits="binary", h1="long", h2="long")
    answers = _with(blobs, **answered)
    for part in (known, decided, twice):
        answers = answers.unionByName(_with(part, **answered))

    def remove(table: pa.Table) -> pa.Table:
        rows = _texts(table)
        texts = [x or b"" for x in rows.column("text").to_pylist()]
        rare, common_grams = _grams(table)
        text_at, start_at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]  # text and first byte of each repeated window
        if len(rare) or len(common_grams):
            spans = Spans(texts)
            found = Suffixes(spans, rare) if table.column("suffix").drop_null() else None
            for suffix, bits in zip(table.column("suffix").to_pylist(), table.column("bits").to_pylist(), strict=True):
                if suffix is not None:
                    for i in found.places[suffix]:
                        n = int(spans.last[i] - spans.first[i]) + 1
                        some = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=n)) if bits else np.arange(n)
                        start_at.append(some + spans.first[i])
                        text_at.append(np.full(len(some), spans.text[i]))
            where = table.column("h1").is_valid()
            both = np.stack((_unsigned(table, "h1", where), _unsigned(table, "h2", where)), axis=1)
            if len(both):
                text_of, first, h1, h2 = window_hashes(spans, common_grams)
                yes = np.isin(np.stack((h1, h2), axis=1).view("u8,u8").ravel(), np.ascontiguousarray(both).view("u8,u8").ravel())
                text_at.append(text_of[yes])
                start_at.append(first[yes])
        text_of, starts = np.concatenate(text_at), np.concatenate(start_at)
        starts = starts[np.argsort(text_of, kind="stable")]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(text_of, minlength=len(texts)))))
        out = []
        for t, raw in enumerate(texts):
            ranges, kept = removed(raw, starts[bounds[t] : bounds[t + 1]])
            out.append((len(raw), [{"start": a, "end": b} for a, b in ranges], hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = {c: pa.array([r[j] for r in out], t) for j, (c, t) in enumerate((("n_bytes", pa.int64()), ("spans", span), ("kept_sha256", pa.string()), ("kept", pa.binary())))}
        return pa.table({"key": rows.column("key"), **columns})

    kind = docs.schema[key].dataType.simpleString()
    done = answers.groupBy("packet").applyInArrow(
        remove, f"key {kind}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string, kept binary")
    return done if keep_text else done.drop("kept")


def removed(raw: bytes, starts: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal ranges covered by the windows from ``starts`` on (all different), and the bytes outside them."""
    if not starts.size:
        return [], raw
    edge = np.zeros(len(raw) + 1, np.int64)
    edge[starts] += 1
    edge[starts + LENGTH] -= 1
    covered = np.concatenate(([False], np.cumsum(edge[:-1]) > 0, [False]))
    bounds = np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2).tolist()
    return [(a, b) for a, b in bounds], np.frombuffer(raw, np.uint8)[~covered[1:-1]].tobytes()


def suffix_digest(docs: DataFrame) -> DataFrame:
    return repeated_spans(docs).select(
        F.col("key").alias("doc_id"), "n_bytes", F.expr("aggregate(spans, 0L, (s, x) -> s + x.end - x.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
