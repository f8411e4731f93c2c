"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts up to ``ORDER`` bytes, kept as counts of
byte grams. Escapes are estimated by the number of distinct symbols seen in a
context, and symbols of an escaped context are excluded from shorter ones. A
text's score is its code length, a sum over its bytes; so each packet of
documents asks the corpus for the grams and words that it holds, once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlens.llm.common import bounded_batches, stored
from hitlens.llm.packets import packed, packets, unpacked

ORDER = 4
#: Stands before and after every text; no UTF-8 text holds this byte.
EDGE = 0xFF
SYMBOLS = 256
#: The token that ends each document; no word is empty.
END = b""
#: Bytes of text whose grams are looked at together.
CHUNK = 1 << 19
#: Text bytes of a packet.
PACKET_BYTES = 16 << 20


def held_out(key: Column) -> Column:
    """Documents that the model doesn't learn from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def grams(texts: list[bytes]) -> np.ndarray:
    """The ``ORDER`` bytes before each symbol and the symbol, as one number, for every byte and the end of each text."""
    pad = bytes([EDGE]) * ORDER
    raw = np.frombuffer(b"".join(pad + t + pad[:1] for t in texts), np.uint8).astype(np.int64)
    code = np.zeros(len(raw) - ORDER, np.int64)
    for j in range(ORDER + 1):
        code = (code << 8) | raw[j : len(raw) - ORDER + j]
    ends = np.cumsum([len(t) + ORDER + 1 for t in texts])[:-1]  # windows across two texts go
    keep = np.ones(len(code), bool)
    for j in range(ORDER):
        keep[ends - 1 - j] = False
    return code[keep]


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Slices of the list with about ``CHUNK`` bytes each."""
    start, load = 0, 0
    for i, t in enumerate(texts):
        if load and load + len(t) > CHUNK:
            yield start, i
            start, load = i, 0
        load += len(t) + 1
    if texts:
        yield start, len(texts)


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of the texts, in order, and their numbers.

    Chunks are added to a stack of sorted runs, in which each is at least
    twice as long as the next: little more than the result is held.
    """
    stack: list[tuple[np.ndarray, np.ndarray]] = []

    def merge_top() -> None:
        (a, n), (b, m) = stack.pop(), stack.pop()
        codes, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
        stack.append((codes, np.bincount(inverse, np.concatenate((n, m)), len(codes)).astype(np.int64)))

    for a, b in chunks(texts):
        stack.append(np.unique(grams(texts[a:b]), return_counts=True))
        while len(stack) > 1 and len(stack[-2][0]) < 2 * len(stack[-1][0]):
            merge_top()
    while len(stack) > 1:
        merge_top()
    return stack[0] if stack else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def tokens(text: bytes) -> list[bytes]:
    return [*text.split(), END]


_ASK = pa.schema([("packet", pa.int64()), ("word", pa.binary()), ("code", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())])


def _asked(packet: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The packet itself, its distinct words and its distinct grams, with their counts in training documents."""
    lower = [(x or b"").lower() for x in rows.column(2).to_pylist()]
    train = [t for t, h in zip(lower, rows.column(1).to_pylist(), strict=True) if not h]
    held = [t for t, h in zip(lower, rows.column(1).to_pylist(), strict=True) if h]
    words: Counter[bytes] = Counter()
    for t in train:
        words.update(tokens(t))
    for t in held:
        for w in tokens(t):
            words.setdefault(w, 0)
    codes, counts = gram_counts(train)
    only_held = np.setdiff1d(gram_counts(held)[0], codes, assume_unique=True)
    codes, counts = np.concatenate((codes, only_held)), np.concatenate((counts, np.zeros(len(only_held), np.int64)))

    def batch(size: int, **columns: pa.Array) -> pa.RecordBatch:
        columns["packet"] = pa.array(np.full(size, packet))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _ASK], schema=_ASK)

    yield batch(1, blob=pa.array([packed(rows)], pa.binary()))
    for at in range(0, len(codes), 1 << 17):
        c = codes[at : at + (1 << 17)]
        yield batch(len(c), code=pa.array(c), n=pa.array(counts[at : at + (1 << 17)]))
    names, numbers = list(words), list(words.values())
    for at in range(0, len(names), 1 << 17):
        w = names[at : at + (1 << 17)]
        yield batch(len(w), word=pa.array(w, pa.binary()), n=pa.array(numbers[at : at + (1 << 17)], pa.int64()))


def ask(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Packets and what they ask for, written once."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packet, rows in packets(batches, 2, PACKET_BYTES):
            yield from _asked(packet, rows)

    rows = docs.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held"), F.col(text).cast("string").cast("binary").alias("text"))
    return stored(rows.mapInArrow(run, "packet long, word binary, code long, n long, blob binary"), "lm-packets")


def ppm_log10(codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of each gram's last symbol after its first bytes.

    ``codes`` are all grams (with their counts) that end in the same two
    context bytes and a symbol, for some such bytes; ``pairs[x, s]`` counts
    symbol s after byte x over the whole corpus.
    """
    single = pairs.sum(axis=0)
    levels = {}
    for k in range(ORDER, 1, -1):
        names, at = np.unique(codes & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        n = np.bincount(at, counts, len(names))
        levels[k] = names, at, n

    def shorter(k: int, names: np.ndarray) -> np.ndarray:
        """Counts of the grams of order k + 1 without their first byte."""
        if k == 1:
            return pairs[(names >> 8) & 0xFF, names & 0xFF]
        below, _, n = levels[k]
        return n[np.searchsorted(below, names & ((1 << 8 * (k + 1)) - 1))]

    log = np.zeros(len(codes))
    alive = np.ones(len(codes), bool)
    gone_total, gone_symbols = np.zeros(len(codes)), np.zeros(len(codes))
    for k in range(ORDER, -1, -1):
        if k > 1:
            names, at, n = levels[k]
            _, context = np.unique(names >> 8, return_inverse=True)
            total, symbols = np.bincount(context, n), np.bincount(context, n > 0)
            lower = np.bincount(context, np.where(n > 0, shorter(k - 1, names), 0))
            n, context = n[at], context[at]
            total, symbols, lower = total[context], symbols[context], lower[context]
        elif k == 1:
            x, s = (codes >> 8) & 0xFF, codes & 0xFF
            n, total, symbols = pairs[x, s], pairs.sum(axis=1)[x], (pairs > 0).sum(axis=1)[x]
            lower = np.where(pairs > 0, single, 0).sum(axis=1)[x]
        else:
            n, total, symbols = single[codes & 0xFF], np.full(len(codes), single.sum()), np.full(len(codes), (single > 0).sum())
            lower = np.zeros(len(codes))
        known = alive & (total > 0)
        left, kinds = total - gone_total, symbols - gone_symbols
        hit = known & (n > 0)
        log[hit] += np.log10(n[hit] / (left + kinds)[hit])
        miss = known & ~hit
        escape = miss & (left > 0)
        log[escape] += np.log10((kinds / np.maximum(left + kinds, 1))[escape])
        gone_total, gone_symbols = np.where(miss, lower, gone_total), np.where(miss, symbols, gone_symbols)
        alive &= ~hit
    log[alive] -= np.log10(SYMBOLS - gone_symbols[alive])
    return log


def gram_model(asked: DataFrame) -> DataFrame:
    """(code, log10): the model's value of every gram that some packet asks for."""
    counts = stored(asked.where("code is not null").groupBy("code").agg(F.sum("n").alias("n")), "lm-grams")
    pairs = np.zeros((SYMBOLS, SYMBOLS))
    # At most 65,536 rows.
    for r in counts.groupBy(F.expr("code & 65535").alias("pair")).agg(F.sum("n").alias("n")).collect():
        pairs[r.pair >> 8, r.pair & 0xFF] = r.n

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = list(batches)
        codes = np.concatenate([b.column(0).to_numpy() for b in table]) if table else np.zeros(0, np.int64)
        if len(codes):
            n = np.concatenate([b.column(1).to_numpy() for b in table])
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(ppm_log10(codes, n, pairs))], ["code", "log10"])

    return counts.repartition(F.expr("(code >> 8) & 65535")).mapInArrow(values, "code long, log10 double")


class Slots:
    """Values of known numbers, most of them found at the first probe of a hash table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(8, int(2 * len(keys)).bit_length()))
        self.slot = np.zeros(1 << (64 - int(self.shift)), np.int64)
        self.slot[self.at(self.keys)] = np.arange(len(keys))

    def at(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found = self.slot[self.at(keys)]
        other = np.flatnonzero(self.keys[found] != keys)
        found[other] = np.searchsorted(self.keys, keys[other])
        return self.values[found]


def score_packet(rows: pa.Table, logs: dict[bytes, float], value: Slots) -> pa.RecordBatch:
    """Per document of a packet: key, held, n_tokens, n_known, log_counts and score."""
    lower = [(x or b"").lower() for x in rows.column("text").to_pylist()]
    n_tokens, n_known, log_counts, score = [], [], [], np.zeros(len(lower))
    for t in lower:
        own = np.fromiter(map(logs.__getitem__, tokens(t)), float)
        n_tokens.append(len(own))
        n_known.append(int(np.count_nonzero(own)))
        log_counts.append(float(own.sum()))
    for a, b in chunks(lower):
        sizes = [len(t) + 1 for t in lower[a:b]]
        score[a:b] = np.add.reduceat(value(grams(lower[a:b])), np.cumsum([0, *sizes[:-1]]))
    return pa.RecordBatch.from_arrays(
        [rows.column("key").combine_chunks(), rows.column("held").combine_chunks(), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
         pa.array(log_counts, pa.float64()), pa.array(score)], ["key", "held_out", "n_tokens", "n_known", "log_counts", "score"])


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    A null or empty text is the end alone. Very long texts are scored whole.
    Repeated rows count and are scored each; ties don't arise. Without
    training documents every word is unknown and every byte equally likely. An
    empty table gives an empty result.
    """
    asked = ask(docs, key, text)
    # A word has a row per packet at most, however frequent it is.
    of_word = Window.partitionBy("word")
    words = stored(
        asked.where("word is not null").select("packet", "word", F.sum("n").over(of_word).alias("c"), F.min("packet").over(of_word).alias("first")),
        "lm-words")
    whole = words.where("packet = first").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    model = asked.where("code is not null").select("packet", "code").join(gram_model(asked), "code")
    nothing = lambda kind: F.lit(None).cast(kind)
    answers = (
        asked.where("blob is not null").select("packet", "blob", nothing("binary").alias("word"), nothing("long").alias("code"), nothing("double").alias("value"))
        .unionByName(words.select("packet", nothing("binary").alias("blob"), "word", nothing("long").alias("code"), F.col("c").cast("double").alias("value")))
        .unionByName(model.select("packet", nothing("binary").alias("blob"), nothing("binary").alias("word"), "code", F.col("log10").alias("value")))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One packet. Its answers come in batches; only what they say is held."""
        blob, logs, codes, values = b"", {}, [], []
        for batch in batches:
            word, code, value = (batch.column(c) for c in ("word", "code", "value"))
            of_words, of_codes = word.is_valid(), code.is_valid()
            logs.update(zip(word.filter(of_words).to_pylist(), np.log10(value.filter(of_words).to_numpy() + 1).tolist(), strict=True))
            codes.append(code.filter(of_codes).to_numpy())
            values.append(value.filter(of_codes).to_numpy())
            for x in batch.column("blob").drop_null():
                blob = x.as_py()
        yield score_packet(unpacked(blob), logs, Slots(np.concatenate(codes), np.concatenate(values)))

    kind = docs.schema[key].dataType.simpleString()
    scored = answers.groupBy("packet").applyInArrow(
        score, f"key {kind}, held_out boolean, n_tokens long, n_known long, log_counts double, score double")
    base = F.col("log_counts") - F.col("n_tokens") * F.lit(math.log10(whole.n + whole.v + 1))
    return scored.select("key", "held_out", "n_tokens", "n_known", F.lit(whole.n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def lm_digest(docs: DataFrame) -> DataFrame:
    return lm_scores(docs).withColumnRenamed("key", "doc_id")
