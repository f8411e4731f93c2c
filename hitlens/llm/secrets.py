"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from hitlens.llm.common import bounded_batches, utf8

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
# The three patterns and their least lengths. Every class in
# them is ASCII, so bytes and characters match alike.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

#: Candidate strings of the entropy scan: runs of token characters of this length at least.
CANDIDATE = 20
#: Character class -> (its members, window in characters, least entropy in bits per character of a window).
CLASSES = {
    "entropy_hex": (frozenset(b"0123456789abcdefABCDEF"), 32, 3.2),
    "entropy_base64": (frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 20, 3.9),
}
#: Candidates that are no secrets however mixed they look: single-case words,
#: identifiers of 8-4-4-4-12 hex digits, alphabets and digit rows, placeholders.
ALLOWED = (
    re.compile(rb"[A-Z]?[a-z]+|[A-Z]+"),
    re.compile(rb"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(rb".*(?:abcdefghij|ABCDEFGHIJ|0123456789|EXAMPLE|example).*", re.DOTALL),
    re.compile(rb"(?:[A-Za-z]+[-_/.]+)+[A-Za-z]*"),
    re.compile(rb"[0-9.+/=_-]+"),
)
_TOKEN = np.zeros(256, bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")] = True


def token_runs(raw: bytes, least: int) -> list[tuple[int, int]]:
    """Maximal runs of token characters of ``least`` bytes or more."""
    breaks = np.flatnonzero(~_TOKEN[np.frombuffer(raw, np.uint8)])
    edges = np.concatenate(([-1], breaks, [len(raw)]))
    long = np.flatnonzero(np.diff(edges) > least)
    return [(int(edges[i]) + 1, int(edges[i + 1])) for i in long]


def entropy_windows(run: bytes, window: int, least: float) -> list[tuple[int, int]]:
    """Merged spans of the windows whose Shannon entropy is ``least`` or more.

    Sum of c*log2(c) over the window's character counts is kept up to date as
    one character enters and one leaves.
    """
    if len(run) < window:
        return []
    counts = [0] * 256
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    total, spans = 0.0, []
    for i, ch in enumerate(run):
        total += weight[counts[ch] + 1] - weight[counts[ch]]
        counts[ch] += 1
        if i >= window:
            old = run[i - window]
            total += weight[counts[old] - 1] - weight[counts[old]]
            counts[old] -= 1
        if i >= window - 1 and math.log2(window) - total / window >= least:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def class_runs(run: bytes, members: frozenset[int]) -> Iterator[tuple[int, int]]:
    start = 0
    for i, ch in enumerate(run):
        if ch not in members:
            if i > start:
                yield start, i
            start = i + 1
    if start < len(run):
        yield start, len(run)


def find_spans(raw: bytes) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in bytes, by start, then kind as listed."""
    found = []
    low = raw.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(raw) if len(m[2]) >= LEAST["assign"]]
    for start, end in token_runs(raw, LEAST["access"]):
        run = raw[start:end]
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            found += [(kind, start + m.start(), start + m.end()) for m in pattern.finditer(run) if len(m[0]) >= LEAST[kind]]
        if end - start < CANDIDATE:
            continue
        for kind, (members, window, least) in CLASSES.items():
            for a, b in class_runs(run, members):
                if b - a >= CANDIDATE and not any(p.fullmatch(run[a:b]) for p in ALLOWED):
                    found += [(kind, start + a + x, start + a + y) for x, y in entropy_windows(run[a:b], window, least)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def in_code_points(raw: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if not spans or raw.isascii():
        return spans
    before = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [(k, int(before[a]), int(before[b])) for k, a, b in spans]


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


@arrow_udf(T.ArrayType(_SPAN))
def _spans(text: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in in_code_points(raw, find_spans(raw))] for raw in utf8(text)], kind)


def scan_secrets(docs: DataFrame, text: str = "text", column: str = "secrets") -> DataFrame:
    """``docs`` plus the array ``column`` of spans (kind, start, end) in code points, end exclusive.

    Null and empty texts have no spans; very long texts are scanned whole.
    Rows are independent: repeats are scanned each, an empty table stays
    empty. A column of the same name is replaced.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(column, _spans(F.col(text).cast("string")))


def secrets_digest(docs: DataFrame) -> DataFrame:
    s = scan_secrets(docs.select("doc_id", "text"))
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda x: x["kind"].isin("assign", "access", "hex"))
    return s.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                    F.sha2(text(base), 256).alias("base_sha256"), text(F.col("secrets")).alias("spans"))
