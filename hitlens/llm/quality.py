"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements
and one failure bit per rule. A policy is a named, versioned set of rules and
is applied as a bit mask, so policies and ablations never touch a text again.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from hitlens.llm.common import LOWER, UPPER, bounded_batches, own, stored, utf8

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_bangs", "n_upper", "n_lower", "n_stutters")
#: Rule -> failure condition over the measurements (SQL, so that the ledger
#: and any engine evaluate the same text). The order fixes the bit numbers:
#: append only.
RULES = {
    "too_short": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "n_lines >= 4 AND 2 * n_dup_lines > n_lines",
    "shouting": "n_upper > n_lower",
    "bangs": "4 * n_bangs > n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "stutters": "100 * n_stutters > 30 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules that a kept document must pass."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("too_short", "repeated_windows"))
DEFAULT = Policy("default", 1, tuple(RULES))
#: Version 2 doesn't judge by capitals and exclamation marks.
WITHOUT_TONE = Policy("default", 2, tuple(r for r in RULES if r not in ("shouting", "bangs")))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    m = n - window + 1
    rolled = np.zeros(m, np.uint64)
    for j in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[j : j + m]
    rolled.sort()
    if not (rolled[1:] == rolled[:-1]).any():  # equal windows hash alike, so none is repeated
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    step = 1
    while step < window:  # names of 2, 4, 8 words from exact pairs of names
        _, ids = np.unique(ids[:-step] * np.int64(n) + ids[step:], return_inverse=True)
        step *= 2
    hit = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(raw: bytes) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    gone = lambda chars: len(raw) - len(raw.translate(None, chars))
    word_bytes = sum(map(len, words))
    inner = gone(bytes(range(0x80, 0xC0)))  # continuation bytes: all lie inside words
    return (len(words), word_bytes - inner, gone(SYMBOLS), len(lines), len(lines) - len(set(lines)),
            repeated_words(words), raw.count(b"!"), gone(UPPER.encode()), gone(LOWER.encode()), sum(map(eq, words, words[1:])))


@arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measures(text: pa.Array) -> pa.Array:
    rows = [measure(raw) for raw in utf8(text)]
    columns = list(zip(*rows, strict=True)) or [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(MEASURES))


def failure_bits(measured: str) -> Column:
    """One bit per failed rule, from the struct column ``measured``."""
    def on(rule: str) -> str:
        return " ".join(f"{measured}.{word}" if word in MEASURES else word for word in rule.split())

    return F.expr(" + ".join(f"IF({on(rule)}, {BIT[name]}L, 0L)" for name, rule in RULES.items()))


def ledger(docs: DataFrame, text: str = "text", column: str = "quality") -> DataFrame:
    """``docs`` plus the struct ``column`` (every measurement and ``bits``).

    Null or empty texts have no words: all measurements are 0 and they fail
    ``too_short``. Very long texts are measured whole. Repeated rows are
    measured each; an empty table gives an empty ledger. A column of the same
    name is replaced, all others pass through.
    """
    bounded_batches(docs.sparkSession)
    measured = docs.withColumn(column, _measures(F.col(text).cast("string")))
    return measured.withColumn(column, F.col(column).withField("bits", failure_bits(f"`{column}`")))


def passes(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(docs: DataFrame, policy: Policy = DEFAULT, text: str = "text") -> DataFrame:
    """The documents that pass every rule of ``policy``, with their own columns."""
    name = "_quality_ledger"
    while name in docs.columns:
        name += "_"
    return ledger(docs, text, name).where(passes(F.col(f"{name}.bits"), policy)).drop(name)


def ablation(bits: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Per rule of ``policy``: documents it fails, and those that only it fails.

    ``bits`` has the long column ``bits``. One map-side combined aggregation
    over at most ``2 ** len(RULES)`` masks, then bit tests on those masks.
    """
    masks = bits.groupBy(F.col("bits").bitwiseAND(F.lit(policy.mask)).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules])
    return (
        masks.select("mask", "n", F.inline(rules))
        .groupBy("rule")
        .agg(
            F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_regained"),
        )
    )


def stored_ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger without the texts, written once: key, measurements and bits.

    Any number of policies and ablations are answered from it; it stays in the
    shared folder. Rows and values are those of ``ledger``.
    """
    rows = docs.select(own(key).alias("key"), own(text).alias("text"))
    return stored(ledger(rows).select("key", "quality.*"), "quality-ledger")


def compare_policies(bits: DataFrame, policies: tuple[Policy, ...] = (DEFAULT, WITHOUT_TONE)) -> DataFrame:
    """Per policy version and rule: documents kept by the policy, failed by the rule, and regained without it.

    ``bits`` has the long column ``bits``. One pass for all policies: documents
    are counted per mask before the shuffle (at most ``2 ** len(RULES)``
    masks). Repeated rows count; an empty ledger gives no rows.
    """
    masks = bits.groupBy("bits").agg(F.count("*").alias("n"))
    rules = F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("policy_version"), F.lit(r).alias("rule"),
                 F.lit(BIT[r]).cast("long").alias("bit"), F.lit(p.mask).cast("long").alias("mask"))
        for p in policies for r in p.rules])
    of = lambda condition: F.sum(F.when(F.expr(condition), F.col("n")).otherwise(F.lit(0)))
    return masks.select("bits", "n", F.inline(rules)).groupBy("policy", "policy_version", "rule").agg(
        of("(bits & mask) = 0").alias("n_kept"), of("(bits & bit) != 0").alias("n_failed"), of("(bits & mask) = bit").alias("n_regained"))


def policy_digest(docs: DataFrame) -> DataFrame:
    return compare_policies(stored_ledger(docs).select("bits"))


def quality_digest(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Measurements, failure bits and verdicts per document."""
    q = ledger(docs.select("doc_id", "text"))
    return q.select(
        "doc_id",
        *[F.col(f"quality.{m}").alias(m) for m in MEASURES],
        F.col("quality.bits").alias("failure_bits"),
        F.lit(policy.version).alias("policy_version"),
        (~passes(F.col("quality.bits"), BASE)).alias("base_failed"),
        (passes(F.col("quality.bits"), BASE) & passes(F.col("quality.bits"), policy)).alias("kept"),
    )


_WORDS = r"[x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"
_LEDGER_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
),
win AS (
  SELECT row_id, i, list_slice(w, i, i + {WINDOW - 1}) AS g
  FROM d, LATERAL (SELECT unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i)
),
dup AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, g) AS c FROM win) WHERE c > 1),
rep AS (
  SELECT row_id, count(DISTINCT p) AS n FROM (
    SELECT row_id, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM dup) GROUP BY row_id
),
m0 AS (
  SELECT d.row_id, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_bangs,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    length(regexp_replace(t, '[^a-z]', '', 'g'))::BIGINT AS n_lower,
    len([i FOR i IN generate_series(2, len(w)) IF w[i] = w[i - 1]])::BIGINT AS n_stutters
  FROM d LEFT JOIN rep USING (row_id)
),
m AS (SELECT *, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines FROM m0),
b AS (SELECT *, {" + ".join(f"CASE WHEN {rule} THEN {BIT[name]} ELSE 0 END" for name, rule in RULES.items())} AS bits FROM m)
"""
QUALITY_SQL = _LEDGER_SQL + f"""SELECT doc_id, {", ".join(MEASURES)}, bits::BIGINT AS failure_bits, {DEFAULT.version} AS policy_version,
  (bits & {BASE.mask}) <> 0 AS base_failed, (bits & {BASE.mask}) = 0 AND (bits & {DEFAULT.mask}) = 0 AS kept
FROM b
"""
POLICY_SQL = _LEDGER_SQL + f"""SELECT policy, policy_version, rule, (count(*) FILTER (WHERE (bits & mask) = 0))::BIGINT AS n_kept,
  (count(*) FILTER (WHERE (bits & bit) <> 0))::BIGINT AS n_failed, (count(*) FILTER (WHERE (bits & mask) = bit))::BIGINT AS n_regained
FROM b, (VALUES {", ".join(f"('{p.name}', {p.version}, '{r}', {BIT[r]}, {p.mask})" for p in (DEFAULT, WITHOUT_TONE) for r in p.rules)}) AS r(policy, policy_version, rule, bit, mask)
GROUP BY policy, policy_version, rule
"""
