"""URL filter: explicit rules first, else logistic regression on hashed
character n-grams of host and path.

The model is trained here from a small labelled table: URLs that an explicit
rule decides, with the rule's verdict as label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from hitlens.llm.common import ascii_lower, bounded_batches

#: Verdict of each rule; a rule is host + path.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
#: Training rows: the documented bound on the labelled sample (those with the smallest hash).
SAMPLE_ROWS = 4000
BUCKETS = 1 << 15
GRAMS = (2, 3, 4)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host from the first ``://`` up to ``/``, ``?``, ``#`` or the
    end with A-Z lower-cased, then the path up to ``?``, ``#`` or the end. Both
    are empty for a null URL or one without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits: its host or a subdomain, and a path that starts with its path. Else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def features(host: str, path: str) -> np.ndarray:
    """Sorted distinct buckets of the n-grams of host and path (each marked with its part)."""
    found = set()
    for mark, part in ((b"h", host), (b"p", path)):
        raw = b"^" + part.encode() + b"$"
        for n in GRAMS:
            found.update(crc32(mark + raw[i : i + n]) % BUCKETS for i in range(len(raw) - n + 1))
    return np.fromiter(sorted(found), np.int64, len(found))


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        scale = 1 / np.sqrt(np.maximum(sizes, 1))
        return np.bincount(owner, self.weights[flat], len(rows)) * scale + self.bias


def fit(urls: list[tuple[str, str]], blocked: list[bool], rounds: int = 300, rate: float = 4.0, decay: float = 1e-4) -> UrlModel:
    """Class-balanced logistic regression by full-batch gradient descent (deterministic).

    With fewer than two classes there is nothing to learn: the model then
    allows all, or blocks all if only blocked rows were given.
    """
    y = np.array(blocked, float)
    if len(set(blocked)) < 2:
        return UrlModel(np.zeros(BUCKETS), 1.0 if blocked and blocked[0] else -1.0)
    rows = [features(*u) for u in urls]
    sizes = np.array([len(r) for r in rows])
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    model = UrlModel(np.zeros(BUCKETS), 0.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-model.logits(rows)))
        g = (p - y) * share
        step = np.bincount(flat, (g * scale)[owner], BUCKETS)
        model = UrlModel(model.weights - rate * (step + decay * model.weights), model.bias - rate * g.sum())
    return model


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """Fit on ``labelled`` (host, path, blocked): the ``sample_rows`` rows of smallest hash."""
    h = F.xxhash64("host", "path")
    rows = labelled.distinct().orderBy(h, "host", "path", "blocked").limit(sample_rows).collect()
    return fit([(r.host, r.path) for r in rows], [r.blocked for r in rows])


def judge_urls(pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``pages`` plus host, path, rule, verdict and block_score (the model's probability of a block).

    Null or malformed URLs have an empty host and path and are judged by the
    model like any other. Columns of the same names are replaced. Without any
    labelled URL every undecided page is allowed. Empty tables stay empty.
    """
    bounded_batches(pages.sparkSession)
    host, path = url_parts(F.col(url))
    ruled = pages.withColumns({"host": host, "path": path})
    ruled = ruled.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    of_rule = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])[F.col("rule")]
    labelled = ruled.where("rule is not null").select("host", "path", (of_rule == "block").alias("blocked"))
    model = train(labelled, sample_rows)

    @arrow_udf(T.DoubleType())
    def score(hosts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for h, p in hosts:
            rows = [features(a, b) for a, b in zip(h.to_pylist(), p.to_pylist(), strict=True)]
            yield pa.array(1 / (1 + np.exp(-model.logits(rows))) if rows else [], pa.float64())

    scored = ruled.withColumn("block_score", score("host", "path"))
    learned = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce(of_rule, learned))


def url_digest(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "block_score")
