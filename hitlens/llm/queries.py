"""Registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hitlens.llm.conversations import REPAIR_SQL, repair_digest
from hitlens.llm.decontaminate import CONTAMINATION_SQL, contamination_digest
from hitlens.llm.line_dedup import LINE_SQL, line_digest
from hitlens.llm.lm_score import lm_digest
from hitlens.llm.merkle import MERKLE_SQL, manifest_digest
from hitlens.llm.packing import packing_digest
from hitlens.llm.quality import POLICY_SQL, QUALITY_SQL, policy_digest, quality_digest
from hitlens.llm.secrets import secrets_digest
from hitlens.llm.sharding import shard_digest
from hitlens.llm.simhash import simhash_digest
from hitlens.llm.suffixes import suffix_digest
from hitlens.llm.token_counts import count_digest
from hitlens.llm.url_filter import url_digest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over_documents(digest: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": _over_documents(simhash_digest),
    "op2_quality_ledger": _over_documents(quality_digest),
    "op3_virtual_slot_shards": _over_documents(shard_digest),
    "op4_winnowing_decontamination": lambda spark, sf_dir: contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op5_url_filter": lambda spark, sf_dir: url_digest(table(spark, sf_dir, "pages")),
    "op6_secret_scan": _over_documents(secrets_digest),
    "op7_suffix_dedup": _over_documents(suffix_digest),
    "op8_line_dedup": _over_documents(line_digest),
    "op9_best_two_fit_packing": _over_documents(packing_digest),
    "op10_ppm_score": _over_documents(lm_digest),
    "op11_merkle_manifest": _over_documents(manifest_digest),
    "op12_conversation_repair": lambda spark, sf_dir: repair_digest(table(spark, sf_dir, "conversations")),
    "op13_token_counts": _over_documents(count_digest),
    "quality_policies": _over_documents(policy_digest),
}
ORACLES: dict[str, str] = {"op2_quality_ledger": QUALITY_SQL, "op4_winnowing_decontamination": CONTAMINATION_SQL, "op8_line_dedup": LINE_SQL,
                           "op11_merkle_manifest": MERKLE_SQL, "op12_conversation_repair": REPAIR_SQL, "quality_policies": POLICY_SQL}
