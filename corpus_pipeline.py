"""From raw documents to packed training sequences.

Every stage works on all that the stage before it kept, and is written to the
shared folder before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm.common import boxed
from hitlens.llm.decontaminate import contamination
from hitlens.llm.line_dedup import drop_repeated_lines
from hitlens.llm.packing import pack_documents
from hitlens.llm.quality import apply_policy
from hitlens.llm.simhash import drop_near_duplicates
from hitlens.session import Intermediates, is_written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy."""
    return apply_policy(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; n_chars follows a changed text."""
    left = drop_repeated_lines(docs.select("doc_id", "text", boxed(docs)))
    size = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("row")["n_chars"]) if "n_chars" in docs.columns else None
    new = {"text": F.col("text"), "n_chars": size}
    return left.select(*[(new[f.name].cast(f.dataType) if f.name in new else F.col("row")[f.name]).alias(f.name) for f in docs.schema.fields])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than the allowed share of benchmark passages."""
    judged = contamination(docs.select("doc_id", "text", boxed(docs)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.where("NOT contaminated").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their token ids (little-endian unsigned 32-bit), packed into sequences."""
    return pack_documents(docs, keep_ids=True).withColumnRenamed("key", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has neither the fingerprints' hash nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    With ``root``, a shared folder, every stage's table stays there under its
    name, and one that was written to the end is not made again: a run that was
    cut short goes on after its last stage. Otherwise the stages' tables are
    deleted once the last stage has read them.
    """
    tables = Intermediates(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        if root is None:
            docs = tables.stored(stage(spark, docs, sf_dir), name.replace("_", "-"))
            continue
        path = f"{root.rstrip('/')}/{name}"
        if not is_written(spark, path):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    packed = STAGES[-1][1](spark, docs, sf_dir)
    tables.drop()
    return packed
