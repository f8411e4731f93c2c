"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.session import stored_table_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The six ASCII blanks that separate words (space, tab to carriage return).
BLANKS = " \t\n\x0b\x0c\r"
#: Rows and bytes of one Arrow batch handed to a Python worker: narrow rows
#: fill the first bound, long texts the second, which is the one on memory.
BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each value; null reads as the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.

    ``lower`` agrees with it on every text without an upper-case letter beyond
    ASCII, and is much cheaper than ``translate``.
    """
    plain = (F.octet_length(text) == F.char_length(text)) | ~text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def boxed(docs: DataFrame) -> Column:
    """All columns of ``docs`` in one struct, named ``row``: out of the way of an operator's own names.

    ``select("row.*")`` brings them back.
    """
    return F.struct(*[own(c) for c in docs.columns]).alias("row")


def own(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation) and gives the
    planner real sizes.
    """
    spark = df.sparkSession
    path = stored_table_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
