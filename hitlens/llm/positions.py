"""Dense positions of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlens.llm.common import stored


def with_positions(rows: DataFrame, group: str, order: Sequence[Column | str], name: str) -> DataFrame:
    """``rows`` plus ``pos`` (from 0, by ``order``) and ``n`` (rows) within ``group``.

    A range exchange by (group, order) deals a hot group over many tasks; only
    the counts per (group, partition) meet in a window, at most one row per
    partition and group. The ranged rows are written first: positions stay the
    same if an executor is lost. Rows that tie in ``order`` are numbered in any
    order; nulls of ``group`` are a group. An empty table gives an empty one.
    ``rows`` are computed twice (the exchange samples its input), so pass a
    stored or cheap table. The names ``pos``, ``n``, ``_part`` and ``_row``
    must be free.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    table = stored(ranged.select("*", F.spark_partition_id().alias("_part"), row.alias("_row")), name)
    counts = table.groupBy(group, "_part").agg(F.count("*").alias("here"), F.min("_row").alias("first"))
    of_group = Window.partitionBy(group)
    before = F.sum("here").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        F.col(group).alias("_group"), F.col("_part").alias("_in"),
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift"), F.sum("here").over(of_group).alias("n"),
    )
    met = table.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_in")))
    return met.select(*rows.columns, (F.col("_row") + F.col("_shift")).alias("pos"), "n")
