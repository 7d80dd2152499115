"""Positions of rows in a global order, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estuary.llm.common import stored


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order`` inside ``group``) and ``n`` (rows of the group).

    Rows are dealt to tasks by ranges of (group, order), so a group of any
    size spreads; each task numbers its own sorted rows, and one row for each
    range and group carries the counts before it.  ``group`` holds no nulls;
    nulls of ``order`` come first.  Rows equal in all of these should differ
    in nothing that matters, or have a last key that tells them apart.
    """
    at = "_at"
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    kept = stored(dealt.withColumn(at, F.monotonically_increasing_id()), name)
    part = F.shiftright(at, 33)
    counts = kept.groupBy(part.alias("_part"), F.col(group).alias("_group")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(at).alias("_first"))
    all_of, before = Window.partitionBy("_group"), Window.partitionBy("_group").orderBy("_part")
    bases = counts.select("_part", "_group", (F.sum("_rows").over(before) - F.col("_rows") - F.col("_first")).alias("_base"),
                          F.sum("_rows").over(all_of).alias("n"))
    found = kept.join(bases, (part == F.col("_part")) & (F.col(group) == F.col("_group")))
    return found.withColumn("pos", F.col(at) + F.col("_base")).drop(at, "_part", "_group", "_base")
