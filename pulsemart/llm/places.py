"""The place of each row in its group, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm.scratch import Scratch


def placed(rows: DataFrame, scratch: Scratch, name: str, *order: str) -> DataFrame:
    """``rows`` with their place ``pos`` in their ``grp``, from 0, and its size ``n``.

    Rows are range-partitioned by (grp, order); a partition's rows are numbered as
    they lie and its rows of a group start where the partitions before it end.
    Only counts per (group, partition) meet in one window: at most as many a
    group as there are partitions.
    """
    tie = F.monotonically_increasing_id()               # so that equal rows spread over partitions too
    rows = scratch.store(rows.withColumn("tie", tie), f"{name}_rows")
    by = ["grp", *order, "tie"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).select(
        *[c for c in rows.columns if c != "tie"], F.monotonically_increasing_id().alias("at"))
    ranged = scratch.store(ranged.withColumn("part", F.shiftright("at", 33)), f"{name}_ranged")
    scratch.drop(f"{name}_rows")
    before = Window.partitionBy("grp").orderBy("part")
    parts = ranged.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("k"), F.min("at").alias("first"))
    parts = parts.select(
        "grp", "part", "first", (F.sum("k").over(before) - F.col("k")).alias("offset"),
        F.sum("k").over(Window.partitionBy("grp")).alias("n"),
    )
    return ranged.join(parts, ["grp", "part"]).select(
        *[c for c in ranged.columns if c not in ("at", "part")],
        (F.col("offset") + F.col("at") - F.col("first")).alias("pos"), "n",
    )
