"""Consecutive numbers for the rows of a table, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.plans.shared import shared_table


def number_rows(df: DataFrame, out: str = "row_id", order: list[str] | None = None, within: list[str] | None = None) -> DataFrame:
    """``df`` written with ``out``, numbers from 0: in its order, or in that of the columns ``order``.

    ``within`` names columns that say in which order runs of rows come, each of which
    is whole and in its order in one partition, as the rows of an unsplit file are.
    Rows are written with their place in their partition; only the sizes of
    partitions or runs, a row each, are added up in one task.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows = shared_table(rows.withColumn("_place", F.monotonically_increasing_id()), "placed_rows")
    run = F.struct(*within) if within else F.struct(F.shiftright("_place", 33).alias("part"))
    sizes = rows.groupBy(run.alias("_run")).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    ahead = W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_run", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first")).alias("_start"))
    numbered = rows.withColumn("_run", run).join(shared_table(starts, "row_starts"), "_run")
    return numbered.withColumn(out, F.col("_place") + F.col("_start")).drop("_run", "_place", "_start")
