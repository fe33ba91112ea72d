"""Group reports: modes, base specifications, counts and the run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import parse as P


def modes(df: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """(key, every name in ``values``): the most frequent text of each value per key; ties go to the smaller text.

    All values are counted in one pass as (key, field, text) rows, which are added up
    before they are shuffled; nulls, empty texts and ``none`` never win.
    """
    fields = F.array(*[F.struct(F.lit(n).alias("field"), v.cast("string").alias("text")) for n, v in values.items()])
    counts = df.select(key, F.inline(fields)).groupBy(key, "field", "text").agg(F.count("*").alias("n"))

    def best(name: str) -> Column:
        usable = (F.col("field") == name) & ~F.col("text").isin("", "none")
        return F.min_by("text", F.when(usable, F.struct(-F.col("n"), F.col("text")))).alias(name)

    return counts.groupBy(key).agg(*[best(n) for n in values])


def safe_mode(df: DataFrame, key: str, value: str, out: str = "mode") -> DataFrame:
    """(key, out): the most frequent non-empty value per key, in the value's type; keys without one are left out."""
    kind = df.schema[value].dataType
    return modes(df, key, {out: F.col(value)}).filter(F.col(out).isNotNull()).withColumn(out, F.col(out).cast(kind))


def base_specs(df: DataFrame, group: str = "group_id") -> DataFrame:
    """(group, form_factor, display_type, screen_size_inches, processor_family) of every group in one plan."""
    out = modes(df, group, {
        "_sub": F.col("sub_category"), "_display": P.panel_type(F.col("name")),
        "screen_size_inches": F.bround("axes.size.screen_inches", 1), "processor_family": P.cpu_readable(F.col("axes.silicon.cpu")),
    })
    sub = F.lower("_sub")
    return out.select(
        group, F.when(sub == "laptop", "laptop").alias("form_factor"), F.when(sub == "tv", F.col("_display")).alias("display_type"),
        F.col("screen_size_inches").cast("double").alias("screen_size_inches"), "processor_family",
    )


def product_groups(df: DataFrame, groups: DataFrame) -> DataFrame:
    """One row a group: its names, base specifications and counts."""
    counts = df.groupBy("group_id").agg(F.countDistinct("product_id").alias("product_count"), F.countDistinct("variant_id").alias("variant_count"))
    return groups.select("group_id", "brand", "family", "generation").join(base_specs(df), "group_id").join(counts, "group_id")


def run_summary(scored: DataFrame, n_variants: int | None = None, threshold: float = 0.82) -> DataFrame:
    """Totals of a run; rows without a distinct product id count as unassigned."""
    return scored.agg(
        F.count("*").alias("total_products"), F.countDistinct("group_id").alias("total_groups"), F.countDistinct("variant_id").alias("total_variants"),
        F.countDistinct("product_id").alias("products_assigned"), (F.count("*") - F.countDistinct("product_id")).alias("products_unassigned"),
        F.round(F.avg("confidence"), 4).alias("average_confidence"), F.lit(threshold).alias("group_threshold"),
    )
