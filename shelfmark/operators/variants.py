"""Deterministic variant identifiers and variant records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.parse import format_gb, format_inches


def _text(c: Column) -> Column:
    """Nothing for null, empty or ``none``."""
    s = c.cast("string")
    return F.when(~s.isin("", "none"), s)


def _segment(name: str, *parts: Column) -> Column:
    joined = F.concat_ws("_", *parts)
    return F.when(joined != "", F.concat(F.lit(f"{name}:"), joined))


def variant_id(group: Column, axes: str = "axes") -> Column:
    """``group/config:../size:../silicon:../packaging:..`` with the segments that have a value."""
    a = lambda path: F.col(f"{axes}.{path}")
    segments = [
        _segment("config", format_gb(a("config.ram_gb")), format_gb(a("config.storage_gb")), _text(a("config.color"))),
        _segment("size", format_inches(a("size.screen_inches"))),
        _segment("silicon", _text(a("silicon.cpu")), _text(a("silicon.gpu"))),
        _segment("packaging", _text(a("packaging.condition")), F.when(a("packaging.bundle"), F.lit("bundle"))),
    ]
    joined = F.concat_ws("/", *segments)
    return F.concat_ws("/", group, F.coalesce(F.nullif(joined, F.lit("")), F.lit("config:unk")))


def pruned(axes: Column) -> Column:
    """Axes without empty members; a false bundle flag is none."""
    p = axes["packaging"]
    packaging = F.when(p["bundle"] | p["condition"].isNotNull(), F.struct(F.when(p["bundle"], F.lit(True)).alias("bundle"), p["condition"].alias("condition")))
    return axes.withField("packaging", packaging)


def build_variants(df: DataFrame, group: str = "group_id") -> tuple[DataFrame, DataFrame]:
    """``df`` with variant_id, and (variant_id, group_id, axes, product_count) with the first row's axes."""
    df = df.withColumn("variant_id", variant_id(F.col(group)))
    records = df.groupBy("variant_id", group).agg(F.min_by("axes", "row_id").alias("axes"), F.count("*").alias("product_count"))
    return df, records.withColumn("axes", pruned(F.col("axes")))


def assignments(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in ("product_id", "group_id", "variant_id")])
