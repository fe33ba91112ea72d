"""Data-quality flags and scores of products, brands and sellers; dataset profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import parse as P
from shelfmark.functions import specs as S
from shelfmark.functions import text as T
from shelfmark.plans.shared import shared_table

PENALTIES = {
    "missing_brand": 15, "missing_axes_config": 10, "missing_screen": 5, "weird_title_chars": 5,
    "implausible_ram": 20, "implausible_storage": 20, "screen_out_of_range": 10,
}
KNOWN_BRANDS = "apple dell hp lenovo asus acer microsoft samsung lg sony toshiba msi razer google hisense tcl vizio".split()


def dq_flags(df: DataFrame) -> DataFrame:
    """``df`` (with axes) with the seven 0/1 flags."""
    ram, storage, screen = F.col("axes.config.ram_gb"), F.col("axes.config.storage_gb"), F.col("axes.size.screen_inches")
    flags = {
        "missing_brand": T.or_empty(F.col("brand")) == "",
        "missing_axes_config": ram.isNull() & storage.isNull(),
        "missing_screen": screen.isNull(),
        "weird_title_chars": P.weird_chars(F.col("name")),
        "implausible_ram": P.implausible(ram, 2, 128),
        "implausible_storage": P.implausible(storage, 16, 8192),
        "screen_out_of_range": ~P.screen_valid(F.col("sub_category"), screen, F.col("name")),
    }
    return df.withColumns({k: v.cast("int") for k, v in flags.items()})


def dq_rows(df: DataFrame, confidences: DataFrame) -> DataFrame:
    """Flags, confidence (0 where unknown) and dq_score from 0 to 100."""
    # Of repeated product ids the greatest confidence counts.
    conf = confidences.groupBy("product_id").agg(F.max("confidence").alias("confidence"))
    rows = dq_flags(df).join(conf, "product_id", "left").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    lost = sum(F.col(k) * v for k, v in PENALTIES.items()) + F.when(F.col("confidence") < 0.5, 10).when(F.col("confidence") < 0.7, 5).otherwise(0)
    return rows.withColumn("dq_score", F.least(F.greatest(100.0 - lost, F.lit(0.0)), F.lit(100.0)))


def by_cohort(rows: DataFrame, key: str) -> DataFrame:
    """Mean score, confidence and flags per cohort; the null cohort is one."""
    return rows.groupBy(key).agg(*[F.avg(c).alias(c) for c in ("dq_score", "confidence", *PENALTIES)])


def anomalies(rows: DataFrame) -> DataFrame:
    severe = (F.col("implausible_ram") == 1) | (F.col("implausible_storage") == 1) | (F.col("screen_out_of_range") == 1) | (F.col("dq_score") < 60)
    return rows.filter(severe).select(
        "product_id", "brand", "seller_id", "sub_category", "name", "dq_score", "confidence", "implausible_ram", "implausible_storage",
        "screen_out_of_range", "missing_brand", "missing_axes_config", "missing_screen",
    )


def quality_report(df: DataFrame, confidences: DataFrame) -> dict[str, DataFrame]:
    """Scored rows, brands and sellers from the lowest score up, and anomalies."""
    rows = shared_table(dq_rows(df, confidences), "scored_quality")  # read by all four results
    worst = lambda key: by_cohort(rows, key).orderBy("dq_score", F.col(key).asc_nulls_last())
    return {"rows_scored": rows, "brand_quality": worst("brand"), "seller_quality": worst("seller_id"), "anomalies": anomalies(rows)}


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def guess_brand(df: DataFrame) -> DataFrame:
    """``df`` with the first known brand that the name contains."""
    name = F.lower(T.or_empty(F.col("name")))
    hits = F.filter(F.array(*[F.lit(b) for b in KNOWN_BRANDS]), lambda b: F.contains(name, b))
    return df.withColumn("guessed_brand", F.try_element_at(hits, F.lit(1)))


def key_counts(df: DataFrame, top: int = 100) -> DataFrame:
    """The most common specification names."""
    keys = df.select(F.explode(F.map_keys(S.spec_map(S.json_safe(F.col("details"))))).alias("spec_key"))
    return keys.groupBy("spec_key").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "spec_key").limit(top)


def _mentions(df: DataFrame, pattern: str, with_unit: bool) -> DataFrame:
    every = lambda i: F.regexp_extract_all("name", F.lit(pattern), F.lit(i))
    columns = [every(1).alias("v"), every(2).alias("u")] if with_unit else [every(1).alias("v")]
    zipped = df.filter("name is not null").select("product_id", "name", F.arrays_zip(*columns).alias("z"))
    return zipped.select("product_id", "name", F.explode("z").alias("m")).select("product_id", "name", "m.*")


def storage_anomalies(df: DataFrame) -> DataFrame:
    m = _mentions(df, r"(?i)(\d+\.?\d*)\s*(TB|GB|MB)", True)
    v, u = F.col("v").try_cast("double"), F.upper("u")
    bad = ((u == "TB") & (v > 10)) | ((u == "GB") & (v > 8192))
    text = F.concat(F.lit("Suspicious storage: '"), "v", F.lit(" "), "u", F.lit("' in title: '"), F.substring("name", 1, 100), F.lit("...'"))
    return m.filter(bad).select("product_id", text.alias("message"))


def screen_anomalies(df: DataFrame, low: float = 10, high: float = 100) -> DataFrame:
    m = _mentions(df, r'(?i)(\d+\.?\d*)\s*(?:inch|")', False)
    text = F.concat(F.lit("Unusual screen size: '"), "v", F.lit("\"' in title: '"), F.substring("name", 1, 100), F.lit("...'"))
    return m.filter(~F.col("v").try_cast("double").between(low, high)).select("product_id", text.alias("message"))


def top_brands(df: DataFrame, n: int = 20) -> DataFrame:
    b = df.select(F.trim(F.lower("brand")).alias("brand")).filter("brand is not null")
    return b.groupBy("brand").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "brand").limit(n)


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """The dataset profile as named tables."""
    return {
        "categories": value_counts(df, "category"), "sub_categories": value_counts(df, "sub_category"),
        "brands": df.select(F.trim(F.lower("brand")).alias("brand")).distinct(), "top_brands": top_brands(df),
        "guessed_brands": value_counts(guess_brand(df).filter("brand is null"), "guessed_brand"), "spec_keys": key_counts(df),
        "storage_anomalies": storage_anomalies(df), "screen_anomalies": screen_anomalies(df),
    }
