"""Axes: the attributes of a product, from its specifications, its title, or a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import parse as P
from shelfmark.functions import specs as S
from shelfmark.functions import text as T

BUNDLE_WORDS = (" bundle", " kit", " combo", " with ", "+", " includes ")
AXES = (
    "struct<config:struct<ram_gb:int,storage_gb:int,color:string>,size:struct<screen_inches:double>,"
    "silicon:struct<cpu:string,gpu:string>,region:string,carrier:string,packaging:struct<bundle:boolean,condition:string>>"
)


def _spec(canon: str) -> Column:
    return F.coalesce(S.spec_first(F.col("spec_entries"), canon), F.lit(""))


def parsed(df: DataFrame) -> DataFrame:
    """``df`` with p_ram, p_storage, p_color, p_screen, p_cpu, p_gpu, p_condition and p_bundle.

    A zero from the specifications gives way to the title; a zero from the title stays.
    """
    name, sub = T.or_empty(F.col("name")), T.or_empty(F.col("sub_category"))
    either = lambda parse, canon: F.coalesce(F.nullif(parse(_spec(canon)), F.lit(0)), parse(name))
    # What several patterns search is a column of its own: within a plan's step it would be made anew for each.
    df = df.withColumns({
        "_title": F.lower(name),
        "_cpu": F.lower(F.concat_ws(" ", name, _spec("cpu_brand"), _spec("cpu_family"), _spec("cpu_model"))),
        "_gpu": F.lower(F.concat_ws(" ", name, _spec("gpu_model"))),
        "_condition": F.lower(F.concat_ws(" ", name, _spec("condition"))),
    })
    df = df.withColumns({
        "p_ram": either(P.parse_ram, "ram_gb"),
        "p_storage": either(P.parse_storage, "storage_gb"),
        "_screen": either(P.parse_screen, "screen_inches"),
        "p_color": F.coalesce(T.normalize_color(_spec("color")), T.normalize_color(name)),
        "p_cpu": P.cpu_token(F.col("_cpu")),
        "p_gpu": P.gpu_token(F.col("_gpu")),
        "p_condition": P.condition_token(F.col("_condition")),
        "p_bundle": P.any_of(F.col("_title"), BUNDLE_WORDS),
    })
    return df.withColumn("p_screen", F.when((F.col("_screen") == 0) | P.screen_valid(sub, F.col("_screen"), name), F.col("_screen"))).drop("_screen", "_title", "_cpu", "_gpu", "_condition")


def model_text() -> Column:
    keys = T.MODEL_TEXT_SPECS
    v = lambda k: F.coalesce(F.nullif(S.spec_value(F.col("specs"), k), F.lit("")), S.spec_value(F.col("specs"), k.lower()), F.lit(""))
    return T.join_texts(*[T.or_empty(F.col(c)) for c in ("ml_text", "name", "brand")], *[v(k) for k in keys])


def with_axes(df: DataFrame) -> DataFrame:
    """``df`` with the ``axes`` struct; run on :func:`parsed`, or on that with models' guesses filled in."""
    some = lambda *c: F.coalesce(*[F.col(x).isNotNull() for x in c[:1]]) if len(c) == 1 else F.greatest(*[F.col(x).isNotNull() for x in c])
    config = F.when(some("p_ram", "p_storage", "p_color"), F.struct(F.col("p_ram").alias("ram_gb"), F.col("p_storage").alias("storage_gb"), F.col("p_color").alias("color")))
    size = F.when(some("p_screen"), F.struct(F.col("p_screen").alias("screen_inches")))
    silicon = F.when(some("p_cpu", "p_gpu"), F.struct(F.col("p_cpu").alias("cpu"), F.col("p_gpu").alias("gpu")))
    packaging = F.struct(F.col("p_bundle").alias("bundle"), F.col("p_condition").alias("condition"))
    none = F.lit(None).cast("string")
    axes = F.struct(config.alias("config"), size.alias("size"), silicon.alias("silicon"), none.alias("region"), none.alias("carrier"), packaging.alias("packaging"))
    return df.withColumn("axes", axes.cast(AXES))


def infer_axes(df: DataFrame) -> DataFrame:
    return with_axes(parsed(df)).drop("p_ram", "p_storage", "p_color", "p_screen", "p_cpu", "p_gpu", "p_condition", "p_bundle")


def label_index(df: DataFrame, label: str) -> DataFrame:
    """(label, index): distinct labels by length, then text; ranked over distinct labels only.

    No label ranks last and goes after that: a filter before would be pushed down and parse every row twice.
    """
    from pyspark.sql import Window as W

    distinct = df.select(F.col(label).cast("string").alias("label")).distinct()
    ranked = distinct.withColumn("index", F.row_number().over(W.orderBy(F.length("label").asc_nulls_last(), "label")) - 1)
    return ranked.filter("label is not null")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): rows / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    return counts.crossJoin(F.broadcast(total)).select("label", "n", (F.col("rows") / (F.col("classes") * F.col("n"))).alias("weight"))
