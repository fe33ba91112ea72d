"""Product feeds: multi-file CSV scan, schema backfill, sampling, cleaning."""

from __future__ import annotations

import csv
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfmark.functions import specs as S
from shelfmark.functions import text as T
from shelfmark.plans.numbering import number_rows

#: The columns that a feed may have, all read as text.
FEED = (
    "product_id seller_id category sub_category name brief_description details shipping_time review_rating reviews vendor_sku_id upc "
    "data_refreshed_at created_at updated_at is_active out_of_stock brand model category_paths primary_category_path"
).split()
REQUIRED = ("product_id", "category", "sub_category", "name", "brief_description", "details", "brand", "model")
CLEANED = ("name", "brief_description", "brand", "category", "sub_category")


def resolve(source) -> list[str]:
    """Paths of a path, a glob or a list of them: sorted within a glob, each once, in order."""
    items = [source] if isinstance(source, (str, Path)) else list(source)
    found: list[str] = []
    for item in map(str, items):
        if "://" in item:
            found.append(item)
        elif any(c in item for c in "*?["):
            p = Path(item)
            found += [str(x.resolve()) for x in sorted(p.parent.glob(p.name))]
        elif Path(item).exists():
            found.append(str(Path(item).resolve()))
    if not found:
        raise FileNotFoundError(f"no input matches {source}")
    return list(dict.fromkeys(found))


def header_of(spark: SparkSession, path: str) -> str:
    """The first line of a file that Spark's file systems can open; of a folder, that of its first part file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        parts = sorted(str(s.getPath()) for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", ".")) and s.getLen() > 0)
        if not parts:
            return ""
        p = jvm.org.apache.hadoop.fs.Path(parts[0])
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def scan_csv(spark: SparkSession, source, columns: list[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """Quoted CSV with a header, as text, united by column name; ``_file`` is the place of a row's source in the given order, ``_path`` its file.

    Only first lines are read to plan the scan: files with one header are one scan, however many they are.
    """
    paths = resolve(source)
    by_header: dict[str, list[str]] = {}
    for p in paths:
        by_header.setdefault(header_of(spark, p), []).append(p)
    names = spark.createDataFrame([(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath(), i) for i, p in enumerate(paths)], "_path string, _file int")
    frames = []
    for header, files in by_header.items():
        fields = next(csv.reader([header]), [])
        schema = StructType([StructField(c, StringType()) for c in fields])
        reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
        frames.append(reader.csv(files).withColumn("_path", F.expr("url_decode(replace(parse_url(_metadata.file_path, 'PATH'), '+', '%2B'))")))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    # A given path is a file or the folder of its part files.
    found = df.withColumn("_folder", F.regexp_replace("_path", "/[^/]*$", ""))
    own = names.select(F.col("_path").alias("_own"), F.col("_file").alias("_own_file"))
    folder = names.select(F.col("_path").alias("_in"), F.col("_file").alias("_in_file"))
    found = found.join(own, F.col("_path") == F.col("_own"), "left").join(folder, F.col("_folder") == F.col("_in"), "left")
    df = found.withColumn("_file", F.coalesce("_own_file", "_in_file")).drop("_folder", "_own", "_own_file", "_in", "_in_file")
    if columns:
        df = df.select(*columns, "_file", "_path")
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in (types or {}).items()})


def backfill(df: DataFrame, columns: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Add the columns that are missing, as empty text."""
    missing = {c: F.lit("") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly n rows (all, if fewer), the same on every run: those whose seeded hashes come first."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def enrich(df: DataFrame, clean: bool = True) -> DataFrame:
    """Cleaned text columns, parsed details, specifications, model code and the text for models."""
    names = [c for c in CLEANED if c in df.columns]
    if clean:
        df = df.withColumns({c: T.prettify(F.col(c)) for c in names})
    df = df.withColumn("details_map", S.json_safe(F.col("details")))
    df = df.withColumns({
        "specs": S.spec_map(F.col("details_map")),
        "spec_entries": S.spec_entries(F.col("details_map")),
        "model_code": T.model_code(F.col("model")),
    })
    return df.withColumn("ml_text", ml_text(clean))


def ml_text(clean: bool = True):
    fix = T.prettify if clean else T.or_empty
    d = lambda k: S.spec_value(F.col("details_map"), k)
    some = lambda c: F.nullif(c, F.lit(""))
    parts = [F.coalesce(F.col("name"), F.lit("")), fix(F.coalesce(some(d("brand")), F.col("brand"))), fix(d("color")), fix(F.col("model_code"))]
    keys = [*T.ML_TEXT_SPECS, *(k.lower() for k in T.ML_TEXT_SPECS)]
    return T.join_texts(*parts, *[fix(S.spec_value(F.col("specs"), k)) for k in keys])


def load_products(spark: SparkSession, source, sample: int | None = None, seed: int = 42, columns: list[str] | None = None,
                  types: dict[str, str] | None = None, clean: bool = True) -> DataFrame:
    """Scan, backfill, sample, number and enrich a feed."""
    df = backfill(scan_csv(spark, source, columns, types))
    if sample:
        df = sample_n(df, sample, seed, "product_id")
    if "row_id" not in df.columns:
        df = number_rows(df) if sample else number_rows(df, within=["_file", "_path"])
    return enrich(df.drop("_file", "_path"), clean)


def parse_stats(df: DataFrame) -> DataFrame:
    """Rows, rows with details, and rows whose details are no JSON object."""
    filled = F.trim(F.coalesce("details", F.lit(""))) != ""
    bad = filled & (F.size(S.json_safe(F.col("details"))) == 0)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(filled).alias("n_details"), F.count_if(bad).alias("n_errors"))
