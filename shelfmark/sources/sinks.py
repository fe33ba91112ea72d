"""Writers of the pipeline's results; paths are those of any file system that Spark can write to."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def export_json(spark: SparkSession, path: str, payload: dict) -> None:
    """A small document, indented, UTF-8 as it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(json.dumps(payload, indent=2, ensure_ascii=False).encode()))
    finally:
        out.close()


def export_json_lines(df: DataFrame, path: str) -> None:
    """One JSON document a row; null members are left out."""
    df.write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, a part file a task, white space as it is; ``single`` is for results of bounded size, such as a top-n."""
    as_is = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    (df.coalesce(1) if single else df).write.mode("overwrite").options(**as_is).csv(path)
