"""Tables in the folder that the driver and all executors share.

Iterative and multi-pass plans cut their lineage by writing a Parquet table and
reading it back: a lost executor then costs a re-read instead of a recomputation,
and the optimizer knows the true size of what it reads, so it broadcasts such a
table only when it is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Used only by local sessions that name no folder, as in tests.
LOCAL_FALLBACK = "file:///tmp/checkpoints/shelfmark"
#: Lets Spark delete the shuffle files of a query that has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session may leave it unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or LOCAL_FALLBACK).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def shared_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a reader of what was written.

    As nothing reads the query's shuffles after that, their files go when it ends.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._shelfmark_path = path
    return out


def only_results(make: Callable[[], tuple[DataFrame, ...]], *names: str) -> list[DataFrame]:
    """:func:`shared_table` of each frame that ``make`` gives; all other tables that they took are deleted then."""
    before = {path for _, path in _made}
    out = [shared_table(df, name) for df, name in zip(make(), names, strict=True)]
    kept = before | {t._shelfmark_path for t in out}
    for spark, path in [m for m in _made if m[1] not in kept]:
        delete_path(spark, path)
        _made.remove((spark, path))
    return out


def only_result(make: Callable[[], DataFrame], name: str = "table") -> DataFrame:
    """:func:`only_results` of one frame."""
    return only_results(lambda: (make(),), name)[0]


def table_path(table: DataFrame) -> str:
    """Where the table is that :func:`shared_table` wrote."""
    return table._shelfmark_path


def drop_shared(*tables: DataFrame | None) -> None:
    """Delete tables that :func:`shared_table` made (or results that read one alone) and nothing reads any more."""
    for t in tables:
        path = getattr(t, "_shelfmark_path", None)
        if path:
            delete_path(t.sparkSession, path)
            _made[:] = [m for m in _made if m[1] != path]


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                delete_path(spark, path)
        except Exception:  # the session may be gone already
            pass
