"""Streaming forms: the row-local operators run unchanged, windows count late events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.axes import infer_axes
from shelfmark.sources.products import enrich


def axes_stream(feed: DataFrame) -> DataFrame:
    """Cleaning, parsing and axes of a streaming feed; stateless."""
    return infer_axes(enrich(feed))


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events and values per window and type; in append mode, state older than the watermark is dropped."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
    )


def drain(spark: SparkSession, df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there, then stop.

    In append mode ``path`` gets the windows that the watermark has passed; in complete
    mode it has, after each batch, all windows with every event so far, late ones too.
    """
    stream = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "complete":
        stream = stream.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
    else:
        stream = stream.format("parquet").option("path", path)
    query = stream.start()
    query.awaitTermination()
