"""Weighted rendezvous sharding (native: DataFrame functions only).

Each record key is hashed once with every shard; the shard with the highest
score ``weight / -ln(u)`` takes the record. Adding a shard only moves the
records whose new score is highest, and moves them into the new shard.

Cases: a null key is a key like any other (all such rows share a shard); a null
text has no bytes and the CRC of the empty string; repeated rows each get their
own slot; an empty table gives an empty result; columns that the operator adds
replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.plans.shared import shared_table

SEED = 20_011
#: Hexadecimal digits of a digest that make up a uniform number: 52 bits, which a double holds.
DIGITS = 13


def scores(key: Column, weights: list[float], seed: int = SEED) -> list[Column]:
    """One positive score per shard, from a 52-bit uniform: the MD5 of seed, key and shard number, colon-joined."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    out = []
    text = F.coalesce(key.cast("string"), F.lit(""))
    for i, weight in enumerate(weights):
        digest = F.md5(F.concat(F.lit(f"{seed}:"), text, F.lit(f":{i}")))
        uniform = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 4 * DIGITS))
        out.append(F.lit(float(weight)) / -F.log(uniform))
    return out


def _winner(some: Column) -> Column:
    """The last place, from 0, of an array's largest value."""
    pairs = F.transform(some, lambda s, i: F.struct(s.alias("score"), i.alias("shard")))
    return F.array_max(pairs)["shard"]


def rendezvous(key: Column, weights: list[float], seed: int = SEED) -> Column:
    """The number of the shard with the highest score; ties go to the higher number."""
    return _winner(F.array(*scores(key, weights, seed)))


def with_slots(df: DataFrame, shard: str, order: list[str], out: str = "slot") -> DataFrame:
    """Number the rows of each shard, a whole number, from 0 without gaps in the order of the columns ``order``.

    ``df`` should read a stored table: its rows are dealt into ranges of shard and
    order, and repeats of a row by their place in the table, so that no range grows
    hot. Only the sizes of ranges, a row each and shard, are added up in windows.
    """
    by = [shard, *order, "_tie"]
    rows = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = shared_table(rows.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), "in_order")
    rows = rows.withColumn("_part", F.shiftright("_place", 33))
    sizes = rows.groupBy(shard, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = W.partitionBy(shard).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(shard, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return rows.join(shared_table(starts, "slot_starts"), [shard, "_part"]).withColumn(out, F.col("_place") + F.col("_start")).drop("_start", "_part", "_place")


def assign(df: DataFrame, key: str, weights: list[float], seed: int = SEED, grown_weight: float | None = None) -> DataFrame:
    """``df`` with ``shard``, and with ``grown_shard`` if one more shard of ``grown_weight`` is asked for."""
    if grown_weight is None:
        return df.withColumn("shard", rendezvous(F.col(key), weights, seed))
    every = F.array(*scores(F.col(key), [*weights, grown_weight], seed))
    placed = df.withColumn("_scores", every)
    return placed.withColumns({"shard": _winner(F.slice("_scores", 1, len(weights))), "grown_shard": _winner(F.col("_scores"))}).drop("_scores")


def write_shards(df: DataFrame, path: str, key: str, weights: list[float], seed: int = SEED) -> None:
    """Write whole rows under ``path/shard=<n>``; one shard may span many tasks and files."""
    assign(df, key, weights, seed).write.partitionBy("shard").mode("overwrite").parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 equal shards by doc_id, with the shard after growth to 25."""
    text = F.coalesce("text", F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = shared_table(assign(docs, "doc_id", [1.0] * 24, grown_weight=1.0), "placed")
    slots = with_slots(placed, "shard", ["doc_id", "text_crc32", "size"])
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


#: Equal weights, so the largest 52-bit number wins; a CRC is folded over the bytes with the table of its polynomial.
OP7_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab
), d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    xor(coalesce(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)),
      lambda s, x: xor(s >> 8, tab[(xor(s, x) & 255) + 1]), 4294967295), 4294967295), 4294967295) AS text_crc32,
    list_transform(range(25), lambda i: CAST('0x' || substr(md5('20011:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || i), 1, 13) AS BIGINT)) AS u
  FROM documents, crc
), placed AS (
  SELECT *, list_position(u[1:24], list_max(u[1:24])) - 1 AS shard, list_position(u, list_max(u)) - 1 AS grown_shard FROM d
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard FROM placed
"""
