"""Mixing sources to target weights by capped water-filling (native).

A source's target is its weight's share of all words, clamped at ``max_epochs``
times its own words; what clamped sources leave over is shared among the others
by weight. The common level solves ``sum(min(weight * level, cap)) = total`` and
is read off one pass over the sources in the order in which they reach their
caps. A document is then repeated ``floor(target / source size)`` times, plus
once more if its seeded hash is at or below the source's cutoff. The cutoff is
the hash at which the running size of the source, in hash order, comes nearest
to the fraction that is left. It is found by descending through two levels of
256 hash ranges, so that only 1/65536 of a source is ever sorted in one task.

Cases: a null text has size 0; a null source is a source, the last one; a source
without words has target 0; an empty table gives an empty result; fully repeated
rows share one hash and so are taken alike; extra columns pass through, and
columns that the operator adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.plans.shared import shared_table

SEED = 4_099
WEIGHTS = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(seed: int, *columns: Column) -> Column:
    """A signed 64-bit number, in steps of 16, from the MD5 of seed and columns, colon-joined; a null is empty."""
    text = F.concat(F.lit(str(seed)), *[x for c in columns for x in (F.lit(":"), F.coalesce(c.cast("string"), F.lit("")))])
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") - F.lit(1 << 59)) * 16


def _keyed(df: DataFrame, text: str, source: str, doc_id: str, seed: int) -> DataFrame:
    return df.withColumns({"_size": word_count(F.col(text)), "_source": F.col(source), "_h": seeded_hash(seed, F.col(doc_id), F.col(text))})


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_source, source_size, weight, target) from (_source, source_size), one row per source.

    The windows run over one row per source, never over documents.
    """
    # Null sorts last; Spark compares strings by their UTF-8 bytes, which is code-point order.
    rank = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank"), F.lit(len(weights))) + 1))
    ranked = sizes.withColumn("_rank", rank).withColumn("weight", weight).withColumn("_cap", F.col("source_size") * max_epochs)
    ranked = ranked.withColumn("_reach", F.col("_cap") / F.col("weight"))  # the level at which it is full
    order = W.orderBy("_reach", "_rank")
    ahead = order.rowsBetween(W.unboundedPreceding, -1)
    behind = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    full = F.coalesce(F.sum("_cap").over(ahead), F.lit(0))
    total = F.sum("source_size").over(whole)
    leveled = ranked.withColumn("_level", (total - full) / F.sum("weight").over(behind))
    level = F.min(F.when(F.col("_level") <= F.col("_reach"), F.struct("_reach", "_rank", "_level"))).over(whole)["_level"]
    return leveled.withColumn("_final", level).select(
        "_source",
        "source_size",
        "weight",
        F.least(F.col("weight") * F.col("_final"), F.col("_cap").cast("double")).alias("target"),
    )


def _crossing(rows: DataFrame, bucket: Column, left: str) -> DataFrame:
    """Per source, the hash range in which the running size passes ``left``, and what of ``left`` is left there."""
    sums = rows.groupBy("_id", left, bucket.alias("_b")).agg(F.sum("_size").alias("_sum"))
    ahead = W.partitionBy("_id").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    cum = sums.withColumn("_cum", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    return cum.filter((F.col("_cum") <= F.col(left)) & (F.col(left) < F.col("_cum") + F.col("_sum"))).select(
        "_id", "_b", (F.col(left) - F.col("_cum")).alias("_left")
    )


def plan_mix(keyed: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: its target, whole repetitions and the cutoff hash of one repetition more."""
    narrow = shared_table(keyed.select("_source", "_size", "_h"), "mix_rows")
    sizes = narrow.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = source_targets(sizes, weights, max_epochs).withColumn("_whole", F.floor(ratio).cast("int"))
    plan = plan.withColumn("_extra", F.col("target") - F.col("_whole") * F.col("source_size"))
    plan = shared_table(plan.withColumn("_id", F.xxhash64("_source", F.col("_source").isNull())), "mix_plan")
    # Signed order of the hash is the order of (_b1 signed, _b2 unsigned).
    rows = narrow.join(plan.select("_source", "_id", "_extra"), narrow["_source"].eqNullSafe(plan["_source"])).select(
        "_id", "_extra", "_size", "_h", F.shiftright("_h", 56).alias("_b1"), F.pmod(F.shiftright("_h", 48), F.lit(256)).alias("_b2")
    )
    one = shared_table(_crossing(rows, F.col("_b1"), "_extra").withColumnsRenamed({"_b": "_b1"}), "mix_level1")
    in_one = rows.drop("_extra").join(one, ["_id", "_b1"])
    two = shared_table(
        _crossing(in_one, F.col("_b2"), "_left").withColumnsRenamed({"_b": "_b2"}).join(one.select("_id", "_b1"), "_id"), "mix_level2"
    )
    ahead = W.partitionBy("_id").orderBy("_h")
    last = rows.drop("_extra").join(two, ["_id", "_b1", "_b2"]).groupBy("_id", "_left", "_h").agg(F.sum("_size").alias("_size"))
    taken = last.withColumn("_to", F.sum("_size").over(ahead)).filter(F.col("_to") - F.col("_size") / 2 <= F.col("_left"))
    cut = taken.groupBy("_id").agg(F.max("_h").alias("_cut"))
    # Below the crossing range all rows are taken even where none within it is.
    floor = two.select("_id", (F.shiftleft(F.col("_b1").cast("long"), 56) + F.shiftleft(F.col("_b2").cast("long"), 48)).alias("_from"))
    return shared_table(
        plan.join(floor, "_id", "left").join(cut, "_id", "left").select(
            "_source", "source_size", "target", "_whole", "_extra", "_from", "_cut"
        ),
        "mix_cuts",
    )


def with_repetitions(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
                     weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``df`` with size, source_size, target and repetitions (whole copies that the mix takes)."""
    keyed = _keyed(df, text, source, doc_id, seed)
    plan = plan_mix(keyed, weights, max_epochs).withColumnRenamed("_source", "_of")
    more = F.when(F.col("_extra") <= 0, False).when(F.col("_from").isNull(), True)
    more = more.otherwise((F.col("_h") < F.col("_from")) | F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False)))
    joined = keyed.join(plan, keyed["_source"].eqNullSafe(plan["_of"]))
    added = {
        "size": F.col("_size"),
        "source_size": F.col("source_size"),
        "target": F.col("target"),
        "repetitions": F.least(F.col("_whole") + F.when(more, 1).otherwise(0), F.lit(max_epochs)).cast("int"),
    }
    return joined.select(*[F.col(c) for c in df.columns if c not in added], *[c.alias(n) for n, c in added.items()])


def mix(df: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, with the columns of ``df``."""
    own = [c for c in df.columns]
    # Repetitions are at most max_epochs, so the explode is bounded.
    times = with_repetitions(df.select(F.struct(*own).alias("_row"), *[F.col(c) for c in ("text", "source", "doc_id")]), **options)
    return times.filter("repetitions > 0").withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("repetitions")))).select("_row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words that the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return with_repetitions(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repetitions")).alias("taken")
    )


#: The level is the first, in the order in which sources reach their caps, that does not pass its source's cap.
OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('4099:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) - 576460752303423488) * 16 AS h
  FROM documents
), s AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS k FROM d GROUP BY source
), c AS (
  SELECT *, CAST(1 + k % 3 AS DOUBLE) AS weight, 3 * source_size AS cap, 3 * source_size / CAST(1 + k % 3 AS DOUBLE) AS reach, sum(source_size) OVER () AS total FROM s
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY reach, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY reach, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c
), t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, least(weight * (SELECT level FROM l WHERE level <= reach ORDER BY reach, k LIMIT 1), CAST(cap AS DOUBLE)) AS target FROM l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS extra,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto, sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, CAST(size * least(whole + CASE WHEN extra > 0 AND upto - own / 2 <= extra THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken FROM r
"""
