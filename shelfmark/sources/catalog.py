"""A product catalog derived from the ``part`` and ``lineitem`` tables.

One SQL text serves Spark and other engines: it uses only CASE, ``||``, ``%`` and
casts. It exercises null brands, spelling variants, missing and invalid JSON,
specification-over-title precedence and all processor patterns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.plans.shared import shared_table

CATALOG_SQL = """
SELECT k AS row_id, CAST(k AS STRING) AS product_id, seller_id, 'electronics' AS category, sub_category, brand,
  p_brand || ' ' || p_name || ' ' || inch || ' inch ' || CASE WHEN k % 13 < 9 THEN ram || 'GB RAM ' ELSE '' END
    || CASE WHEN k % 13 < 8 THEN storage || ' SSD ' ELSE '' END || cpu || CASE WHEN p_size % 5 = 0 THEN ' 2024' ELSE '' END || extra AS name,
  cond AS brief_description,
  CASE WHEN k % 13 = 12 THEN '{bad' WHEN k % 13 = 11 THEN '' ELSE '{"brand":"' || p_brand || '","color":"' || colour
    || '","specifications":{"RAM Memory":"' || ram || ' GB","Screen Size":"' || inch || ' in","Color":"' || colour
    || '","Condition":"' || cond || '"}}' END AS details,
  'X' AS model
FROM (
  SELECT p_partkey AS k, p_brand, p_name, p_size, s.seller_id,
    CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'ECONOMY') THEN 'Laptop' WHEN p_type IN ('LARGE', 'PROMO') THEN 'TV' ELSE 'Monitor' END AS sub_category,
    CASE p_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'Brand: ' || p_brand WHEN 2 THEN p_brand || ' (Refurbished)' ELSE p_brand END AS brand,
    CASE p_partkey % 4 WHEN 0 THEN '4' WHEN 1 THEN '8' WHEN 2 THEN '16' ELSE '32' END AS ram,
    CASE p_partkey % 5 WHEN 0 THEN '128 GB' WHEN 1 THEN '256 GB' WHEN 2 THEN '512 GB' WHEN 3 THEN '1 TB' ELSE '1.5 TB' END AS storage,
    CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'ECONOMY') THEN CAST(11 + p_size % 7 AS STRING) || CASE WHEN p_size % 2 = 0 THEN '.6' ELSE '' END
      ELSE CAST(20 + 2 * p_size AS STRING) END AS inch,
    CASE p_partkey % 6 WHEN 0 THEN 'Intel Core i5-1235U' WHEN 1 THEN 'Ryzen 7 7840U' WHEN 2 THEN 'M2 Pro' WHEN 3 THEN 'i7-13700H'
      WHEN 4 THEN 'Intel Core i3' ELSE '' END AS cpu,
    CASE p_partkey % 7 WHEN 0 THEN 'Silver' WHEN 1 THEN 'Space Grey' WHEN 2 THEN 'Midnight' WHEN 3 THEN 'Black' ELSE '' END AS colour,
    CASE p_partkey % 9 WHEN 0 THEN 'Refurbished' WHEN 1 THEN 'Open Box' WHEN 2 THEN 'Renewed' WHEN 3 THEN 'Restored: Like New' ELSE '' END AS cond,
    CASE p_partkey % 11 WHEN 0 THEN ' with Mouse and Bag' WHEN 1 THEN ' Bundle' WHEN 2 THEN ' 2-Pack' WHEN 3 THEN ' TV + Soundbar'
      WHEN 4 THEN ' 3 Pack' ELSE '' END AS extra
  FROM part LEFT JOIN (SELECT l_partkey, CAST(min(l_suppkey) AS STRING) AS seller_id FROM lineitem GROUP BY l_partkey) s ON l_partkey = p_partkey
) AS base
"""


#: Rows of one task: parsing a row takes far longer than reading it, and ``part`` is one small file however many rows it has.
TASK_ROWS = 5_000
_written: dict[tuple[str, str], DataFrame] = {}


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived catalog; the two source tables are given to the SQL by name.

    A large one is written once a session, in files of about ``TASK_ROWS`` rows. (An exchange alone
    would not do: filters on what is parsed are pushed below it, into the one task of the scan.)
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _written:
        return _written[key]
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    query = CATALOG_SQL.replace("FROM part ", "FROM {part} ").replace("FROM lineitem ", "FROM {lineitem} ")
    # str.format sees the JSON braces: they are doubled but for the two table names.
    query = query.replace("'{bad'", "'{{bad'").replace("'{\"brand\"", "'{{\"brand\"").replace('"specifications":{', '"specifications":{{').replace("'\"}}'", "'\"}}}}'")
    part = read("part")
    tasks = -(-max(1, part.count()) // TASK_ROWS)  # the count is read from the file's footer
    # A hint on the inner query: narrow rows are dealt out, before texts are made of them.
    query = query.replace("SELECT p_partkey AS k,", f"SELECT /*+ REPARTITION({tasks}, k) */ p_partkey AS k,")
    rows = spark.sql(query, part=part, lineitem=read("lineitem"))
    if tasks == 1:
        return rows
    _written[key] = shared_table(rows, "catalog")
    return _written[key]
