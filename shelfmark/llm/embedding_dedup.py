"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Unit vectors u are rounded to q = rint(127 u) with the error norm e = |u - q/127|
of each kept. For a pair, |u.v - q.r/127^2| <= |q/127| e_v + e_u, so an integer
product under a bound that holds for the whole tile rules a pair out for good.
Products are taken in float32, which holds these integers exactly. What is left is
checked against the pair's own bound and then computed again in double precision.

Equal vectors are one class with a count. Classes are dealt into blocks, and a
cell of the block grid holds two blocks. A cell returns no pairs: it returns each
vector's number of links in the cell and the edges of a spanning forest of them,
so the output is linear in the cell's rows however many pairs are linked.

All pairs of blocks are compared, so the work grows with the square of the number
of different vectors; ``ROWS`` sets how often a row is sent (once per block).

Cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows without a vec_id, link with nothing; vectors of different lengths do not
link; repeated rows are vectors of their own, linked with each other; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.vectors import block_of, matrix, pack
from shelfmark.plans.graph import connected_components
from shelfmark.plans.shared import shared_table

THRESHOLD = 0.95
ROWS = 8192
STRIP = 1024
_CELL = "rep long, links long, root long"


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, their int8 forms, the norms of those and the norms of the errors."""
    scale = np.abs(vectors).max(axis=1, keepdims=True)  # against overflow in squares
    unit = vectors / scale
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    q = np.rint(unit * 127).astype(np.int8)
    back = q / 127.0
    return unit, q, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over the edges (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def linked_pairs(x: tuple, y: tuple, same: bool, threshold: float):
    """Index arrays (i, j) of the pairs with cosine >= threshold, strip by strip."""
    (ux, qx, nx, ex), (uy, qy, ny, ey) = x, y
    exact = np.float32 if qx.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = qy.astype(exact).T
    slack = nx.max() * ey.max() + ex.max() + 1e-9
    low = (threshold - slack) * 127 * 127
    for s in range(0, len(qx), STRIP):
        product = qx[s : s + STRIP].astype(exact) @ right
        i, j = np.nonzero(product >= low)
        if same:
            i, j = i[i + s < j], j[i + s < j]
        near = product[i, j] / (127.0 * 127.0) + nx[i + s] * ey[j] + ex[i + s] >= threshold - 1e-9
        i, j = i[near] + s, j[near]
        keep = np.zeros(len(i), bool)
        for k in range(0, len(i), 1 << 15):
            keep[k : k + (1 << 15)] = np.einsum("ij,ij->i", ux[i[k : k + (1 << 15)]], uy[j[k : k + (1 << 15)]]) >= threshold
        yield i[keep], j[keep]


def _cell(threshold: float):
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        dim, first, second = (k.as_py() for k in key)
        block = table.column("block").to_numpy()
        ids, counts = table.column("rep").to_numpy(), table.column("n").to_numpy()
        vectors = matrix(table.column("data"), dim)
        a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
        links, edges = np.zeros(len(ids), np.int64), []
        if len(a) and len(b):
            x = quantised(vectors[a])
            y = x if first == second else quantised(vectors[b])
            for i, j in linked_pairs(x, y, first == second, threshold):
                i, j = a[i], b[j]
                np.add.at(links, i, counts[j])
                np.add.at(links, j, counts[i])
                root = forest(len(ids), i, j)
                edges.append((np.flatnonzero(root != np.arange(len(ids))), root))
        tail = np.concatenate([n for n, _ in edges]) if edges else np.zeros(0, int)
        head = np.concatenate([r[n] for n, r in edges]) if edges else np.zeros(0, int)
        root = forest(len(ids), tail, head)
        out = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return pa.table({"rep": ids[out], "links": links[out], "root": ids[root[out]]}, schema=pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    return compare


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, rows: int = ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of df(vec_id, embedding)."""
    vectors = shared_table(pack(df), "vectors")
    zero = F.regexp_like(F.hex("data"), F.lit("^0*$"))
    some = vectors.filter(F.col("data").isNotNull() & F.col("vec_id").isNotNull() & ~zero)
    classes = some.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("dim").alias("dim"), F.first("data").alias("data"))
    classes = shared_table(classes, "vector_classes")
    block, blocks = block_of(F.col("key"), classes.count(), rows)
    dealt = classes.select("rep", "n", "dim", "data", block.alias("block")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cells = dealt.groupBy("dim", F.least("block", "other").alias("b0"), F.greatest("block", "other").alias("b1"))
    found = shared_table(cells.applyInArrow(_cell(threshold), _CELL), "vector_links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("rep", "root"), "rep", "root").withColumnRenamed("node", "rep")
    # A class without links outside itself has its own smallest member.
    of_class = (
        classes.select("key", "rep", "n").join(links, "rep", "left").join(parts, "rep", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("of_class"))
    )
    of_class = shared_table(of_class, "vector_components")
    rows_ = vectors.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(of_class, "key", "left")
    component = F.coalesce("of_class", "vec_id")
    return rows_.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept vectors of all embeddings at cosine 0.95."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


#: Cosine is written out in doubles; components by transitive closure.
OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS len FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
  SELECT a.vec_id AS i, b.vec_id AS j FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.len > 0 AND b.len > 0 AND list_inner_product(a.e, b.e) / (a.len * b.len) >= 0.95
), reach AS (
  SELECT vec_id AS i, vec_id AS j FROM v
  UNION
  SELECT r.i, p.j FROM reach r JOIN pairs p ON r.j = p.i
), comp AS (SELECT i, min(j) AS component_id FROM reach GROUP BY i),
links AS (SELECT i, count(*) AS n FROM pairs GROUP BY i)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN comp ON comp.i = v.vec_id LEFT JOIN links ON links.i = v.vec_id
"""
