"""Exact top-k inner products by aggregation of lists without random access.

Each dimension is a list of components. A block of queries and a block of candidates
read the lists one after the other, those first that can move scores most, and a
candidate's sum so far is exact. What the lists not yet read can add to it is bounded
twice: by the ends of each list, and by the lengths of what is unread of query and
candidate (Cauchy and Schwarz). So each candidate has a lower and an upper score, and
those whose upper score is under the k-th best lower one cannot qualify any more.
Reading stops for a query when few outsiders are left; their scores are then resolved in full.
No list is read twice, so the products never cost more than the exact ones. Sums are
kept in a type that holds the integers exactly.

The k-th best lower score is itself bounded from below: candidates are dealt into
groups, and the k-th best of the groups' best lower scores is reached by at least k of them.

Queries and candidates are dealt into blocks; a cell of the grid holds one of
each and returns at most k rows a query, and the last step ranks k rows a block.

Cases: vectors that are null, empty or hold null or non-finite components take no
part, nor do rows without a vec_id; a query is compared with vectors of its own length;
only a query's own row is left out, so other rows with its vec_id are candidates, and
repeated rows are queries and candidates of their own; fewer candidates than k are all
returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.llm.vectors import block_of, matrix, pack
from shelfmark.plans.shared import shared_table

K = 5
SCALE = 256
CANDIDATE_ROWS = 4096
QUERY_ROWS = 2048
#: Queries of a cell that are compared at once.
STRIP = 256
#: Lists that are read before outsiders are looked for again.
LISTS_AT_ONCE = 24
#: Candidates of a query that are resolved in full instead of reading on.
FEW = 64
GROUPS = 64
#: The sum of what takes no part.
OUT = -(2.0**60)
_CELL = "query_row long, query_id long, vec_id long, row long, score long"


def _number_type(q: np.ndarray, x: np.ndarray):
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _kth_at_least(sums: np.ndarray, k: int) -> np.ndarray:
    """For each row, a value that at least k entries reach: exact for short rows, else the k-th best of groups' best."""
    size = sums.shape[1] // GROUPS
    if size > 1 and k <= GROUPS:
        sums = sums[:, : size * GROUPS].reshape(len(sums), size, GROUPS).max(axis=1)
    return np.partition(sums, sums.shape[1] - k, axis=1)[:, sums.shape[1] - k]


def _lengths(x: np.ndarray) -> np.ndarray:
    """Rows' lengths, rounded up."""
    x = x.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", x, x)) * (1 + 1e-9)


def survivors(q: np.ndarray, x: np.ndarray, own: np.ndarray, k: int):
    """(query, candidates that can be among its k best, how many lists were read) of every row of q.

    ``own`` has the place of each query's own row in x, or -1. What is unread adds at
    most ``most`` and at least ``least`` to any candidate, so one whose sum is further
    than their difference under the k-th best sum is out.
    """
    low, high = x.min(axis=0).astype(np.float64), x.max(axis=0).astype(np.float64)
    order = np.argsort(-np.abs(q).mean(axis=0) * (high - low), kind="stable")
    open_ = np.arange(len(q))
    sums = np.zeros((len(q), len(x)), q.dtype)
    has = own >= 0
    sums[has, own[has]] = OUT
    for read in range(LISTS_AT_ONCE, x.shape[1] + LISTS_AT_ONCE, LISTS_AT_ONCE):
        lists, rest = order[read - LISTS_AT_ONCE : read], order[read:]
        sums += q[np.ix_(open_, lists)] @ x[:, lists].T
        part = q[np.ix_(open_, rest)].astype(np.float64)
        up, down = np.maximum(part, 0), np.minimum(part, 0)
        reach = _lengths(part) * _lengths(x[:, rest]).max()
        most = np.minimum(up @ high[rest] + down @ low[rest], reach)
        least = np.maximum(up @ low[rest] + down @ high[rest], -reach)
        # Scores are whole numbers, so one more covers all rounding.
        alive = sums >= (_kth_at_least(sums, k) - np.ceil(most - least + 1).astype(sums.dtype))[:, None]
        done = np.count_nonzero(alive, axis=1) <= FEW if len(rest) else np.ones(len(open_), bool)
        for i in np.flatnonzero(done):
            places = np.flatnonzero(alive[i])
            yield int(open_[i]), places[places != own[open_[i]]], min(read, x.shape[1])
        if done.any():
            open_, sums = open_[~done], sums[~done]
        if not len(open_):
            return


def _cell(k: int):
    def best(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        is_query = table.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
        ids, rows = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        values = np.floor(matrix(table.column("data"), dim) * SCALE)
        q, x = values[is_query], values[~is_query]
        q_ids, x_ids, q_rows, x_rows = ids[is_query], ids[~is_query], rows[is_query], rows[~is_query]
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        if len(q) and len(x):
            kind = _number_type(q, x)
            q, x = q.astype(kind), x.astype(kind)
            by_row = np.argsort(x_rows)
            at = by_row[np.minimum(np.searchsorted(x_rows, q_rows, sorter=by_row), len(x) - 1)]
            own = np.where(x_rows[at] == q_rows, at, -1)
            for a in range(0, len(q), STRIP):
                some, mine = q[a : a + STRIP], own[a : a + STRIP]
                if len(x) > k:
                    found = survivors(some, x, mine, k)
                else:
                    found = ((i, np.flatnonzero(np.arange(len(x)) != mine[i]), 0) for i in range(len(some)))
                for i, places, _ in found:
                    score = (x[places] @ some[i]).astype(np.int64)
                    top = np.lexsort((x_rows[places], x_ids[places], -score))[:k]
                    for c, v in zip(out, (np.full(len(top), q_rows[a + i]), np.full(len(top), q_ids[a + i]), x_ids[places][top], x_rows[places][top], score[top]), strict=True):
                        c.append(v)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table(dict(zip(_NAMES, columns, strict=True)), schema=pa.schema([(c, pa.int64()) for c in _NAMES]))

    return best


_NAMES = ("query_row", "query_id", "vec_id", "row", "score")


def numbered(df: DataFrame) -> DataFrame:
    """df(vec_id, embedding) packed and written, with a number ``row`` of its own for each row."""
    return shared_table(pack(df).withColumn("row", F.monotonically_increasing_id()), "vectors")


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``candidates`` for each row of ``queries``.

    Both are parts of one table that :func:`numbered` made.
    """
    some = F.col("data").isNotNull() & F.col("vec_id").isNotNull()
    queries, candidates = queries.filter(some), candidates.filter(some)
    q_block, q_blocks = block_of(F.col("row"), queries.count(), QUERY_ROWS)
    c_block, c_blocks = block_of(F.col("row"), candidates.count(), CANDIDATE_ROWS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select("vec_id", "row", "dim", "data", F.lit(True).alias("is_query"), q_block.alias("qb"), every(c_blocks).alias("cb"))
    c = candidates.select("vec_id", "row", "dim", "data", F.lit(False).alias("is_query"), every(q_blocks).alias("qb"), c_block.alias("cb"))
    cells = q.unionByName(c).groupBy("dim", "qb", "cb").applyInArrow(_cell(k), _CELL)
    order = W.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return cells.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all embeddings for every embedding whose vec_id is divisible by 50."""
    vectors = numbered(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors)


OP6_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
