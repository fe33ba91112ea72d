"""Connected components by alternating large-star and small-star rounds.

Follows Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).
Each round is joins and minimum-aggregations over the edge table; nothing is
collected. Minimums are written before they are joined back, so both join sides
are plain exchanges, which adaptive execution can split when a hub holds a large
share of all edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.shared import drop_shared, shared_table


def _digests(*tables: DataFrame) -> list[tuple[int, int]]:
    """Row count and an order-free digest of each table, in one job.

    (An ``Observation`` would spare the scan, but once a session has used one, functions
    that hold the session, such as those of fitted MLlib models, can no longer be sent to executors.)
    """
    rows = [
        t.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.hash(*t.columns).cast("long")), F.lit(0)).alias("h"))
        for k, t in enumerate(tables)
    ]
    return [(r["n"], r["h"]) for r in sorted(reduce(DataFrame.unionAll, rows).collect())]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    Edges are undirected; self-loops, repeats and rows with a null end are ignored. The result
    reads one shared table, which ``drop_shared`` of the result deletes.
    """
    first = (
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
        .distinct()
    )
    e = shared_table(first, "cc_edges")
    [size] = _digests(e)
    for _ in range(max_rounds):
        if not size[0]:
            break
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = shared_table(sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc_low")
        large = sym.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        big = shared_table(large, "cc_large")
        low2 = shared_table(big.groupBy("u").agg(F.min("v").alias("m")), "cc_low2")
        drop_shared(low)
        big_size, low2_size = _digests(big, low2)
        if big_size == size and low2_size[0] == size[0]:
            drop_shared(big, low2)  # a forest of stars: every node has one edge, to its smallest
            break
        small = (
            big.join(low2, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low2.select("u", F.col("m").alias("v")))
            .distinct()
        )
        new = shared_table(small, "cc_edges")
        drop_shared(big, low2, e)
        e = new
        [size] = _digests(e)
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    out._shelfmark_path = e._shelfmark_path
    return out
