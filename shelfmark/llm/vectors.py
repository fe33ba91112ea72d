"""Vectors in a grid of blocks: shared by the near-duplicate and the top-k operator."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector as doubles, or None where it is null, empty or holds null or non-finite components."""
    out: list[np.ndarray | None] = []
    values = column.values.cast(pa.float64())
    bad = np.asarray(values.is_null())
    flat = values.fill_null(0.0).to_numpy(zero_copy_only=False)
    bad |= ~np.isfinite(flat)
    at = column.offsets.to_numpy()
    null = np.asarray(column.is_null())
    for i in range(len(column)):
        a, b = at[i], at[i + 1]
        out.append(None if null[i] or a == b or bad[a:b].any() else flat[a:b] + 0.0)  # -0.0 becomes 0.0
    return out


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, key, data): the vector's doubles as bytes, and a digest of them; nulls where unusable."""
    for batch in batches:
        vectors = usable(batch.column("embedding"))
        data = [None if v is None else v.tobytes() for v in vectors]
        keys = [None if x is None else hashlib.blake2b(x, digest_size=16).digest() for x in data]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([0 if v is None else len(v) for v in vectors], pa.int32()), pa.array(keys, pa.binary()), pa.array(data, pa.binary())],
            ["vec_id", "dim", "key", "data"],
        )


def pack(df: DataFrame) -> DataFrame:
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(packed, "vec_id long, dim int, key binary, data binary")


def block_of(key: Column, n: int, rows: int) -> tuple[Column, int]:
    """A block number for each key such that a block has about ``rows`` of ``n``, and the number of blocks."""
    blocks = max(1, math.ceil(n / rows))
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"), blocks


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.float64).reshape(-1, dim)
