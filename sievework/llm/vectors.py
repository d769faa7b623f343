"""What the two vector searches share: usable vectors, matrices from Arrow, and the best rows of each query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vec: str) -> Column:
    """A vector that is not null or empty and whose components are neither null nor non-finite."""
    x = F.col(vec)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & ~bad


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of one length as a matrix of doubles."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def pick(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def best(found: DataFrame, k: int) -> DataFrame:
    """rank, from 1, of the k best rows of each query; Spark limits each task's groups before it shuffles."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
