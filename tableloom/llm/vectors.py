"""Which vectors take part in a search or a comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(name: str = "embedding") -> Column:
    """Not null, not zero, and without null or non-finite components."""
    ok = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(name).isNotNull() & ok & F.exists(name, lambda x: x != 0), F.lit(False))


def dimension(vectors: DataFrame) -> int | None:
    """The most frequent length of the usable vectors, the larger if two are; others can't be compared with them."""
    top = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else None


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
