"""What the two vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector takes part: not null, not zero, all components finite, and of the commonest length."""
    v = F.col(vector)
    good = rows.where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0))
    sizes = good.groupBy(F.size(v).alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return good.where(F.size(v) == (sizes[0]["n"] if sizes else 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as rows of double numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 0))

