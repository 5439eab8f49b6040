"""Vector columns as arrays, and sums of them, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """True where the vector is there and every entry of it is a finite number."""
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return F.coalesce(F.forall(F.col(column), lambda c: usable(c.cast("double"))), F.lit(False))


def matrix(column: pa.Array, width: int, dtype: type = np.float64) -> np.ndarray:
    """Rows of a list column, filled up with zeros to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def summed(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> np.ndarray:
    """Element-wise sum, on the driver, of the one array that ``partial`` makes of each partition's rows.

    All arrays have one length, which doesn't depend on the rows; Spark adds them up entry by entry.
    """

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in partial(batches):
            yield pa.RecordBatch.from_arrays([pa.array([values.tolist()], pa.list_(pa.float64()))], ["v"])

    entries = rows.mapInArrow(one, "v array<double>").select(F.posexplode("v").alias("i", "x"))
    sums = entries.groupBy("i").agg(F.sum("x").alias("x")).toPandas().sort_values("i")
    return sums["x"].to_numpy(dtype=np.float64)
