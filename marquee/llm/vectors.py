"""What the operators on whole-number vectors share: which rows take part, matrices, sums over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import columns_of

EXACT = 1 << 53  # whole numbers up to here are exact in double precision


def finite(vector: Column) -> Column:
    """A vector with at least one component, none of them null or non-finite."""
    plain = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & plain, F.lit(False))


def whole_vectors(df: DataFrame, scale: int, offset: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x``: each component c, as double, becomes floor(scale * c) + offset.

    Rows whose vector is null, empty, or holds null or non-finite components are left out. Scaled components
    from 2^53 on have no exact whole number: they raise an error where the frame is computed.
    """
    named = columns_of(df, vec_id=id_col, vector=vector_col).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")
    )

    def whole(c: Column) -> Column:
        scaled = F.floor(F.lit(float(scale)) * c)
        return F.when(F.abs(scale * c) < EXACT, scaled + offset).otherwise(
            F.raise_error(F.lit(f"a component times {scale} is beyond 2^53")).cast("bigint")
        )

    usable = named.where(finite(F.col("vector")))
    return usable.select("vec_id", F.transform("vector", whole).alias("x"))


def matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def same_length(lengths: tuple[int, int]) -> int:
    """The common length, given the least and the greatest."""
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors of different lengths, {lengths[0]} to {lengths[1]}")
    return lengths[0]


def summed(df: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int, kind: str = "double") -> np.ndarray:
    """The sum over all batches of an array of ``size`` numbers made from each.

    A task adds up its own batches and sends ``size`` rows; Spark sums them by place, so only ``size``
    numbers reach the driver however many tasks there are. ``size`` depends on the dimensions alone.
    """
    number = np.int64 if kind == "bigint" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, number)
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
        yield pa.RecordBatch.from_pydict({"place": np.arange(size), "value": total})

    sums = df.mapInArrow(run, f"place bigint, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    rows = sums.toArrow()
    out = np.zeros(size, number)
    out[rows["place"].to_numpy()] = rows["value"].to_numpy()
    return out
