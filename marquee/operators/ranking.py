"""Global ranks without gathering the table in one task.

A window without PARTITION BY sends every row to a single task. Here the rows are range-partitioned
by the ranking order, written to the checkpoint folder once, and each partition's start is added
from a table with one row per partition. This plan is used at every size; the plain window is there
for callers who ask for it with ``distributed=False``.

``rows``, where the caller knows a bound, raises the number of range partitions above the session's, so
that a task sorts about ``ROWS_PER_TASK`` rows.

The checkpoint fixes which row sits in which partition: range bounds are sampled, so they could
differ if the frame were computed again for the second job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import ensure_checkpoint_dir, shuffle_partitions

ROWS_PER_TASK = 2_000_000
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row position below


def _starts(parts: DataFrame, total: str) -> DataFrame:
    """Start of each partition and the grand total; ``parts`` has one row per partition."""
    line = Window.orderBy("_part")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    everything = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return parts.select(
        "_part",
        F.coalesce(F.sum("_in_part").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_in_part").over(everything).alias(total),
    )


def _ranges(df: DataFrame, order: Sequence[Column], rows: int | None) -> DataFrame:
    """``df`` in range partitions of bounded size."""
    ensure_checkpoint_dir(df.sparkSession)
    needed = -(-(rows or 0) // ROWS_PER_TASK)
    return df.repartitionByRange(max(needed, shuffle_partitions(df.sparkSession)), *order)


def _numbered(
    df: DataFrame, order: Sequence[Column], before: str, total: str, rows: int | None
) -> DataFrame:
    """``rows_before`` with the number of the partition as ``_part``, stored."""
    placed = (
        _ranges(df, order, rows)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumns(
            {
                "_part": F.shiftright("_id", _ROW_BITS),
                "_row": F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
            }
        )
    )
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_in_part"))
    return (
        placed.join(F.broadcast(_starts(parts, total)), "_part")  # one row per partition
        .withColumn(before, F.col("_start") + F.col("_row"))
        .drop("_id", "_row", "_start")
    )


def rows_before(
    df: DataFrame, order: Sequence[Column], before: str, total: str, rows: int | None = None
) -> DataFrame:
    """Adds the number of earlier rows in ``order`` and the number of all rows.

    ``order`` must be total: partition bounds can then cut between any two rows, also inside a
    run of equal leading values that holds most of the table.
    """
    return _numbered(df, order, before, total, rows).drop("_part")


def sum_before(
    df: DataFrame, order: Sequence[Column], amount: str, before: str, total: str,
    rows: int | None = None,
) -> DataFrame:
    """Adds the sum of ``amount`` over all earlier rows in ``order`` and over all rows."""
    placed = _ranges(df, order, rows).withColumn("_part", F.spark_partition_id()).checkpoint()
    parts = placed.groupBy("_part").agg(F.sum(amount).alias("_in_part"))
    earlier = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_local", F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
        .join(F.broadcast(_starts(parts, total)), "_part")
        .withColumn(before, F.col("_start") + F.col("_local"))
        .drop("_part", "_start", "_local")
    )


def row_numbers(
    df: DataFrame, order: Sequence[Column], name: str, distributed: bool = True, rows: int | None = None
) -> DataFrame:
    """1-based position of each row in ``order``, which must be total."""
    if not distributed:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    counted = rows_before(df, order, "_before", "_rows", rows)
    return counted.withColumn(name, F.col("_before") + 1).drop("_before", "_rows")


def ntile(
    df: DataFrame, tiles: int, order: Sequence[Column], name: str, distributed: bool = True,
    rows: int | None = None,
) -> DataFrame:
    """``ntile(tiles)`` over the whole frame; the first tiles take the odd rows."""
    if not distributed:
        return df.withColumn(name, F.ntile(tiles).over(Window.orderBy(*order)))
    counted = rows_before(df, order, "_before", "_rows", rows)
    size = F.floor(F.col("_rows") / tiles)
    odd = F.col("_rows") % tiles
    in_big_tiles = odd * (size + 1)
    tile = F.when(
        F.col("_before") < in_big_tiles, F.floor(F.col("_before") / (size + 1))
    ).otherwise(odd + F.floor((F.col("_before") - in_big_tiles) / F.greatest(size, F.lit(1))))
    return counted.withColumn(name, (tile + 1).cast("int")).drop("_before", "_rows")


def percent_rank(
    df: DataFrame, value: str, name: str, distributed: bool = True, rows: int | None = None
) -> DataFrame:
    """``percent_rank`` over the whole frame, ascending; equal values share a rank.

    In the distributed form the rank of a value is the number of rows before its first one. Each
    range partition finds it for its own rows; a value that began in an earlier partition takes it
    over from there, by a table with one row per partition. Ties are cut by a hash of the row, so a
    value that most rows share is spread over tasks, and nothing is joined by value.
    """
    if not distributed:
        return df.withColumn(name, F.percent_rank().over(Window.orderBy(value)))
    order = [F.col(value).asc(), F.xxhash64(*df.columns).asc()]
    numbered = _numbered(df, order, "_before", "_rows", rows)
    sortable = F.struct(F.col(value).isNotNull().alias("known"), F.col(value).alias("value"))
    runs = numbered.groupBy("_part", value).agg(F.min("_before").alias("first"))
    run = F.struct(sortable.alias("of"), F.col("first").alias("first"))
    ends = runs.groupBy("_part").agg(F.min(run).alias("_head"), F.max(run).alias("_tail"))
    begun = ends.groupBy(F.col("_tail.of").alias("_of")).agg(F.min("_tail.first").alias("_begun"))
    heads = ends.join(F.broadcast(begun), F.col("_head.of") == F.col("_of"), "left").select(
        "_part", F.col("_head.of").alias("_of"), F.least("_head.first", "_begun").alias("_carried")
    )
    own = F.min("_before").over(Window.partitionBy("_part", value))
    first = F.when(sortable == F.col("_of"), F.col("_carried")).otherwise(F.col("_own"))
    rank = F.when(F.col("_rows") > 1, first / (F.col("_rows") - 1)).otherwise(F.lit(0.0))
    return (
        numbered.withColumn("_own", own)
        .join(F.broadcast(heads), "_part")  # one row per partition
        .withColumn(name, rank)
        .drop("_part", "_before", "_rows", "_own", "_of", "_carried")
    )


def weight_buckets(
    df: DataFrame, key: str, weight: str, distributed: bool = True, rows: int | None = None
) -> DataFrame:
    """Turns integer weights into half-open shares ``[lo, hi)`` of [0, 1) in key order.

    Weights are integers so that running totals are exact in any order of evaluation.
    """
    order = [F.col(key).asc()]
    if not distributed:
        line = Window.orderBy(*order)
        summed = df.withColumn(
            "_before",
            F.coalesce(F.sum(weight).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        ).withColumn(
            "_all", F.sum(weight).over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        )
    else:
        summed = sum_before(df, order, weight, "_before", "_all", rows)
    return summed.select(
        key,
        (F.col("_before") / F.col("_all")).alias("lo"),
        ((F.col("_before") + F.col(weight)) / F.col("_all")).alias("hi"),
    )
