"""Newest row per key: the batch form of a keyed change-data-capture flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import ensure_checkpoint_dir


def latest_per_key(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest sequence, ties by the remaining columns.

    The winner is the maximum of a struct that starts with the sequence and goes on with every
    other column, so the order is total and the result does not depend on file or task order.
    ``max`` combines map-side: a key that holds a third of the rows sends one candidate per task
    through the shuffle, where a window would gather all of its rows in one task.
    """
    ordered = [*sequence, *[c for c in df.columns if c not in sequence and c not in keys]]
    winner = F.max(F.struct(*ordered)).alias("_winner")
    return df.groupBy(*keys).agg(winner).select(
        *[F.col(c) if c in keys else F.col(f"_winner.{c}").alias(c) for c in df.columns]
    )


def merge_changes(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]
) -> DataFrame:
    """``current`` (unique by key) with ``changes`` applied; an older change loses, a replay is a no-op.

    Rows whose key did not change pass by untouched. While the changed keys are small enough for
    Spark to broadcast, the large side is not shuffled at all. The change, one row per key, is stored
    once, since three branches of the plan read it.
    """
    ensure_checkpoint_dir(changes.sparkSession)
    fresh = latest_per_key(changes, keys, sequence).checkpoint()
    touched_keys = fresh.select(*keys)
    untouched = current.join(touched_keys, list(keys), "left_anti")
    touched = current.join(touched_keys, list(keys), "left_semi")
    contested = touched.unionByName(fresh, allowMissingColumns=True)
    return untouched.unionByName(latest_per_key(contested, keys, sequence), allowMissingColumns=True)
