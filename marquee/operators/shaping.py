"""Repeatable reshaping of a frame: samples, overlays, faults, id ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.draws import digest, uniform
from marquee.operators.ranking import row_numbers


def hash_sample(df: DataFrame, fraction: float, keys: Sequence[str], salt: str = "sample") -> DataFrame:
    """Bernoulli sample that picks the same rows whatever the partitioning."""
    return df.where(uniform(digest(salt, *keys)) < F.lit(float(fraction)))


def overlay(df: DataFrame, where: Column, columns: Mapping[str, Column]) -> DataFrame:
    """Replace columns inside a slice of the frame and leave the rest as it is."""
    inside = F.coalesce(where, F.lit(False))
    return df.withColumns(
        {name: F.when(inside, new).otherwise(F.col(name)) for name, new in columns.items()}
    )


def payment_incident(
    df: DataFrame, where: Column, failure_rate: float, keys: Sequence[str], salt: str = "incident"
) -> DataFrame:
    """An outage: in the slice a booking fails with ``failure_rate``, else it succeeds."""
    draw = uniform(digest(salt, *keys))
    outcome = F.when(draw < F.lit(float(failure_rate)), "failed").otherwise("success")
    return overlay(df, where, {"payment_status": outcome})


def inject_faults(
    df: DataFrame, fraction: float, keys: Sequence[str], orphan: object, salt: str = "faults"
) -> DataFrame:
    """Damage ``fraction`` of the bookings and repeat a third of that many rows.

    A damaged row gets, a third each, an unknown customer, a negated amount or no booking id.
    Damage and repetition are functions of the row's key, so a repeated row equals its original.
    """
    source = F.col("_digest")
    hit = uniform(source, 0) < F.lit(float(fraction))
    damage = F.when(hit, F.floor(uniform(source, 1) * 3).cast("int")).otherwise(F.lit(-1))
    again = uniform(source, 2) < F.lit(float(fraction) / 3)
    # The kind of damage comes out of the same explode that repeats the row: one scan and one
    # hash per row, where a union would evaluate the frame twice, and a plain column would be
    # computed again inside every filter that is pushed below it.
    drawn = df.withColumn("_digest", digest(salt, *keys)).withColumn(
        "_damage", F.explode(F.array_repeat(damage, F.lit(1) + again.cast("int")))
    )
    unknown = F.lit(orphan).cast(df.schema["customer_id"].dataType)
    return drawn.withColumns(
        {
            "customer_id": F.when(F.col("_damage") == 0, unknown).otherwise(F.col("customer_id")),
            "ticket_amount": F.when(F.col("_damage") == 1, -F.col("ticket_amount"))
            .otherwise(F.col("ticket_amount")),
            "booking_id": F.when(F.col("_damage") != 2, F.col("booking_id")),
        }
    ).drop("_digest", "_damage")


def continue_ids(
    df: DataFrame, start: int, order: Sequence[Column], name: str, pattern: str | None = None,
    distributed: bool = True,
) -> DataFrame:
    """Number the rows from ``start + 1`` on, optionally formatted as text."""
    numbered = row_numbers(df, order, name, distributed).withColumn(name, F.col(name) + F.lit(start))
    if pattern is None:
        return numbered
    return numbered.withColumn(name, F.format_string(pattern, F.col(name)))
