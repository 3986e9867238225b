"""Running values over ordered rows of a key, however many rows the key has.

Rows are dealt by range of key and order, so a hot key stands in several partitions, one
after the other. Windows run within a partition; what a partition must know of those before or behind it
comes from one row per partition and key, and only for keys that stand in several
partitions, of which there are fewer than partitions. Those rows are small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

PART = "part"


def ordered_parts(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows dealt by range, with the number of their partition as ``part``; to be stored, so
    that the dealing is not repeated."""
    n = max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return frame.repartitionByRange(n, *keys, *order).withColumn(PART, F.spark_partition_id())


def shared_keys(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that stand in more than one partition: fewer than there are partitions."""
    key = F.struct(*keys)
    ends = stored.groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    named = ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("key"))
    return named.groupBy("key").agg(F.count("*").alias("parts")).where("parts > 1").select("key.*")


def within(keys: list[str], order: list[str]) -> WindowSpec:
    """The rows of a key up to this one, within a partition."""
    return (
        Window.partitionBy(PART, *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def with_carried(
    stored: DataFrame,
    keys: list[str],
    totals: dict[str, Column],
    carried: Callable[[DataFrame, WindowSpec, WindowSpec], DataFrame],
) -> DataFrame:
    """``stored`` with what other partitions hand to each key, null where they have nothing.

    ``totals`` are aggregates of a partition's rows of a key. ``carried`` adds columns to
    the totals, given windows over the partitions before and behind; they are joined by partition and key.
    """
    hot = F.broadcast(shared_keys(stored, keys))  # fewer rows than partitions
    parts = stored.join(hot, keys, "left_semi").groupBy(PART, *keys).agg(*(c.alias(n) for n, c in totals.items()))
    over = Window.partitionBy(*keys).orderBy(PART)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    behind = over.rowsBetween(1, Window.unboundedFollowing)
    handed = carried(parts, before, behind).drop(*totals)
    return stored.join(F.broadcast(handed), [PART, *keys], "left")
