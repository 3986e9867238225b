"""Tables over the monthly history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.codes import label_or_same
from ..functions.exact import percent

ROWS = "*"
LEVELS = {"macro": "macro_segment", "detailed": "rfm_segment"}
ARRIVED, GONE = "NOUVEAUX", "DISPARUS"


def macro_movements(history: DataFrame) -> DataFrame:
    """Customers and their share per snapshot and macro segment.

    The snapshot total comes from the counted rows (a few per snapshot), not from a second
    read of the history.
    """
    counted = history.groupBy("snapshot_date", "macro_segment").agg(F.count(ROWS).alias("n_users"))
    total = F.sum("n_users").over(Window.partitionBy("snapshot_date"))
    return counted.withColumn("pct_users", percent(F.col("n_users"), total, 2)).orderBy(
        "snapshot_date", "macro_segment"
    )


def snapshot_dates(history: DataFrame) -> DataFrame:
    return history.select("snapshot_date").distinct().orderBy("snapshot_date")


def latest_snapshots(history: DataFrame) -> tuple[date, date] | None:
    """The last two snapshots, the default pair of a transition table."""
    last = history.select("snapshot_date").distinct().orderBy(F.desc("snapshot_date")).take(2)
    return (last[1][0], last[0][0]) if len(last) == 2 else None


def segment_transitions(
    history: DataFrame, date_from: date | str, date_to: date | str, level: str = "macro"
) -> DataFrame:
    """Customers per pair of segments at two snapshots.

    Each customer's two rows meet in one aggregation, which is a full outer join of the two
    snapshots for the price of one read and one shuffle.
    """
    if level not in LEVELS:
        raise ValueError("level must be 'macro' or 'detailed'")
    start, end = (d if isinstance(d, date) else date.fromisoformat(d) for d in (date_from, date_to))
    at, segment = F.col("snapshot_date"), F.col(LEVELS[level])
    pairs = (
        history.where(at.isin(start, end))
        .groupBy("customer_id")
        .agg(
            F.max(F.when(at == F.lit(start), segment)).alias("seg_from"),
            F.max(F.when(at == F.lit(end), segment)).alias("seg_to"),
        )
        .groupBy(
            F.coalesce("seg_from", F.lit(ARRIVED)).alias("seg_from"),
            F.coalesce("seg_to", F.lit(GONE)).alias("seg_to"),
        )
        .agg(F.count(ROWS).alias("n_customers"))
    )
    if level == "detailed":
        pairs = pairs.withColumns(
            {c: label_or_same(F.col(c)) for c in ("seg_from", "seg_to")}
        )
    return pairs.orderBy("seg_from", "seg_to")


def history_volumes(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count(ROWS).alias("total_rows"),
        F.count_distinct("snapshot_date").alias("n_snapshots"),
        F.min("snapshot_date").alias("first_snap"),
        F.max("snapshot_date").alias("last_snap"),
    )


def macro_last_snapshot(history: DataFrame) -> DataFrame:
    last = history.agg(F.max("snapshot_date")).scalar()
    return (
        history.where(F.col("snapshot_date") == last)
        .groupBy("macro_segment")
        .agg(F.count(ROWS).alias("n_users"))
        .orderBy("macro_segment")
    )
