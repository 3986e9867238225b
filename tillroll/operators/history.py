"""Every customer's state at each monthly snapshot, from the sales up to that date.

The state only changes in months with a purchase. So the purchases are summed per customer
and snapshot first, run up over the customer's active months, and each state is then
repeated for the snapshots until the next one: linear in sales plus output, and sales are
never paired with snapshots.

The states are what is stored and shuffled; there are as many as active months. Their rows, some
twenty times as many, are repeated where they are read, and shuffled nowhere.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.codes import macro_of
from ..functions.exact import MONEY
from .ranks import SMALL, RankedRow
from .scoring import quintile_starts, with_scores, with_segments

MONTH_END = "month_end"
ITERATIVE = "iterative"
CALENDARS = (MONTH_END, ITERATIVE)
#: Snapshots whose rows a task of a write has, and about how many rows; below ``FEW`` a task is not worth its files.
BLOCK, TASK_ROWS, FEW = 12, 2_000_000, 100_000


def snapshot_calendar(visits: DataFrame, kind: str = MONTH_END) -> DataFrame:
    """One snapshot date per month from the first to the last sale.

    ``month_end`` is the last day of each month. ``iterative`` adds a month to the previous
    date, so once a short month has cut the day it stays cut (31 Jan, 28 Feb, 28 Mar, ...).
    """
    bounds = visits.agg(F.min("sale_date").alias("first"), F.max("sale_date").alias("last"))
    return _calendar(bounds, kind).select("snapshot_date").orderBy("snapshot_date")


def _calendar(bounds: DataFrame, kind: str) -> DataFrame:
    """``k`` (0, 1, ...), ``month`` and ``snapshot_date`` for one row of ``first`` and ``last``."""
    if kind not in CALENDARS:
        raise ValueError(f"calendar must be one of {CALENDARS}")
    first, last = F.trunc("first", "month"), F.trunc("last", "month")
    months = bounds.where(F.col("first").isNotNull()).select(
        F.posexplode(F.sequence(first, last, F.expr("interval 1 month"))).alias("k", "month")
    )
    if kind == MONTH_END:
        return months.withColumn("snapshot_date", F.last_day("month"))
    # bounded: one row per month
    so_far = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    shortest = F.min(F.day(F.last_day("month"))).over(so_far)
    return months.withColumn("snapshot_date", F.date_add("month", shortest - 1))


def numbered_calendar(visits: DataFrame, kind: str = MONTH_END) -> DataFrame:
    """``k``, ``month`` and ``snapshot_date`` of the calendar, to be broadcast."""
    first, last = visits.agg(F.min("sale_date"), F.max("sale_date")).first()
    bounds = visits.sparkSession.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return F.broadcast(_calendar(bounds, kind))  # one row per month


def history_base(
    visits: DataFrame, kind: str = MONTH_END, states: DataFrame | None = None, since: date | None = None
) -> DataFrame:
    """Recency, frequency and monetary value per snapshot and customer known by then; ``states`` and
    ``since`` as for ``history_states``."""
    return repeated(history_states(visits, kind, states, since), numbered_calendar(visits, kind))


def history_states(
    visits: DataFrame, kind: str = MONTH_END, states: DataFrame | None = None, since: date | None = None
) -> DataFrame:
    """Each customer's states, with the numbers of the snapshots from ``since`` to before ``until``.

    ``states``, the history's rows of the snapshot ``since``, stand for all sales up to it; then only the
    snapshots behind it are built, and only later visits are read.
    """
    first, last = visits.agg(F.min("sale_date"), F.max("sale_date")).first()
    if first is None:
        return _no_states(visits.sparkSession)
    calendar = numbered_calendar(visits, kind)
    months = (last.year - first.year) * 12 + last.month - first.month + 1

    # the first snapshot that sees a sale: its own month's, or the next one's if later in it
    seen = visits.join(calendar, F.trunc("sale_date", "month") == F.col("month")).withColumn(
        "k", F.when(F.col("sale_date") <= F.col("snapshot_date"), F.col("k")).otherwise(F.col("k") + 1)
    )
    sold = seen.where(F.col("k") < months).select(
        "customer_id",
        "k",
        F.col("opens").cast("bigint").alias("frequency"),
        F.col("amount").alias("monetary"),
        F.col("sale_date").alias("last"),
    )
    if states is not None:
        following = (since.year - first.year) * 12 + since.month - first.month + 1
        carried = states.select(
            "customer_id",
            F.lit(following).alias("k"),
            "frequency",
            "monetary",
            F.date_sub(F.lit(since), F.col("recency") - 1).alias("last"),
        )
        sold = sold.where(F.col("last") > F.lit(since)).unionByName(carried.where(F.col("k") < months))
    changes = sold.groupBy("customer_id", "k").agg(
        F.sum("frequency").alias("frequency"), F.sum("monetary").alias("monetary"), F.max("last").alias("last")
    )
    customer = Window.partitionBy("customer_id").orderBy("k")
    so_far = customer.rowsBetween(Window.unboundedPreceding, 0)
    return changes.select(
        "customer_id",
        F.col("k").alias("since"),
        F.lead("k", 1, months).over(customer).alias("until"),
        F.sum("frequency").over(so_far).alias("frequency"),
        F.sum("monetary").over(so_far).cast(MONEY).alias("monetary"),
        F.max("last").over(so_far).alias("last"),
    )


def _no_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "customer_id bigint, since int, until int, frequency bigint, monetary decimal(18,2), last date",
    )


def repeated(states: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per state and snapshot that it lasts for: a projection, without a shuffle."""
    rows = states.withColumn("k", F.explode(F.sequence("since", F.col("until") - 1)))
    return rows.join(calendar.select("k", "snapshot_date"), "k").select(
        "snapshot_date",
        "customer_id",
        (F.datediff("snapshot_date", "last") + 1).alias("recency"),
        "frequency",
        "monetary",
    )


def by_snapshot(states: DataFrame, block: int = BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """The states of a stored table, dealt for a write partitioned by snapshot.

    A state is cut where a block of snapshots ends, and the pieces are dealt by block and
    customer. So states are shuffled instead of their rows, a task writes the files of few
    snapshots, and what it sorts by snapshot for that is bounded whatever the size of the history.
    """
    rows = states.agg(F.coalesce(F.sum(F.col("until") - F.col("since")), F.lit(0))).first()[0]
    cores = states.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-rows // task_rows), min(cores, rows // FEW))

    def number(k):
        return F.floor(k / block).cast("int")

    pieces = states.withColumn("block", F.explode(F.sequence(number(F.col("since")), number(F.col("until") - 1))))
    return (
        pieces.withColumns(
            {
                "since": F.greatest("since", F.col("block") * block),
                "until": F.least("until", (F.col("block") + 1) * block),
            }
        )
        .repartitionByRange(tasks, "block", "customer_id")
        .select(*states.columns)
    )


def history_starts(base: DataFrame, small: int = SMALL) -> list[RankedRow]:
    return quintile_starts(base, ("snapshot_date",), small=small)


def history_scores(base: DataFrame, starts: list[RankedRow]) -> DataFrame:
    """Scores, segment and macro segment per snapshot and customer; a projection of ``base``."""
    scored = with_segments(with_scores(base, starts, ("snapshot_date",)))
    return scored.withColumn("macro_segment", macro_of(F.col("rfm_segment"))).select(
        "snapshot_date",
        "customer_id",
        "recency",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        "rfm_segment",
        "macro_segment",
    )
