"""Recency, frequency and monetary value per customer, their quintiles and segments."""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import label_of, macro_of, segment_of
from ..functions.exact import MONEY, cents
from .ranks import SMALL, RankedRow, bucket_starts, rows_at_ranks

BUCKETS = 5


class NoSales(ValueError):
    """Raised instead of scoring an empty sales table."""


def require_sales(visits: DataFrame) -> None:
    if visits.isEmpty():
        raise NoSales("there are no sales to score")


def rfm_base(visits: DataFrame) -> DataFrame:
    """Per customer: days since the last sale (as of the day after the last sale of all),
    number of invoices, amount."""
    as_of = visits.agg(F.date_add(F.max("sale_date"), 1)).scalar()
    return (
        visits.groupBy("customer_id")
        .agg(
            F.max("sale_date").alias("last"),
            F.count_if("opens").alias("frequency"),
            F.sum("amount").cast(MONEY).alias("monetary"),
        )
        .select(
            "customer_id", F.datediff(as_of, "last").alias("recency"), "frequency", "monetary"
        )
    )


def measures() -> dict[str, Column]:
    return {"r": F.col("recency"), "f": F.col("frequency"), "m": cents(F.col("monetary"))}


def quintile_starts(
    base: DataFrame, groups: tuple[str, ...] = (), small: int = SMALL
) -> list[RankedRow]:
    """First customer of the second to fifth quintile of every measure (and group).

    ``base`` must be a stored table: it is read once per narrowing round.
    """
    return rows_at_ranks(
        base, measures(), bucket_starts(BUCKETS), groups, tie="customer_id", small=small
    )


def with_scores(
    base: DataFrame, starts: list[RankedRow], groups: tuple[str, ...] = ()
) -> DataFrame:
    """Add r/f/m scores: a customer's quintile is how many starts are not after it.

    Ungrouped, the starts are literals and this is a projection. Grouped, they are one
    broadcast row per group.
    """
    by_group: dict[tuple, dict[str, list[RankedRow]]] = defaultdict(lambda: defaultdict(list))
    for row in starts:
        by_group[row.group][row.measure].append(row)

    names = [f"_{m}{j}_{part}" for m in "rfm" for j in range(BUCKETS - 1) for part in ("v", "t")]
    flat = {
        group: [
            bound
            for m in "rfm"
            for bound in _padded(sorted(rows[m], key=lambda row: row.rank))
        ]
        for group, rows in by_group.items()
    }
    if groups:
        columns = {g: [group[i] for group in flat] for i, g in enumerate(groups)}
        for i, name in enumerate(names):
            columns[name] = pa.array([bounds[i] for bounds in flat.values()], pa.int64())
        table = base.sparkSession.createDataFrame(pa.table(columns))
        # one row per group; a group of one row has no starts and keeps quintile one
        frame = base.join(F.broadcast(table), list(groups), "left")
        start = {name: F.col(name) for name in names}
    else:
        frame = base
        bounds = flat.get((), [None] * len(names))
        start = {name: F.lit(b).cast("bigint") for name, b in zip(names, bounds)}

    def quintile(measure: str) -> Column:
        value, tie = measures()[measure].cast("bigint"), F.col("customer_id")
        reached = F.lit(1)
        for j in range(BUCKETS - 1):
            v, t = start[f"_{measure}{j}_v"], start[f"_{measure}{j}_t"]
            at_or_after = (value > v) | ((value == v) & (tie >= t))
            reached = reached + F.coalesce(at_or_after, F.lit(False)).cast("int")
        return reached

    return frame.select(
        *base.columns,
        (BUCKETS + 1 - quintile("r")).alias("r_score"),
        quintile("f").alias("f_score"),
        quintile("m").alias("m_score"),
    )


def _padded(rows: list[RankedRow]) -> list[int | None]:
    flat = [bound for row in rows for bound in (row.value, row.tie)]
    return flat + [None] * (2 * (BUCKETS - 1) - len(flat))


def with_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn(
        "rfm_segment", segment_of(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    )


def enriched(customers: DataFrame) -> DataFrame:
    """Scored customers with display label and macro segment."""
    return customers.withColumns(
        {
            "segment_label": label_of(F.col("rfm_segment")),
            "macro_segment": macro_of(F.col("rfm_segment")),
        }
    )


def score_customers(base: DataFrame, small: int = SMALL) -> DataFrame:
    """Scores and segments over a stored ``rfm_base``."""
    return with_segments(with_scores(base, quintile_starts(base, small=small)))


def code_coverage(customers: DataFrame) -> DataFrame:
    """All 125 score codes with their segment and macro segment, and the customers on each."""
    scores = customers.sparkSession.range(125).select(
        (F.floor(F.col("id") / 25) + 1).cast("int").alias("r"),
        (F.floor(F.col("id") / 5) % 5 + 1).cast("int").alias("f"),
        (F.col("id") % 5 + 1).cast("int").alias("m"),
    )
    codes = scores.select(
        "r",
        "f",
        "m",
        F.concat(*[F.col(c).cast("string") for c in "rfm"]).alias("code"),
        segment_of(F.col("r"), F.col("f"), F.col("m")).alias("rfm_segment"),
    ).withColumn("macro_segment", macro_of(F.col("rfm_segment")))
    held = (
        customers.groupBy(
            F.col("r_score").alias("r"), F.col("f_score").alias("f"), F.col("m_score").alias("m")
        )
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )
    return (
        codes.join(held, ["r", "f", "m"], "left")
        .withColumn("n_customers", F.coalesce("n_customers", F.lit(0).cast("bigint")))
        .orderBy(F.desc("r"), F.desc("f"), F.desc("m"))
    )
