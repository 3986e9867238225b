"""Tables over the scored customers: one row per segment, score pair or bin.

Shares of the total are taken with a window over the aggregated rows; there are at most
as many of those as there are segments or bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bins import frequency_bin, monetary_bin, recency_bin
from ..functions.exact import MONEY, average, average_money, cents, percent

ROWS = "*"


def share_of_total(column: str, places: int = 1, as_cents: bool = False) -> Column:
    part = cents(F.col(column)) if as_cents else F.col(column)
    return percent(part, F.sum(part).over(Window.partitionBy()), places)


def segment_distribution(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy(F.col("rfm_segment").alias("segment"))
        .agg(
            F.count(ROWS).alias("n"),
            average_money("monetary", 0).alias("avg_monetary"),
            average("recency", 1).alias("avg_recency"),
            average("frequency", 1).alias("avg_frequency"),
        )
        .orderBy(F.desc("n"), "segment")
    )


def segment_kpi_table(enriched: DataFrame) -> DataFrame:
    totals = enriched.groupBy("segment_label").agg(
        F.max("macro_segment").alias("macro_segment"),
        F.count(ROWS).alias("total_users"),
        F.sum("monetary").alias("revenue"),
        F.sum("frequency").alias("tx"),
        average("recency", 0).cast("int").alias("avg_recency"),
        average("frequency", 1).alias("avg_frequency"),
        average_money("monetary", 0).alias("avg_monetary"),
    )
    return totals.select(
        "segment_label",
        "macro_segment",
        "total_users",
        share_of_total("total_users").alias("pct_users"),
        share_of_total("revenue", as_cents=True).alias("pct_revenue"),
        share_of_total("tx").alias("pct_tx"),
        "avg_recency",
        "avg_frequency",
        "avg_monetary",
    ).orderBy("segment_label")


def bubble_segments(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("segment_label")
        .agg(
            average("recency", 0).cast("int").alias("adslt"),
            F.sum("monetary").cast(MONEY).alias("total_revenue"),
            F.count(ROWS).alias("total_users"),
        )
        .orderBy("segment_label")
    )


def rf_heatmap(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("r_score", "f_score")
        .agg(F.count(ROWS).alias("count"))
        .orderBy("r_score", "f_score")
    )


def all_segments(customers: DataFrame) -> DataFrame:
    return customers.select("rfm_segment").distinct().orderBy("rfm_segment")


def monetary_by_segment(customers: DataFrame) -> DataFrame:
    """The full distribution by segment; the finer order lets one segment span many tasks."""
    return customers.orderBy("rfm_segment", "monetary", "customer_id").select(
        F.col("rfm_segment").alias("segment"), "monetary"
    )


def distribution(customers: DataFrame, dimension: str) -> DataFrame:
    return customers.select(dimension).where(F.col(dimension).isNotNull())


def recency_bins(customers: DataFrame) -> DataFrame:
    binned = customers.groupBy(recency_bin(F.col("recency")).alias("bin_label")).agg(
        F.count(ROWS).alias("users"), average("recency", 0).cast("int").alias("avg_metric")
    )
    return binned.select(
        "bin_label", "users", share_of_total("users").alias("pct_users"), "avg_metric"
    ).orderBy("bin_label")


def frequency_bins(customers: DataFrame, visits: DataFrame) -> DataFrame:
    """Share of customers and of their invoices, the invoices counted anew from the sales."""
    invoices = visits.groupBy("customer_id").agg(F.count_if("opens").alias("tx"))
    binned = (
        customers.select("customer_id", frequency_bin(F.col("frequency")).alias("bin_label"))
        .join(invoices, "customer_id", "left")
        .groupBy("bin_label")
        .agg(F.count(ROWS).alias("users"), F.coalesce(F.sum("tx"), F.lit(0)).alias("tx"))
    )
    return binned.select(
        "bin_label",
        "users",
        share_of_total("users").alias("pct_users"),
        share_of_total("tx").alias("avg_metric"),
    ).orderBy("bin_label")


def monetary_bins(customers: DataFrame) -> DataFrame:
    binned = customers.groupBy(monetary_bin(F.col("monetary")).alias("bin_label")).agg(
        F.count(ROWS).alias("users"), F.sum("monetary").alias("revenue")
    )
    return binned.select(
        "bin_label",
        "users",
        share_of_total("users").alias("pct_users"),
        share_of_total("revenue", as_cents=True).alias("avg_metric"),
    ).orderBy("bin_label")


def top_customers(
    customers: DataFrame, segments: list[str] | None = None, limit: int = 500
) -> DataFrame:
    """Customers with the highest amount; no segments means no filter."""
    chosen = customers.where(F.col("rfm_segment").isin(*segments)) if segments else customers
    return (
        chosen.select(
            "customer_id", "recency", "frequency", "monetary", F.col("rfm_segment").alias("segment")
        )
        .orderBy(F.desc("monetary"), "customer_id")
        .limit(limit)
    )


def parse_segments(text: str | None) -> list[str]:
    """Segment filter from a comma-separated parameter."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def scatter_sample(enriched: DataFrame, limit: int = 1500) -> DataFrame:
    """Exactly ``limit`` customers with an amount, picked by the digest of their id: as even
    as a random order, but the same on every run."""
    return (
        enriched.where(F.col("monetary") > 0)
        .select("customer_id", "recency", "monetary", "segment_label")
        .orderBy(F.md5(F.col("customer_id").cast("string").cast("binary")), "customer_id")
        .limit(limit)
    )


def cohort_pivot(first_purchases: DataFrame, customers: DataFrame) -> DataFrame:
    """Per acquisition month the share of customers now in each macro segment."""

    def share(macro: str) -> Column:
        return percent(F.count_if(F.col("macro_segment") == macro), F.count(ROWS), 1)

    return (
        first_purchases.join(customers.select("customer_id", "macro_segment"), "customer_id")
        .groupBy("acquisition_month")
        .agg(
            F.count(ROWS).alias("user_acquisitions"),
            share("A.LOYAL").alias("pct_loyal"),
            share("B.PROMISING").alias("pct_promising"),
            share("C.SLEEP").alias("pct_sleep"),
            share("D.LOST").alias("pct_lost"),
        )
        .orderBy("acquisition_month")
    )
