"""One-row key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exact import MONEY, average, average_money, cents, count_where, percent, ratio
from ..operators.stats import quantiles

ROWS = "*"


def share_where(condition: Column, places: int = 0) -> Column:
    return percent(count_where(condition), F.count(ROWS), places)


def kpis(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count(ROWS).alias("total_customers"),
        average("recency", 1).alias("avg_recency"),
        average_money("monetary", 0).alias("avg_monetary"),
        F.count_distinct("rfm_segment").alias("n_segments"),
    )


def kpi_bar(raw: DataFrame, visits: DataFrame, customers: DataFrame) -> DataFrame:
    """Volumes, revenue and customer rates; zeros on empty tables."""
    days, invoices = F.col("recency"), F.col("frequency")
    volumes = visits.agg(
        F.sum("lines").alias("total_clean_lines"),
        F.count_distinct("invoice_id").alias("total_transactions"),
        F.sum("amount").cast(MONEY).alias("total_net_revenue"),
    )
    rates = customers.agg(
        F.count(ROWS).alias("total_users"),
        average("recency", 0).cast("int").alias("adslt"),
        average("frequency", 1).alias("atpu"),
        average_money("monetary", 0).alias("arpu"),
        share_where((invoices == 1) & (days <= 90)).alias("pct_new"),
        share_where((invoices > 1) & (days <= 180)).alias("pct_returning"),
        share_where(days > 180).alias("pct_churned"),
    )
    # three one-row aggregates side by side
    row = rates.select(
        raw.agg(F.count(ROWS)).scalar().alias("total_raw_lines"),
        volumes.select(F.struct("*")).scalar().alias("volumes"),
        "*",
    )
    names = ("total_clean_lines", "total_users", "total_transactions", "total_net_revenue")
    flat = row.select(
        "total_raw_lines",
        *[F.col(n if n == "total_users" else f"volumes.{n}").alias(n) for n in names],
        *[c for c in rates.columns if c not in names],
    )
    return flat.select(*[F.coalesce(c, F.lit(0)).cast(t).alias(c) for c, t in flat.dtypes])


def recency_kpis(customers: DataFrame) -> DataFrame:
    """Mean recency is cut to whole days here, while the KPI bar rounds it."""
    days = F.col("recency")
    return customers.agg(
        F.call_function("div", F.sum(days), F.count(days)).cast("int").alias("mean_recency"),
        share_where(days <= 7).alias("pct_recent"),
        share_where(days > 180).alias("pct_churned"),
    )


def frequency_kpis(customers: DataFrame) -> DataFrame:
    invoices = F.col("frequency")
    return customers.agg(
        average("frequency", 1).alias("mean_frequency"),
        share_where(invoices == 1).alias("pct_one_timers"),
        share_where(invoices >= 11).alias("pct_frequent"),
    )


def monetary_kpis(customers: DataFrame) -> DataFrame:
    """Mean, exact median and share above 3000. ``customers`` must be a stored table."""
    median = quantiles(customers, {"monetary": cents(F.col("monetary"))}, (50,))
    row = median.get(("monetary", ()), {})
    value = row.get(50)
    return customers.agg(
        average_money("monetary", 0).alias("mean_monetary"),
        F.lit(None if value is None else value / 100).cast("decimal(18,4)").alias("median"),
        share_where(F.col("monetary") > 3000).alias("pct_high_value"),
    ).select(
        "mean_monetary", F.round("median", 0).cast(MONEY).alias("median_monetary"), "pct_high_value"
    )


def glossary_metrics(visits: DataFrame, customers: DataFrame) -> DataFrame:
    """Average transaction value, one-timers and top spenders."""
    basket = visits.agg(
        ratio(cents(F.sum("amount")), F.count_distinct("invoice_id") * 100, 2)
    ).scalar()
    return customers.agg(
        share_where(F.col("frequency") == 1, 1).alias("pct_one_timers"),
        share_where(F.col("m_score") == 5, 1).alias("pct_top_spenders"),
    ).select(basket.alias("atv"), "pct_one_timers", "pct_top_spenders")
