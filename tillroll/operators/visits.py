"""Sales rolled up to one row per customer, invoice and day.

Recency, frequency and monetary value, the monthly history, first purchases and the
volume figures all need only this table, which is a fraction of the sales lines. An
invoice counts once per customer, from its first day: that day's row has ``opens`` set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exact import MONEY


def visits(sales: DataFrame) -> DataFrame:
    # combined map-side first, so a hot customer or invoice shrinks before the shuffle
    daily = sales.groupBy(
        "customer_id", "invoice_id", F.to_date("invoice_date").alias("sale_date")
    ).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("line_amount").cast(MONEY).alias("amount"),
    )
    return _opened(daily)


def _opened(daily: DataFrame) -> DataFrame:
    invoice = Window.partitionBy("customer_id", "invoice_id")
    return daily.withColumn("opens", F.col("sale_date") == F.min("sale_date").over(invoice))


def merged_visits(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """All visits of the invoices in ``fresh``, with what ``stored`` has of them."""
    touched = fresh.select("customer_id", "invoice_id").distinct()
    old = stored.join(touched, ["customer_id", "invoice_id"], "left_semi")
    columns = ("customer_id", "invoice_id", "sale_date", "lines", "amount")
    daily = old.select(*columns).unionByName(fresh.select(*columns)).groupBy(*columns[:3])
    return _opened(daily.agg(F.sum("lines").alias("lines"), F.sum("amount").cast(MONEY).alias("amount")))


def first_purchases(visits: DataFrame) -> DataFrame:
    first = F.min("sale_date")
    return visits.groupBy("customer_id").agg(
        first.alias("first_purchase_dt"),
        F.trunc(first, "month").alias("acquisition_month"),
    )
