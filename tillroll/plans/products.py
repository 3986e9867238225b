"""Sales by product and by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exact import MONEY


def top_products_by_segment(
    sales: DataFrame,
    enriched: DataFrame,
    top_n: int = 5,
) -> DataFrame:
    """Best-selling products of every segment.

    The lines are summed per customer and product before the join, so a customer with a
    large part of all lines brings only its distinct products to the join's partition.
    """
    labels = enriched.select("customer_id", "segment_label")
    product = ["stock_code", "description"]
    bought = sales.groupBy("customer_id", *product).agg(F.sum("line_amount").alias("amount"))
    revenue = (
        bought.join(labels, "customer_id")
        .groupBy("segment_label", *product)
        .agg(F.sum("amount").cast(MONEY).alias("revenue"))
    )
    best = Window.partitionBy("segment_label").orderBy(
        F.desc("revenue"), F.asc_nulls_last("stock_code"), F.asc_nulls_last("description")
    )
    return (
        revenue.withColumn("rk", F.row_number().over(best))
        .where(F.col("rk") <= top_n)
        .select("segment_label", "stock_code", "description", "revenue")
        .orderBy("segment_label", F.desc("revenue"), "stock_code", "description")
    )


def monthly_revenue(visits: DataFrame) -> DataFrame:
    return (
        visits.groupBy(F.trunc("sale_date", "month").alias("month"))
        .agg(
            F.sum("amount").cast(MONEY).alias("revenue"),
            F.count_distinct("invoice_id").alias("n_invoices"),
            F.count_distinct("customer_id").alias("n_customers"),
        )
        .orderBy("month")
    )


def acquisitions_trend(first_purchases: DataFrame) -> DataFrame:
    return (
        first_purchases.groupBy("acquisition_month")
        .agg(F.count(F.lit(1)).alias("user_acquisitions"))
        .orderBy("acquisition_month")
    )
