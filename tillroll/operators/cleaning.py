"""Exclusive cleaning cascade over raw retail lines.

Every bucket's full predicate is spelled out, so a line whose test is unknown (NULL
price, invoice or code) falls through to ``rejected`` exactly as it would fail a WHERE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.exact import count_where, percent
from ..functions.rules import is_cancelled, is_non_product, is_sale, is_stock_movement
from ..sources.schemas import RAW

BUCKETS = ("stock_movements", "cancellations", "non_product_lines", "sales")
REJECTED = "rejected"


def bucket_tests():
    """Predicate of each bucket, in cascade order."""
    elsewhere = ~is_stock_movement()
    return {
        "stock_movements": is_stock_movement(),
        "cancellations": is_cancelled() & elsewhere,
        "non_product_lines": is_non_product() & ~is_cancelled() & elsewhere,
        "sales": is_sale(),
    }


def route(raw: DataFrame) -> DataFrame:
    """All raw lines with their ``bucket``, in one scan."""
    chain = F
    for name, test in bucket_tests().items():
        chain = chain.when(test, name)
    return raw.withColumn("bucket", chain.otherwise(REJECTED))


def bucket(raw: DataFrame, name: str) -> DataFrame:
    """Raw lines of one bucket; a plain filter, so its tests reach the file scan."""
    if name == REJECTED:
        return route(raw).where(F.col("bucket") == REJECTED).drop("bucket")
    return raw.where(bucket_tests()[name])


def as_sales(lines: DataFrame) -> DataFrame:
    """Rename to the sales schema and add the amount, rounded per line half away from zero."""
    return lines.select(
        F.col("invoice").alias("invoice_id"),
        "stock_code",
        "description",
        "quantity",
        "invoice_date",
        F.col("price").alias("unit_price"),
        "customer_id",
        "country",
        (F.col("quantity") * F.col("price")).cast("decimal(12,2)").alias("line_amount"),
    )


def sales(raw: DataFrame) -> DataFrame:
    return as_sales(bucket(raw, "sales"))


def bucket_counts():
    """Aggregates over a routed frame: lines in total and per bucket."""
    return [F.count(F.lit(1)).cast("bigint").alias("n_raw")] + [
        count_where(F.col("bucket") == name).alias(f"n_{name}") for name in BUCKETS
    ]


def audit(raw: DataFrame) -> DataFrame:
    """One row: raw lines, lines per bucket, routed, rejected and the rejected share."""
    counts = route(raw).agg(*bucket_counts())
    routed = sum((F.col(f"n_{name}") for name in BUCKETS[1:]), F.col(f"n_{BUCKETS[0]}"))
    return (
        counts.withColumn("n_total_routed", routed)
        .withColumn("n_rejected", F.col("n_raw") - F.col("n_total_routed"))
        .withColumn("pct_rejected", percent(F.col("n_rejected"), F.col("n_raw"), 2))
    )


def ingest_audit(raw: DataFrame, expected: int, tolerance: int) -> DataFrame:
    """One row: stored lines, type of the customer id, and whether the volume is as expected."""
    rows = F.count(F.lit(1)).cast("bigint")
    return raw.agg(
        rows.alias("rows_inserted"),
        F.count("customer_id").cast("bigint").alias("rows_with_customer"),
    ).select(
        "rows_inserted",
        "rows_with_customer",
        F.lit(raw.schema["customer_id"].dataType.simpleString()).alias("customer_id_type"),
        (F.abs(F.col("rows_inserted") - expected) <= tolerance).alias("volume_ok"),
    )


def side_buckets(raw: DataFrame) -> DataFrame:
    """The three buckets beside sales, with their name."""
    return (
        route(raw)
        .where(F.col("bucket").isin(*BUCKETS[:3]))
        .select(*RAW.names, "bucket")
    )
