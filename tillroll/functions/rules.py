"""Predicates of the cleaning cascade and of the stock-code audit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Stock codes that are no products, and prefixes of families of such codes.
NON_PRODUCT_CODES = (
    "POST",
    "DOT",
    "M",
    "BANK CHARGES",
    "AMAZONFEE",
    "ADJUST",
    "S",
    "D",
    "C2",
    "CRUK",
    "PADS",
)
NON_PRODUCT_FAMILIES = ("TEST", "gift_", "DCGS")

PLAIN_SKU_PATTERN = r"\A[0-9]+[A-Za-z]*\z"
VARIANT_SKU_PATTERN = r"\A[0-9]{5}[A-Za-z]\z"


def is_stock_movement() -> Column:
    return F.col("description").isNull() & F.col("customer_id").isNull() & (F.col("price") == 0)


def is_cancelled() -> Column:
    return F.col("invoice").startswith("C")


def is_non_product() -> Column:
    """Whole-code matches and families; plain comparisons, which the file scan understands."""
    code = F.col("stock_code")
    test = code.isin(*NON_PRODUCT_CODES)
    for prefix in NON_PRODUCT_FAMILIES:
        test = test | code.startswith(prefix)
    return test


def is_sale() -> Column:
    return (
        F.col("customer_id").isNotNull()
        & F.col("invoice_date").isNotNull()
        & ~is_cancelled()
        & (F.col("quantity") > 0)
        & (F.col("price") > 0)
        & ~is_non_product()
    )


def is_variant_sku() -> Column:
    return F.coalesce(F.col("stock_code").rlike(VARIANT_SKU_PATTERN), F.lit(False))


def is_lower_case(text: Column) -> Column:
    """At least one letter and no upper-case one."""
    return (F.lower(text) == text) & (F.upper(text) != text)
