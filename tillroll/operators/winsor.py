"""Exact quantiles of any number of groups, and lines cut back to their product's quantile.

Equal values of a group are counted first. The counts are dealt by group and value and run up; the value
at which the running count reaches the wanted share of the group is its quantile (nearest rank). A hot
group is spread, no group's bounds go through the driver, and nothing is sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exact import MONEY, count_where
from ..sources.scratch import materialize
from .ordered import PART, ordered_parts, with_carried, within

Store = Callable[[DataFrame, str], DataFrame]
PERCENT = 99
MEASURES = {"quantity": "decimal(14,3)", "unit_price": "decimal(14,3)"}


def value_counts(frame: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """``(*keys, measure, value, n)`` of the values that are not null, dealt by group and value."""
    each = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).cast(t).alias("value")) for m, t in measures.items()))
    counts = (
        frame.select(*keys, F.explode(each).alias("m"))
        .select(*keys, "m.*")
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "measure", "value")
        .agg(F.count("*").alias("n"))
    )
    return ordered_parts(counts, [*keys, "measure"], ["value"])


def group_quantiles(stored: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """``(*keys, measure, n_values, bound)`` from stored ``value_counts``: the smallest value that
    at least ``percent`` in a hundred of the group's values don't exceed. Null keys are a group."""
    # nulls never meet in a join; a flag and a stand-in take their place
    named = stored
    flags = []
    for key in keys:
        flags.append(f"no_{key}")
        named = named.withColumn(f"no_{key}", F.col(key).isNull()).withColumn(key, F.coalesce(key, F.lit("")))
    by = [*keys, *flags, "measure"]
    until = within(by, ["value"])
    whole = Window.partitionBy(PART, *by)
    local = named.withColumns({"upto": F.sum("n").over(until), "here": F.sum("n").over(whole)})

    def carried(parts: DataFrame, before, behind) -> DataFrame:
        return parts.withColumns({"n_before": F.sum("rows").over(before), "n_behind": F.sum("rows").over(behind)})

    zero = F.lit(0)
    joined = with_carried(local, by, {"rows": F.sum("n")}, carried)
    before = F.coalesce("n_before", zero)
    total = before + F.col("here") + F.coalesce("n_behind", zero)
    upto = before + F.col("upto")
    reached = (upto * 100 >= total * percent) & ((upto - F.col("n")) * 100 < total * percent)
    return joined.where(reached).select(
        *(F.when(~F.col(f"no_{k}"), F.col(k)).alias(k) for k in keys),
        "measure", total.alias("n_values"), F.col("value").alias("bound"),
    )


def product_bounds(sales: DataFrame, percent: int = PERCENT, store: Store = materialize) -> DataFrame:
    """``(stock_code, n_lines, quantity_bound, price_bound)``: the percentile of every product."""
    stored = store(value_counts(sales, ["stock_code"], MEASURES), "product_value_counts")
    bounds = group_quantiles(stored, ["stock_code"], percent)
    by = bounds.groupBy("stock_code")
    of = lambda m: F.max(F.when(F.col("measure") == m, F.col("bound")))
    return by.agg(
        F.max("n_values").alias("n_lines"),
        of("quantity").cast("int").alias("quantity_bound"),
        of("unit_price").cast("decimal(10,3)").alias("price_bound"),
    )


def winsorised(sales: DataFrame, bounds: DataFrame) -> DataFrame:
    """The sales lines with quantity and price cut back to their product's bound, the amount that
    follows, and whether anything was cut. No line is dropped."""
    joined = sales.join(bounds.drop("n_lines"), "stock_code")
    quantity, price = F.least("quantity", "quantity_bound"), F.least("unit_price", "price_bound")
    return joined.select(
        *sales.columns,
        quantity.alias("quantity_capped"),
        price.alias("unit_price_capped"),
        (quantity * price).cast("decimal(12,2)").alias("line_amount_capped"),
        ((F.col("quantity") > quantity) | (F.col("unit_price") > price)).alias("is_capped"),
    )


def winsorised_products(lines: DataFrame) -> DataFrame:
    """Per product: lines, lines cut back, and its revenue before and after."""
    return lines.groupBy("stock_code").agg(
        F.count("*").alias("n_lines"),
        count_where(F.col("is_capped")).alias("n_capped"),
        F.sum("line_amount").cast(MONEY).alias("revenue"),
        F.sum("line_amount_capped").cast(MONEY).alias("revenue_capped"),
    )
