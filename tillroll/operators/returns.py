"""Cancellations linked to the invoices they cancel.

Sales and cancellations of one customer and stock code are brought into one order of time. A cancellation gives back
units sold before it, the earliest sold first, as far as they have not been given back; the
rest stays unlinked and never reaches a later sale. Units sold run up to S, units cancelled to C; the
units that found no sale so far are the largest C - S seen yet, so what has been given back is
known at every row without going through the rows one by one. Sales and cancellations are then intervals of
running units, cut at each other's ends: a piece between two ends belongs to the next sale and
the next cancellation. One cancellation may take from several sales, and several from one.

Nothing is joined in pairs, and a key with very many rows is spread (see ``ordered``).

Lines of one invoice, code, customer and time count as one. Cancellations without customer, code or time
have no sale; those that give back nothing (quantity null or not below zero) have no row. At one
time sales come before cancellations, and invoices in order of their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exact import count_where, percent
from ..sources.scratch import materialize
from .cleaning import bucket, sales
from .ordered import ordered_parts, with_carried, within

KEYS = ["customer_id", "stock_code"]
ORDER = ["happened_at", "is_return", "invoice"]
Store = Callable[[DataFrame, str], DataFrame]


def returned_lines(raw: DataFrame) -> DataFrame:
    """Units given back per cancellation invoice, customer, code and time."""
    lines = bucket(raw, "cancellations").where("quantity < 0")
    return (
        lines.groupBy(*KEYS, F.col("invoice_date").alias("happened_at"), "invoice")
        .agg(F.sum(-F.col("quantity").cast("long")).alias("units"))
    )


def sold_lines(raw: DataFrame) -> DataFrame:
    """Units sold per invoice, customer, code and time."""
    return (
        sales(raw)
        .groupBy(*KEYS, F.col("invoice_date").alias("happened_at"), F.col("invoice_id").alias("invoice"))
        .agg(F.sum(F.col("quantity").cast("long")).alias("units"))
    )


def events(sold: DataFrame, returned: DataFrame) -> DataFrame:
    """Sales and cancellations of the keys that have both kinds, dealt by key and time."""
    able = returned.where(F.col("customer_id").isNotNull() & F.col("stock_code").isNotNull() & F.col("happened_at").isNotNull())
    concerned = sold.join(able.select(*KEYS).distinct(), KEYS, "left_semi")
    both = concerned.withColumn("is_return", F.lit(0)).unionByName(able.withColumn("is_return", F.lit(1)))
    return ordered_parts(both, KEYS, ORDER)


def _of(kind: int) -> Column:
    return F.sum(F.when(F.col("is_return") == kind, F.col("units")).otherwise(0))


def balances(stored: DataFrame) -> DataFrame:
    """The events with ``given``, the units of a cancellation that are linked, and ``ends_at``, where
    the event ends in its key's running units (sold, or given back)."""
    until = within(KEYS, ORDER)
    short = F.col("returned") - F.col("sold")
    local = stored.withColumns({"sold": _of(0).over(until), "returned": _of(1).over(until)})
    local = local.withColumn("short", F.max(short).over(until))

    def carried(parts: DataFrame, before, behind) -> DataFrame:
        parts = parts.withColumns({
            "sold_before": F.coalesce(F.sum("all_sold").over(before), F.lit(0)),
            "returned_before": F.coalesce(F.sum("all_returned").over(before), F.lit(0)),
        })
        shifted = F.col("returned_before") - F.col("sold_before") + F.col("most_short")
        return parts.withColumn("short_before", F.max(shifted).over(before))

    totals = {"all_sold": _of(0), "all_returned": _of(1), "most_short": F.max("short")}
    joined = with_carried(local, KEYS, totals, carried)
    zero = F.lit(0)
    sold = F.col("sold") + F.coalesce("sold_before", zero)
    returned = F.col("returned") + F.coalesce("returned_before", zero)
    shift = F.coalesce(F.col("returned_before") - F.col("sold_before"), zero)
    local_before = F.max("short").over(within(KEYS, ORDER).rowsBetween(Window.unboundedPreceding, -1))
    joined = joined.withColumn("short_yet", local_before)
    unlinked_yet = F.greatest(zero, "short_before", shift + F.col("short_yet"))
    unlinked = F.greatest(unlinked_yet, shift + F.col("short"))
    own = unlinked - unlinked_yet  # what the event adds to the units without a sale
    given = F.when(F.col("is_return") == 1, F.col("units") - own)
    ends_at = F.when(F.col("is_return") == 1, returned - unlinked).otherwise(sold)
    return joined.select(*KEYS, *ORDER, "units", given.alias("given"), ends_at.alias("ends_at"))


def pieces(balanced: DataFrame) -> DataFrame:
    """The ends of sales and of linked cancellations, dealt by key and place."""
    ends = balanced.where("is_return = 0 OR given > 0")
    tag = F.struct("invoice", "happened_at")
    ends = ends.select(
        *KEYS, "ends_at", "is_return",
        F.when(F.col("is_return") == 0, tag).alias("sale"), F.when(F.col("is_return") == 1, tag).alias("cancellation"),
    )
    return ordered_parts(ends, KEYS, ["ends_at", "is_return"])


def linked(stored: DataFrame) -> DataFrame:
    """Units by sale and cancellation from the stored ends."""
    order = ["ends_at", "is_return"]
    behind_me = within(KEYS, order).rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def carried(parts: DataFrame, before, behind) -> DataFrame:
        return parts.withColumns({
            "ended_before": F.max("last_end").over(before),
            **{f"later_{k}": F.first(f"first_{k}", ignorenulls=True).over(behind) for k in ("sale", "cancellation")},
        })

    first = {f"first_{k}": F.min_by(k, F.when(F.col(k).isNotNull(), F.col("ends_at"))) for k in ("sale", "cancellation")}
    joined = with_carried(stored, KEYS, {"last_end": F.max("ends_at"), **first}, carried)
    begins = F.max("ends_at").over(within(KEYS, order).rowsBetween(Window.unboundedPreceding, -1))
    cut = joined.select(
        *KEYS,
        (F.col("ends_at") - F.coalesce(begins, "ended_before", F.lit(0))).alias("units"),
        *(
            F.coalesce(F.first(k, ignorenulls=True).over(behind_me), f"later_{k}").alias(k)
            for k in ("sale", "cancellation")
        ),
    )
    return cut.where("units > 0 AND sale IS NOT NULL AND cancellation IS NOT NULL")


def cancellation_links(raw: DataFrame, store: Store = materialize) -> DataFrame:
    """``(cancellation, cancelled_at, customer_id, stock_code, invoice, sold_at, units)``.

    One row per cancellation invoice and the invoice it takes units back from; ``invoice`` and
    ``sold_at`` are null for the units that no earlier sale accounts for. The units of a cancellation
    add up to what it gives back, and those of a sale never exceed what was sold.
    """
    returned = returned_lines(raw)
    balanced = store(balances(store(events(sold_lines(raw), returned), "return_events")), "return_balances")
    links = linked(store(pieces(balanced), "return_pieces"))
    found = links.select(
        F.col("cancellation.invoice").alias("cancellation"),
        F.col("cancellation.happened_at").alias("cancelled_at"),
        *KEYS,
        F.col("sale.invoice").alias("invoice"),
        F.col("sale.happened_at").alias("sold_at"),
        "units",
    )
    named = [F.col("invoice").alias("cancellation"), F.col("happened_at").alias("cancelled_at"), *KEYS]
    none = [F.lit(None).cast("string").alias("invoice"), F.lit(None).cast("timestamp_ntz").alias("sold_at")]
    short = balanced.where("is_return = 1 AND given < units").select(*named, *none, (F.col("units") - F.col("given")).alias("units"))
    unable = F.col("customer_id").isNull() | F.col("stock_code").isNull() | F.col("happened_at").isNull()
    return found.unionByName(short).unionByName(returned.where(unable).select(*named, *none, "units"))


def link_summary(links: DataFrame) -> DataFrame:
    """One row: cancellations, those with a link, and their units."""
    units = F.col("units")
    linked_ = F.col("invoice").isNotNull()
    counts = links.groupBy("cancellation", *KEYS).agg(
        F.max(linked_).alias("has_link"), F.sum(units).alias("units"), F.sum(F.when(linked_, units).otherwise(0)).alias("linked")
    )
    return counts.agg(
        F.count("*").alias("n_cancelled"),
        count_where(F.col("has_link")).alias("n_linked"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("units_cancelled"),
        F.coalesce(F.sum("linked"), F.lit(0)).alias("units_linked"),
    ).withColumn("pct_units_linked", percent(F.col("units_linked"), F.col("units_cancelled"), 2))


def net_sales(raw: DataFrame, links: DataFrame) -> DataFrame:
    """``(customer_id, stock_code, invoice, sold_at, units_sold, units_returned, units_kept)`` for
    every sale that a cancellation takes from."""
    taken = (
        links.where(F.col("invoice").isNotNull())
        .groupBy(*KEYS, "invoice", "sold_at")
        .agg(F.sum("units").alias("units_returned"))
    )
    sold = sold_lines(raw).select(*KEYS, "invoice", F.col("happened_at").alias("sold_at"), F.col("units").alias("units_sold"))
    return sold.join(taken, [*KEYS, "invoice", "sold_at"]).select(
        *KEYS, "invoice", "sold_at", "units_sold", "units_returned",
        (F.col("units_sold") - F.col("units_returned")).alias("units_kept"),
    )
