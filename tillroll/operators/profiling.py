"""Profile and audit of raw retail lines.

Counts of distinct values read one text column each; a line's numbers become one row each
before they are counted by value. Grouping keys are combined map-side, which takes the weight out
of a code, description or copy that makes up a large part of the lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exact import count_where, percent, ratio
from ..functions.rules import (
    PLAIN_SKU_PATTERN,
    is_cancelled,
    is_lower_case,
    is_variant_sku,
)
from ..sources.schemas import RAW
from ..sources.scratch import materialize
from .stats import quantiles

ROWS = "*"
Store = Callable[[DataFrame, str], DataFrame]
# places of the whole-number unit a numeric column is measured in
NUMERIC = {"quantity": 0, "price": 3, "customer_id": 0}
TEXT = ("invoice", "stock_code", "description", "country")


def column_profile(raw: DataFrame, store: Store = materialize) -> DataFrame:
    """(column_name, metric, value) with non-null and distinct count of every column, length
    range of texts, and range, mean, median and deviation of numbers.

    The lines are read once: every column's values are counted together and stored.
    """
    each = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("text"), F.lit(None).cast("bigint").alias("v"))
        for c in (*TEXT, "invoice_date")
    ]
    each += [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("text"),
            (F.col(c) * 10**places).cast("bigint").alias("v"),
        )
        for c, places in NUMERIC.items()
    ]
    values = store(
        raw.select(F.explode(F.array(*each)).alias("u"))
        .select("u.*")
        .where(F.coalesce("text", F.col("v").cast("string")).isNotNull())
        .groupBy("column_name", "text", "v")
        .agg(F.count(ROWS).alias("n")),
        "profile_values",
    )
    return _text_profile(values).unionByName(_number_profile(values.where(F.col("v").isNotNull())))


def _long(row: DataFrame, cells: dict[tuple[str, str], str]) -> DataFrame:
    """One wide row as (column_name, metric, value) rows."""
    parts = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(metric).alias("metric"),
            F.col(cell).cast("double").alias("value"),
        )
        for (column, metric), cell in cells.items()
    ]
    return row.select(F.explode(F.array(*parts)).alias("m")).select("m.*")


def _text_profile(values: DataFrame) -> DataFrame:
    aggregates, cells = [], {}
    for column in (*TEXT, "invoice_date"):
        here = F.col("column_name") == column
        text = F.when(here, F.col("text"))
        metrics = {"non_null": F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0)), "unique": F.count(text)}
        if column in TEXT:
            metrics |= {"min_length": F.min(F.length(text)), "max_length": F.max(F.length(text))}
        for name, metric in metrics.items():
            cells[column, name] = f"{column}_{name}"
            aggregates.append(metric.alias(f"{column}_{name}"))
    return _long(values.agg(*aggregates), cells)


def _number_profile(values: DataFrame) -> DataFrame:
    """All numeric columns from their stored values and counts. Deviations are summed from the rounded
    mean, so they stay exact for large numbers close together."""
    middles = quantiles(values, {"v": F.col("v")}, (50,), groups=("column_name",), weight="n")
    exact = F.col("v").cast("decimal(38,0)")
    means = {
        r["column_name"]: int(r["mean"])
        for r in values.groupBy("column_name")
        .agg(F.round(F.sum(exact * F.col("n")) / F.sum("n"), 0).cast("decimal(38,0)").alias("mean"))
        .collect()  # three columns
    }
    aggregates, cells = [], {}
    for column, places in NUMERIC.items():
        unit = 10**places
        here = F.col("column_name") == column
        v, n = F.when(here, F.col("v")), F.when(here, F.col("n"))
        whole = v.cast("decimal(38,0)")
        total, rows = F.sum(whole * n), F.sum(n)
        middle = middles.get(("v", (column,)), {}).get(50)
        off = (v - means.get(column, 0)).cast("double")
        inner = F.sum(off * off * n) - F.pow(F.sum(off * n), 2) / rows
        metrics = {
            "non_null": F.coalesce(rows, F.lit(0)),
            "unique": F.count(v),
            "min": F.min(v).cast("decimal(24,3)") / unit,
            "max": F.max(v).cast("decimal(24,3)") / unit,
            "mean": ratio(total, rows * unit, 2),
            "median": F.lit(None if middle is None else middle / unit).cast("decimal(38,6)"),
            "stddev": F.when(rows > 1, F.round(F.sqrt(inner / (rows - 1)) / unit, 2)),
        }
        for name, metric in metrics.items():
            cells[column, name] = f"{column}_{name}"
            aggregates.append(metric.alias(f"{column}_{name}"))
    return _long(values.agg(*aggregates), cells)


def missing_by_column(raw: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, in one pass."""
    row = raw.agg(
        F.count(ROWS).alias("rows"),
        *[count_where(F.col(c).isNull()).alias(c) for c in RAW.names],
    )
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in RAW.names]
    return row.select("rows", F.explode(F.array(*pairs)).alias("m")).select(
        "m.column_name",
        "m.missing",
        percent(F.col("m.missing"), F.col("rows"), 2).alias("pct_missing"),
    )


def date_span(raw: DataFrame) -> DataFrame:
    return raw.agg(F.min("invoice_date").alias("first"), F.max("invoice_date").alias("last"))


def null_profile(raw: DataFrame) -> DataFrame:
    """Lines per combination of missing description, missing customer and zero price."""
    return (
        raw.groupBy(
            F.col("description").isNull().alias("no_description"),
            F.col("customer_id").isNull().alias("no_customer"),
            F.coalesce(F.col("price") == 0, F.lit(False)).alias("zero_price"),
        )
        .agg(F.count(ROWS).alias("n"))
        .orderBy("no_description", "no_customer", "zero_price")
    )


def _described_codes(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("description").isNotNull()).select("stock_code").distinct()


def description_recoverable(raw: DataFrame) -> DataFrame:
    """Lines without description whose code is described on another line."""
    bare = raw.where(F.col("description").isNull())
    return bare.join(_described_codes(raw), "stock_code", "left_semi").select(*RAW.names)


def description_unrecoverable(raw: DataFrame) -> DataFrame:
    """Lines without description whose code is described nowhere."""
    bare = raw.where(F.col("description").isNull())
    return bare.join(_described_codes(raw), "stock_code", "left_anti").select(*RAW.names)


def description_repair_summary(raw: DataFrame) -> DataFrame:
    """Codes and lines that a lookup by code could repair, and those it could not.

    Both sides of the set comparison are counts of the same code, so one aggregation by
    code answers intersection and difference together.
    """
    codes = (
        raw.where(F.col("stock_code").isNotNull())
        .groupBy("stock_code")
        .agg(
            count_where(F.col("description").isNull()).alias("bare"),
            F.count("description").alias("described"),
        )
        .where(F.col("bare") > 0)
    )
    known = F.col("described") > 0
    counts = codes.agg(
        F.count(ROWS).alias("codes_total"),
        count_where(known).alias("codes_recoverable"),
        count_where(~known).alias("codes_lost"),
        *[
            F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name)
            for name, column in (
                ("lines_total", F.col("bare")),
                ("lines_recoverable", F.when(known, F.col("bare"))),
                ("lines_lost", F.when(~known, F.col("bare"))),
            )
        ],
    )
    return counts.withColumns(
        {
            "pct_codes_recoverable": percent(
                F.col("codes_recoverable"), F.col("codes_total"), 1
            ),
            "pct_lines_recoverable": percent(
                F.col("lines_recoverable"), F.col("lines_total"), 1
            ),
        }
    )


def quantity_anomalies(raw: DataFrame) -> DataFrame:
    """Cancelled lines, zero quantities, and negative ones with and without cancellation."""
    cancelled = F.coalesce(is_cancelled(), F.lit(False))
    negative = F.col("quantity") < 0
    return raw.agg(
        count_where(cancelled).alias("cancelled_lines"),
        count_where(F.col("quantity") == 0).alias("zero_quantity"),
        count_where(negative).alias("negative_quantity"),
        count_where(negative & cancelled).alias("negative_cancelled"),
        count_where(negative & ~cancelled).alias("negative_orphan"),
    )


def price_anomalies(raw: DataFrame) -> DataFrame:
    return raw.agg(
        count_where(F.col("price") == 0).alias("zero_price"),
        count_where(F.col("price") < 0).alias("negative_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


def negative_price_lines(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("price") < 0).select("invoice", "stock_code", "description", "price")


def _most_frequent(lines: DataFrame, column: str, limit: int) -> DataFrame:
    return (
        lines.groupBy(column)
        .agg(F.count(ROWS).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first(column))
        .limit(limit)
    )


def zero_price_descriptions(
    raw: DataFrame, limit: int = 10, include_missing: bool = False
) -> DataFrame:
    free = raw.where(F.col("price") == 0)
    if not include_missing:
        free = free.where(F.col("description").isNotNull())
    return _most_frequent(free, "description", limit)


def special_stock_codes(raw: DataFrame, limit: int = 20) -> DataFrame:
    """Most frequent codes that are not digits followed by letters."""
    plain = F.coalesce(F.col("stock_code").rlike(PLAIN_SKU_PATTERN), F.lit(False))
    return _most_frequent(raw.where(~plain), "stock_code", limit)


def alpha_stock_codes(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("stock_code").rlike("[a-zA-Z]")).select("stock_code").distinct()


def lowercase_descriptions(raw: DataFrame) -> DataFrame:
    return raw.where(is_lower_case(F.col("description"))).select("description").distinct()


def _family() -> Column:
    return F.substring("stock_code", 1, 5)


def sku_variant_summary(raw: DataFrame) -> DataFrame:
    """Codes of five digits and a letter: lines, codes, families and their sizes."""
    codes = (
        raw.groupBy("stock_code")
        .agg(F.count(ROWS).alias("n"))
        .withColumn("variant", is_variant_sku())
    )
    variant = F.col("variant")
    families = (
        codes.groupBy(F.when(variant, _family()).alias("family"))
        .agg(
            F.sum("n").alias("n"),
            F.count_if(variant).alias("codes"),
        )
    )
    in_family = F.col("family").isNotNull()
    lines = F.coalesce(F.sum(F.when(in_family, F.col("n"))), F.lit(0)).cast("bigint")
    return families.agg(
        lines.alias("variant_lines"),
        F.coalesce(F.sum("codes"), F.lit(0)).cast("bigint").alias("variant_codes"),
        count_where(in_family).alias("families"),
        ratio(F.sum("codes"), F.count("family"), 1).alias("codes_per_family"),
        percent(lines, F.sum("n"), 2).alias("pct_lines"),
    )


def sku_variant_letters(raw: DataFrame) -> DataFrame:
    return (
        raw.where(is_variant_sku())
        .groupBy(F.upper(F.substring("stock_code", 6, 1)).alias("letter"))
        .agg(F.count(ROWS).alias("n"))
        .orderBy(F.desc("n"), "letter")
    )


def sku_variants_of_root(raw: DataFrame, code: str, root_length: int = 5) -> DataFrame:
    """Codes that share the root of ``code``, one row per different description."""
    return (
        raw.where(F.col("stock_code").startswith(code[:root_length]))
        .groupBy("stock_code", "description")
        .agg(F.count(ROWS).alias("n"))
        .orderBy("stock_code", F.asc_nulls_first("description"))
    )


def repeated_lines(raw: DataFrame, store: Store = materialize) -> DataFrame:
    """Distinct lines that occur more than once, with their number of ``copies``.

    Equal lines have equal digests, so a digest seen once settles its line. Only digests are
    shuffled for all lines; whole lines only where a digest repeats. The repeated digests
    are stored, so that the join sees their true size and broadcasts them only if small.
    """
    digested = raw.select(*RAW.names, F.xxhash64(*RAW.names).alias("digest"))
    seen = digested.groupBy("digest").agg(F.count(ROWS).alias("n"))
    suspects = store(seen.where(F.col("n") > 1).select("digest"), "repeated_digests")
    return (
        digested.join(suspects, "digest", "left_semi")
        .groupBy(*RAW.names)
        .agg(F.count(ROWS).alias("copies"))
        .where(F.col("copies") > 1)
    )


def exact_duplicates_summary(raw: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Distinct lines occurring more than once, and lines beyond each first copy. ``repeated``: stored
    ``repeated_lines``, if there are."""
    repeated = repeated_lines(raw) if repeated is None else repeated
    extra = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint")
    counts = repeated.agg(
        F.count(ROWS).alias("duplicated_values"), extra.alias("extra_lines")
    )
    total = raw.agg(F.count(ROWS)).scalar().alias("total")
    return counts.select("*", total).select(
        "duplicated_values",
        "extra_lines",
        percent(F.col("extra_lines"), F.col("total"), 2).alias("pct_extra"),
    )


def exact_duplicates_sample(raw: DataFrame, limit: int = 10, repeated: DataFrame | None = None) -> DataFrame:
    """The first ``limit`` members of duplicate groups, every copy listed.

    Copies are adjacent in the order, so no group needs more than ``limit`` of them.
    """
    order = ["invoice", "stock_code", "customer_id"]
    order += [c for c in RAW.names if c not in order]
    by_all = [F.asc_nulls_last(c) for c in order]
    copy = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(limit)).cast("int")))
    return (
        (repeated_lines(raw) if repeated is None else repeated)
        .orderBy(*by_all)
        .limit(limit)
        .select(*RAW.names, copy.alias("copy"))
        .orderBy(*by_all, "copy")
        .limit(limit)
        .drop("copy")
    )


def country_distribution(raw: DataFrame, top: int = 10) -> DataFrame:
    """Lines and share of the largest countries, the rest in one row at the end.

    The windows run over one row per country.
    """
    by_size = Window.orderBy(F.desc("n"), F.asc_nulls_last("country"))
    everything = Window.partitionBy()
    counted = raw.groupBy("country").agg(F.count(ROWS).alias("n"))
    placed = counted.select(
        "country",
        "n",
        F.least(F.row_number().over(by_size), F.lit(top + 1)).alias("place"),
        F.sum("n").over(everything).alias("total"),
    )
    rest = F.col("place") > top
    return (
        placed.groupBy(
            F.when(rest, F.lit("others")).otherwise(F.col("country")).alias("country"),
            "place",
            "total",
        )
        .agg(F.sum("n").alias("n"))
        .select("place", "country", "n", percent(F.col("n"), F.col("total"), 2).alias("pct"))
        .orderBy("place")
    )
