"""Small summaries that can be stored and merged: quantiles per snapshot, distinct values, sets of codes.

Quantile sketches are made once per snapshot; any span of snapshots is answered from the stored
sketches alone. Distinct counts of all columns, and set comparisons, take one scan together.
The exact ways (``stats``, ``profiling``) stay; these trade a stated error for not reading rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exact import cents, count_where
from ..sources.schemas import RAW

#: Size of a quantile sketch, and the share of rows its ranks may be off by (measured below 0.004).
KLL_SIZE, RANK_ERROR = 800, 0.008
#: Size of a distinct sketch as a power of two, and the share it may be off by (five standard errors).
HLL_LOG, DISTINCT_ERROR = 14, 0.033
#: Size of a set sketch as a power of two; smaller sets are counted exactly.
THETA_LOG = 14
QUARTILES = (25, 50, 75)


def measures() -> dict[str, Column]:
    """What is sketched, as whole numbers."""
    return {
        "recency": F.col("recency").cast("long"),
        "frequency": F.col("frequency").cast("long"),
        "monetary": cents(F.col("monetary")),
    }


def snapshot_sketches(history: DataFrame, size: int = KLL_SIZE) -> DataFrame:
    """One row per snapshot: number of customers and a sketch of each measure; to be stored."""
    return history.groupBy("snapshot_date").agg(
        F.count("*").alias("n"),
        *(F.kll_sketch_agg_bigint(c, size).alias(name) for name, c in measures().items()),
    )


def span_quantiles(
    sketches: DataFrame, first: str | None = None, last: str | None = None, percents: tuple[int, ...] = QUARTILES
) -> DataFrame:
    """``(measure, percent, n, value)`` over all snapshots from ``first`` to ``last``, from the sketches."""
    span = sketches
    if first is not None:
        span = span.where(F.col("snapshot_date") >= F.lit(first).cast("date"))
    if last is not None:
        span = span.where(F.col("snapshot_date") <= F.lit(last).cast("date"))
    merged = span.agg(F.sum("n").alias("n"), *(F.kll_merge_agg_bigint(m).alias(m) for m in measures()))
    return _asked(merged.where(F.col("n").isNotNull()), [], percents)


def snapshot_quantiles(sketches: DataFrame, percents: tuple[int, ...] = QUARTILES) -> DataFrame:
    """``(snapshot_date, measure, percent, n, value)`` of every snapshot."""
    return _asked(sketches, ["snapshot_date"], percents)


def _asked(sketches: DataFrame, keys: list[str], percents: tuple[int, ...]) -> DataFrame:
    asked = [
        F.struct(
            F.lit(m).alias("measure"), F.lit(p).alias("percent"),
            F.kll_sketch_get_quantile_bigint(m, F.lit(p / 100)).alias("value"),
        )
        for m in measures() for p in percents
    ]
    rows = sketches.select(*keys, "n", F.explode(F.array(*asked)).alias("a"))
    return rows.select(*keys, "a.measure", "a.percent", "n", "a.value")


def rank_errors(history: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """``answers`` with ``rank_error``: how far, as a share of the rows, the value's true ranks are from
    the wanted one. ``answers`` are few: snapshots x measures x percents at most, and are broadcast."""
    each = F.array(*(F.struct(F.lit(m).alias("measure"), c.alias("v")) for m, c in measures().items()))
    values = history.select(*keys, F.explode(each).alias("m")).select(*keys, "m.*")
    counted = (
        values.join(F.broadcast(answers), [*keys, "measure"])
        .groupBy(*keys, "measure", "percent", "n", "value")
        .agg(count_where(F.col("v") < F.col("value")).alias("below"), count_where(F.col("v") <= F.col("value")).alias("upto"))
    )
    wanted = F.col("n") * F.col("percent") / 100
    off = F.greatest(F.col("below") - wanted, wanted - F.col("upto"), F.lit(0.0)) / F.col("n")
    return counted.withColumn("rank_error", off).drop("below", "upto")


def column_sketches(raw: DataFrame) -> DataFrame:
    """One row, one scan: number of values and a distinct sketch of every raw column."""
    return raw.agg(
        *(F.count(c).alias(f"{c}_n") for c in RAW.names),
        *(F.hll_sketch_agg(F.col(c).cast("string"), HLL_LOG).alias(f"{c}_sketch") for c in RAW.names),
    )


def approx_distinct(sketches: DataFrame) -> DataFrame:
    """``(column_name, non_null, n_distinct)``; rows of several loads' sketches are merged first."""
    merged = sketches.agg(
        *(F.sum(f"{c}_n").alias(f"{c}_n") for c in RAW.names),
        *(F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in RAW.names),
    )
    each = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"{c}_n").alias("non_null"),
            F.coalesce(F.hll_sketch_estimate(f"{c}_sketch"), F.lit(0)).alias("n_distinct"),
        )
        for c in RAW.names
    ]
    return merged.select(F.explode(F.array(*each)).alias("c")).select("c.*")


def distinct_within_error(raw: DataFrame, answers: DataFrame, error: float = DISTINCT_ERROR) -> DataFrame:
    """``(column_name, non_null, within_error)``: the estimates held against exact counts."""
    each = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in RAW.names))
    values = raw.select(F.explode(each).alias("x")).select("x.*").where(F.col("v").isNotNull())
    exact = values.groupBy("column_name", "v").agg(F.lit(1)).groupBy("column_name").agg(F.count("*").alias("exact"))
    joined = answers.join(exact, "column_name", "left")
    exact = F.coalesce("exact", F.lit(0))
    return joined.select(
        "column_name", "non_null", (F.abs(F.col("n_distinct") - exact) <= F.greatest(F.lit(1.0), exact * error)).alias("within_error")
    )


def code_sets(raw: DataFrame) -> DataFrame:
    """One row, one scan: set sketches of the codes of lines with and without a description; mergeable."""
    bare = F.col("description").isNull()
    return raw.agg(
        F.theta_sketch_agg(F.when(~bare, F.col("stock_code")), THETA_LOG).alias("described"),
        F.theta_sketch_agg(F.when(bare, F.col("stock_code")), THETA_LOG).alias("bare"),
    )


def approx_repair_codes(sets: DataFrame) -> DataFrame:
    """Codes without description that other lines describe, and those that none does."""
    return sets.select(
        F.theta_sketch_estimate("bare").alias("codes_total"),
        F.theta_sketch_estimate(F.theta_intersection("bare", "described")).alias("codes_recoverable"),
        F.theta_sketch_estimate(F.theta_difference("bare", "described")).alias("codes_lost"),
    )
