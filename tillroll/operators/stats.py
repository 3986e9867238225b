"""Exact quantiles and box-plot statistics, found by rank instead of by collecting."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .ranks import SMALL, rows_at_ranks

QUARTILES = (25, 50, 75)
SIX_PLACES = "decimal(20,6)"


def _around(n: int, percents: tuple[int, ...]) -> list[int]:
    """Ranks on both sides of each quantile position (n - 1) * p / 100."""
    ranks = set()
    for p in percents:
        below = (n - 1) * p // 100
        ranks |= {below, min(below + 1, n - 1)}
    return sorted(ranks)


def quantiles(
    frame: DataFrame,
    measures: dict[str, Column],
    percents: tuple[int, ...],
    groups: tuple[str, ...] = (),
    weight: str | None = None,
    small: int = SMALL,
) -> dict[tuple, dict[int, Decimal]]:
    """Quantiles with linear interpolation, per (measure, group) and percent.

    The result is local, so the number of groups must be bounded. ``frame`` must be stored.
    """
    found: dict[tuple, dict[int, int]] = defaultdict(dict)
    size: dict[tuple, int] = {}

    def wanted(n: int) -> list[int]:
        # the extremes travel along, so the last rank tells the number of rows
        return sorted({*_around(n, percents), n - 1})

    for row in rows_at_ranks(frame, measures, wanted, groups, weight=weight, small=small):
        key = (row.measure, row.group)
        found[key][row.rank] = row.value
        size[key] = max(size.get(key, 0), row.rank + 1)
    result: dict[tuple, dict[int, Decimal]] = {}
    for key, values in found.items():
        result[key] = {}
        for p in percents:
            below, rest = divmod((size[key] - 1) * p, 100)
            low = values[below]
            high = values[min(below + 1, size[key] - 1)]
            result[key][p] = Decimal(low) + Decimal((high - low) * rest) / 100
    return result


def box_plot(
    frame: DataFrame,
    name: str,
    value: Column,
    scale: int = 1,
    group: str | None = None,
    small: int = SMALL,
) -> DataFrame:
    """Quartiles, 1.5-IQR fences, whisker ends and outlier count of a measure.

    ``value`` is a whole number, ``scale`` its units per reported unit (100 for cents).
    One row, or one per ``group`` (bounded number, NULL not expected).
    """
    groups = (group,) if group else ()
    quartiles = quantiles(frame, {name: value}, QUARTILES, groups, small=small)
    # in hundredths of the value's unit, so that interpolated quartiles stay whole numbers
    names = dict(zip(("q1", "median", "q3"), QUARTILES))
    rows = [
        (key[1], {label: int(q[p] * 100) for label, p in names.items()})
        for key, q in quartiles.items()
    ]
    spread = frame.where(value.isNotNull()).select(*groups, (value.cast("bigint") * 100).alias("x"))
    if groups:
        bounds = {g: pa.array([k[i] for k, _ in rows], pa.string()) for i, g in enumerate(groups)}
        bounds |= {label: pa.array([q[label] for _, q in rows], pa.int64()) for label in names}
        # one row per group
        table = F.broadcast(frame.sparkSession.createDataFrame(pa.table(bounds)))
        placed = spread.join(table, list(groups))
    else:
        only = rows[0][1] if rows else {}
        placed = spread.withColumns(
            {label: F.lit(only.get(label)).cast("bigint") for label in names}
        )
    # the fences are kept doubled for the same reason
    iqr = F.col("q3") - F.col("q1")
    placed = placed.withColumns(
        {
            "lower_fence": F.col("q1") * 2 - iqr * 3,
            "upper_fence": F.col("q3") * 2 + iqr * 3,
        }
    )
    inside = (F.col("x") * 2).between(F.col("lower_fence"), F.col("upper_fence"))
    kept = F.when(inside, F.col("x"))
    keys = (*groups, "q1", "median", "q3", "lower_fence", "upper_fence")
    summary = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("x").alias("min_value"),
        F.max("x").alias("max_value"),
        F.min(kept).alias("whisker_low"),
        F.max(kept).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )

    def units(column: str, halves: int = 1) -> Column:
        step = Decimal(1) / (100 * scale * halves)
        return (F.col(column).cast("decimal(20,0)") * F.lit(step)).cast(SIX_PLACES).alias(column)

    return summary.select(
        *groups,
        "n",
        *[units(c) for c in ("min_value", "q1", "median", "q3", "max_value")],
        *[units(c, halves=2) for c in ("lower_fence", "upper_fence")],
        *[units(c) for c in ("whisker_low", "whisker_high")],
        "n_outliers",
    )
