"""Data-quality checks as rows, and gates that stop a run.

All single-table metrics of a suite are one aggregation; only a duplicate check needs a
shuffle of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.exact import count_where
from ..sources.scratch import materialize

VALUE = "decimal(24,4)"


class GateFailed(RuntimeError):
    """A gate found failing checks."""


@dataclass(frozen=True)
class Check:
    """A metric and the comparison it has to pass."""

    name: str
    metric: Column | tuple[str, ...]  # an aggregate, or the key of a duplicate count
    threshold: str
    passes: Callable[[Column], Column]
    exact: Column | None = None  # an aggregate to compare where the shown one is rounded


def _at_least(x):
    return f">= {x}", lambda v: v >= x


def _at_most(x):
    return f"<= {x}", lambda v: v <= x


def _more_than(x):
    return f"> {x}", lambda v: v > x


def _less_than(x):
    return f"< {x}", lambda v: v < x


def _equal(x):
    return f"= {x}", lambda v: v == x


def row_count(low: int, high: int) -> Check:
    return Check(
        "row_count", F.count(F.lit(1)), f"between {low} and {high}", lambda v: v.between(low, high)
    )


def missing_count(column: str) -> Check:
    return Check(f"missing_count({column})", count_where(F.col(column).isNull()), *_equal(0))


def missing_percent(column: str, below: int) -> Check:
    missing, rows = count_where(F.col(column).isNull()), F.count(F.lit(1))
    share = F.try_divide(missing.cast("decimal(20,0)") * 100, rows)
    return Check(
        f"missing_percent({column})",
        F.round(share, 4),
        f"< {below}",
        lambda over: over < 0,
        exact=missing * 100 - rows * below,
    )


def duplicate_count(*columns: str, below: int | None = None) -> Check:
    """Number of key values that occur more than once; keys with a NULL do not count."""
    bound = _equal(0) if below is None else _less_than(below)
    return Check(f"duplicate_count({', '.join(columns)})", tuple(columns), *bound)


def min_more_than(column: str, bound) -> Check:
    return Check(f"min({column})", F.min(column), *_more_than(bound))


def min_at_least(column: str, bound) -> Check:
    return Check(f"min({column})", F.min(column), *_at_least(bound))


def max_at_most(column: str, bound) -> Check:
    return Check(f"max({column})", F.max(column), *_at_most(bound))


def invalid_by_pattern(column: str, pattern: str) -> Check:
    bad = ~F.col(column).rlike(pattern)  # a NULL is missing, not invalid
    return Check(f"invalid_count({column})", count_where(bad), *_equal(0))


def invalid_by_values(column: str, *forbidden: str) -> Check:
    return Check(
        f"invalid_count({column})", count_where(F.col(column).isin(*forbidden)), *_equal(0)
    )


# The expectations of the retail dataset.
def raw_suite() -> list[Check]:
    return [
        row_count(1060000, 1075000),
        *[missing_count(c) for c in ("invoice", "stock_code", "quantity", "price")],
        missing_percent("customer_id", 25),
        missing_percent("description", 1),
        duplicate_count("invoice", "stock_code", "customer_id", "quantity", below=50000),
    ]


def sales_suite() -> list[Check]:
    return [
        row_count(750000, 850000),
        missing_count("customer_id"),
        missing_count("invoice_id"),
        min_more_than("quantity", 0),
        min_more_than("unit_price", 0),
        invalid_by_pattern("invoice_id", r"\A[0-9]+\z"),
    ]


def stock_movements_suite() -> list[Check]:
    return [row_count(4000, 5000)]


def cancellations_suite() -> list[Check]:
    return [row_count(18000, 21000)]


def customer_rfm_suite() -> list[Check]:
    scores = [
        check
        for c in ("r_score", "f_score", "m_score")
        for check in (min_at_least(c, 1), max_at_most(c, 5))
    ]
    return [
        row_count(5500, 5943),
        duplicate_count("customer_id"),
        *scores,
        invalid_by_values("rfm_segment", "TBD"),
        min_more_than("monetary", 0),
    ]


def coverage_suite() -> list[Check]:
    return [
        row_count(125, 125),
        invalid_by_values("rfm_segment", "Unclassified"),
        invalid_by_values("macro_segment", "Z.UNCLASSIFIED"),
    ]


def classified_suite() -> list[Check]:
    return [
        invalid_by_values("rfm_segment", "Unclassified"),
        invalid_by_values("macro_segment", "Z.UNCLASSIFIED"),
    ]


SCORED = ("customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_segment")


def sales_constraints() -> list[Check]:
    required = ("invoice_id", "stock_code", "quantity", "invoice_date", "unit_price", "customer_id")
    return [missing_count(c) for c in required]


def customer_constraints() -> list[Check]:
    return [*[missing_count(c) for c in SCORED], duplicate_count("customer_id")]


def history_constraints() -> list[Check]:
    required = ("snapshot_date", *SCORED, "macro_segment")
    return [
        *[missing_count(c) for c in required],
        duplicate_count("snapshot_date", "customer_id"),
    ]


def duplicated_keys(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: ``value``, the number of key values that occur more than once."""
    keys = frame.select(*columns).dropna("any")
    if isinstance(frame.schema[columns[-1]].dataType, T.LongType):
        keys = _in_doubt(keys, columns)
    return (
        keys.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("value"))
    )


def _in_doubt(keys: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The keys without those that are told to occur once by a bit each: 64 neighbouring ids share a row
    with the number of keys and the ids seen. Only where the ids are fewer are the keys counted singly."""
    *others, last = columns
    blocked = keys.withColumn("_block", F.shiftright(last, 6))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(last).bitwiseAND(63).cast("int"))
    seen = blocked.groupBy(*others, "_block").agg(F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("ids"))
    doubtful = materialize(seen.where(F.col("n") > F.bit_count("ids")).drop("n", "ids"), "doubtful_keys")
    return blocked.join(doubtful, [*others, "_block"], "left_semi").select(*columns)


def run_checks(dataset: str, frame: DataFrame, checks: list[Check]) -> DataFrame:
    """(dataset, check, value, threshold, passed), one row per check."""
    simple = [c for c in checks if not isinstance(c.metric, tuple)]
    keyed = [c for c in checks if isinstance(c.metric, tuple)]
    parts = []
    if simple:
        cells, results = [], []
        for i, check in enumerate(simple):
            cells.append(check.metric.cast(VALUE).alias(f"c{i}"))
            if check.exact is not None:
                cells.append(check.exact.alias(f"e{i}"))
            tested = F.col(f"c{i}" if check.exact is None else f"e{i}")
            results.append(_result(dataset, check, F.col(f"c{i}"), tested))
        row = frame.agg(*cells).select(F.explode(F.array(*results)).alias("r"))
        parts.append(row.select("r.*"))
    for check in keyed:
        counted = duplicated_keys(frame, check.metric)
        value = F.col("value").cast(VALUE)
        parts.append(counted.select(_result(dataset, check, value, value).alias("r")).select("r.*"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def run_suites(frame: DataFrame, key: str, suites: dict[str, list[Check]]) -> DataFrame:
    """As ``run_checks`` for several parts of one frame, told apart by ``key``, in one scan. Only
    checks of one aggregate each; a part without rows is checked as an empty frame."""
    cells, results = [], {}
    for part, checks in suites.items():
        results[part] = []
        for check in checks:
            if isinstance(check.metric, tuple):
                raise ValueError(f"{check.name} needs a scan of its own")
            value, tested = f"c{len(cells)}", f"c{len(cells) + 1}"
            shown = check.metric.cast(VALUE)
            cells += [shown.alias(value), (shown if check.exact is None else check.exact).alias(tested)]
            results[part].append(_result(part, check, F.col(f"m.{value}"), F.col(f"m.{tested}")))
    names = [f"c{i}" for i in range(len(cells))]
    present = frame.where(F.col(key).isin(*suites)).groupBy(key).agg(*cells).withColumn("there", F.lit(1))
    absent = frame.limit(0).agg(*cells).select(
        F.explode(F.array(*map(F.lit, suites))).alias(key), *names, F.lit(0).alias("there")
    )
    rows = present.unionByName(absent).groupBy(key).agg(F.max_by(F.struct(*names), "there").alias("m"))
    chain = F
    for part, own in results.items():
        chain = chain.when(F.col(key) == part, F.array(*own))
    return rows.select(F.explode(chain).alias("r")).select("r.*")


def _result(dataset: str, check: Check, value: Column, tested: Column) -> Column:
    # a metric without value (MIN of nothing) does not pass
    return F.struct(
        F.lit(dataset).alias("dataset"),
        F.lit(check.name).alias("check"),
        value.alias("value"),
        F.lit(check.threshold).alias("threshold"),
        F.coalesce(check.passes(tested), F.lit(False)).alias("passed"),
    )


def gate(dataset: str, frame: DataFrame, checks: list[Check]) -> list:
    """Run the checks now; raise when one fails. Returns the result rows, one per check."""
    results = run_checks(dataset, frame, checks).collect()
    failed = [r for r in results if not r["passed"]]
    if failed:
        raise GateFailed(
            "; ".join(f"{r['dataset']}: {r['check']} is {r['value']}, not {r['threshold']}" for r in failed)
        )
    return results
