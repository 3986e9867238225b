"""Exact rows at given ranks, without sorting the whole frame.

A quintile is decided by four rows: where the second to fifth bucket start. So instead of
ranking every customer, the rank is narrowed down: count the rows per slice of the value
range, keep the one slice that holds the wanted rank, slice that again, first by value and
then, inside one repeated value, by the tie-breaking id. Once a slice is small enough its
rows are numbered. The first slices come from a quantile sketch of each group, made in the pass that counts the
groups, and one more pass counts all measures' rows before and inside them exactly; a sketch that is off its wanted
rank is left aside. Each round is a filter and a count with map-side combine; nothing but
sketches and slice bounds reaches the driver, a fixed number per group. Every later comparison with the
found rows is a projection.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Slices of a span in one round, and of all spans together: what a task counts and hands on.
SLICES, ALL_SLICES = 4096, 65_536
SMALL = 100_000
#: Size of a group's sketch, and how far around a wanted rank its bounds are set, as a share of the group.
SKETCH, AROUND = 800, 0.01
#: Parts of a group whose bounds its sketch is asked for.
PARTS = 200


@dataclass(frozen=True)
class Span:
    """Part of a group's order: all rows with value and tie inside these bounds."""

    group: tuple
    measure: str
    low: int
    high: int
    tie_low: int
    tie_high: int
    before: int  # rows of the group in front of the span
    rows: int

    def by_value(self) -> bool:
        return self.low < self.high

    def settled(self) -> bool:
        """A single value (and tie): there is nothing left to tell apart."""
        return self.low == self.high and self.tie_low == self.tie_high

    def step(self, slices: int) -> int:
        low, high = (self.low, self.high) if self.by_value() else (self.tie_low, self.tie_high)
        return -(-(high - low + 1) // slices)


@dataclass(frozen=True)
class RankedRow:
    group: tuple
    measure: str
    rank: int
    value: int
    tie: int


def rows_at_ranks(
    frame: DataFrame,
    measures: dict[str, Column],
    ranks_of: Callable[[int], Iterable[int]],
    groups: tuple[str, ...] = (),
    tie: str | None = None,
    weight: str | None = None,
    small: int = SMALL,
) -> list[RankedRow]:
    """The rows at the zero-based ranks ``ranks_of(n)`` of every group of ``n`` rows.

    ``frame`` is read several times, so it should be a stored table. Each measure is a
    whole number; rows are ordered by measure, then ``tie`` (a whole number unique in the
    group). Without ``tie`` only the value is looked for. ``weight`` counts a row several
    times. The number of groups must be bounded (snapshots, segments), as the result is
    local: groups x measures x ranks.
    """
    search = _Search(frame, measures, groups, tie, weight)
    wanted = [
        (span, rank)
        for span in search.whole_groups()
        for rank in ranks_of(span.rows)
        if 0 <= rank < span.rows
    ]
    whole = weight is not None  # sketches take no weights; then every group is narrowed once, whatever its size
    if not whole and wanted:
        wanted = search.sketched(wanted)
    while True:
        large = {s for s, _ in wanted if (whole or s.rows > small) and not s.settled()}
        whole = False
        if not large:
            break
        narrowed = search.narrow([w for w in wanted if w[0] in large])
        wanted = [(narrowed.get((s, r), s), r) for s, r in wanted]
    found = [
        RankedRow(s.group, s.measure, rank, s.low, s.tie_low) for s, rank in wanted if s.settled()
    ]
    unsettled = [w for w in wanted if not w[0].settled()]
    return found + (search.number(unsettled) if unsettled else [])


class _Search:
    """One frame's measures, each searched by a scan of just its own column and the keys."""

    def __init__(self, frame, measures, groups, tie, weight):
        self.frame = frame
        self.measures = {name: column.cast("bigint") for name, column in measures.items()}
        self.groups = groups
        self.tie = F.col(tie).cast("bigint") if tie else F.lit(0).cast("bigint")
        self.weight = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
        self.weighted = weight is not None
        self.sketches: dict[tuple, list[int]] = {}

    def whole_groups(self) -> list[Span]:
        totals = []
        for name, value in self.measures.items():
            totals += [
                F.sum(F.when(value.isNotNull(), self.weight)).alias(f"{name}_rows"),
                F.min(value).alias(f"{name}_low"),
                F.max(value).alias(f"{name}_high"),
            ]
            if not self.weighted:
                totals.append(F.kll_sketch_agg_bigint(value, SKETCH).alias(f"{name}_sketch"))
        ties = [F.min(self.tie).alias("tie_low"), F.max(self.tie).alias("tie_high")]
        counted = self.frame.groupBy(*self.groups).agg(*ties, *totals)
        if not self.weighted:
            parts = F.array(*(F.lit(i / PARTS) for i in range(PARTS + 1)))
            counted = counted.withColumns(
                {
                    f"{m}_sketch": F.when(
                        F.col(f"{m}_rows") > 0, F.kll_sketch_get_quantile_bigint(f"{m}_sketch", parts)
                    )
                    for m in self.measures
                }
            )
        rows = counted.collect()
        if not self.weighted:
            self.sketches = {
                (tuple(row[g] for g in self.groups), name): row[f"{name}_sketch"]
                for row in rows
                for name in self.measures
                if row[f"{name}_rows"]
            }
        return [
            Span(
                tuple(row[g] for g in self.groups),
                name,
                row[f"{name}_low"],
                row[f"{name}_high"],
                row["tie_low"],
                row["tie_high"],
                0,
                row[f"{name}_rows"],
            )
            for row in rows
            for name in self.measures
            if row[f"{name}_rows"]
        ]

    def sketched(self, wanted: list[tuple[Span, int]]) -> list[tuple[Span, int]]:
        """The wanted ranks with the values that a sketch puts around them as spans, counted exactly.

        Spans of a group that overlap become one. A rank outside its span keeps the whole group.
        """
        ranks: dict[Span, list[int]] = {}
        for span, rank in wanted:
            ranks.setdefault(span, []).append(rank)
        bounds: dict[Span, list[tuple[int, int]]] = {}
        for span, own in ranks.items():
            told = self.sketches[span.group, span.measure]
            bounds[span] = [
                (
                    told[min(PARTS, max(0, math.floor((r / span.rows - AROUND) * PARTS)))],
                    told[max(0, min(PARTS, math.ceil(((r + 1) / span.rows + AROUND) * PARTS)))],
                )
                for r in own
            ]
        counts = self._counted(bounds)
        placed = {}
        for span, own in bounds.items():
            found = [
                replace(span, low=low, high=high, before=before, rows=upto - before)
                for (low, high), (before, upto) in zip(own, counts[span])
            ]
            good = [before <= r < upto for r, (before, upto) in zip(ranks[span], counts[span])]
            joined: list[Span] = []
            for part in sorted((f for f, g in zip(found, good) if g), key=lambda f: f.low):
                if joined and part.low <= joined[-1].high:
                    last = joined[-1]
                    upto = max(last.before + last.rows, part.before + part.rows)
                    joined[-1] = replace(last, high=max(last.high, part.high), rows=upto - last.before)
                else:
                    joined.append(part)
            if not all(good):  # the whole group would overlap with the others
                joined = [span]
            for rank in ranks[span]:
                placed[span, rank] = next(j for j in joined if j.before <= rank < j.before + j.rows)
        return [(placed[span, rank], rank) for span, rank in wanted]

    def _counted(self, bounds: dict[Span, list[tuple[int, int]]]) -> dict[Span, list[tuple[int, int]]]:
        """Rows of the group before each bound and up to its end, for all measures in one scan."""
        most = {m: max((len(own) for s, own in bounds.items() if s.measure == m), default=0) for m in self.measures}
        names = [(m, j, end) for m in self.measures for j in range(most[m]) for end in ("low", "high")]
        rows: dict[tuple, dict] = {}
        for span, own in bounds.items():
            for j, pair in enumerate(own):
                for end, value in zip(("low", "high"), pair):
                    rows.setdefault(span.group, {})[span.measure, j, end] = value

        def test(m: str, end: str, bound: Column) -> Column:
            value = self.measures[m]
            return F.count_if(value < bound if end == "low" else value <= bound)

        if self.groups:
            columns = {g: [group[i] for group in rows] for i, g in enumerate(self.groups)}
            columns |= {
                "_".join(map(str, n)): pa.array([own.get(n) for own in rows.values()], pa.int64()) for n in names
            }
            joined = self.frame.join(self._local(columns), list(self.groups))
            tests = [test(m, end, F.col(f"{m}_{j}_{end}")).alias(f"{m}_{j}_{end}_n") for m, j, end in names]
            found = {tuple(r[g] for g in self.groups): r for r in joined.groupBy(*self.groups).agg(*tests).collect()}
        else:
            own = rows[()]
            tests = [test(m, end, F.lit(own.get((m, j, end)))).alias(f"{m}_{j}_{end}_n") for m, j, end in names]
            found = {(): self.frame.agg(*tests).first()}
        return {
            span: [
                (found[span.group][f"{span.measure}_{j}_low_n"], found[span.group][f"{span.measure}_{j}_high_n"])
                for j in range(len(own))
            ]
            for span, own in bounds.items()
        }

    def inside(self, spans: list[Span]) -> list[DataFrame]:
        """Per measure, the rows that lie in one of its spans; spans never overlap."""
        frames = []
        slices = min(SLICES, max(2, ALL_SLICES // len(spans)))
        for name, value in self.measures.items():
            mine = [(number, s) for number, s in enumerate(spans) if s.measure == name]
            if mine:
                rows = self.frame.select(
                    *self.groups,
                    value.alias("_value"),
                    self.tie.alias("_tie"),
                    self.weight.alias("_weight"),
                )
                frames.append(self._keyed(rows, mine, slices) if self.groups else _chosen(rows, mine, slices))
        return frames

    def _keyed(self, rows: DataFrame, spans: list[tuple[int, Span]], slices: int) -> DataFrame:
        bounds = {g: [s.group[i] for _, s in spans] for i, g in enumerate(self.groups)}
        bounds |= {f"_{b.name}": [b.of(s, slices) for _, s in spans] for b in _BOUNDS}
        bounds["_span"] = [number for number, _ in spans]
        return rows.join(self._local(bounds), list(self.groups)).where(
            F.col("_value").between(F.col("_low"), F.col("_high"))
            & F.col("_tie").between(F.col("_tie_low"), F.col("_tie_high"))
        )

    def _local(self, columns: dict[str, list]) -> DataFrame:
        """A broadcast frame of bounds; its rows are groups x measures x ranks at most."""
        local = self.frame.sparkSession.createDataFrame(pa.table(columns))
        types = {g: self.frame.schema[g].dataType for g in self.groups}
        return F.broadcast(
            local.select(
                *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in columns]
            )
        )

    def looked_for(self, spans: list[Span], wanted) -> DataFrame:
        number = {span: i for i, span in enumerate(spans)}
        return self._local(
            {
                "_span": [number[s] for s, _ in wanted],
                "_offset": [rank - s.before for s, rank in wanted],
                "_rank": [rank for _, rank in wanted],
            }
        )

    def narrow(self, wanted) -> dict[tuple, Span]:
        """For every wanted rank the slice of its span that holds it."""
        spans = list(dict.fromkeys(s for s, _ in wanted))
        axis = F.when(F.col("_by_value"), F.col("_value") - F.col("_low")).otherwise(
            F.col("_tie") - F.col("_tie_low")
        )
        slices = [
            rows.groupBy("_span", F.call_function("div", axis, F.col("_step")).alias("_slice")).agg(
                F.sum("_weight").alias("_rows"),
                F.min("_value").alias("_from"),
                F.max("_value").alias("_to"),
                F.min("_tie").alias("_tie_from"),
                F.max("_tie").alias("_tie_to"),
            )
            for rows in self.inside(spans)
        ]
        hits = self._hits(reduce(DataFrame.union, slices), ["_slice"], "_rows", spans, wanted)
        return {
            (spans[hit["_span"]], hit["_rank"]): replace(
                spans[hit["_span"]],
                low=hit["_from"],
                high=hit["_to"],
                tie_low=hit["_tie_from"],
                tie_high=hit["_tie_to"],
                before=spans[hit["_span"]].before + hit["_skipped"],
                rows=hit["_rows"],
            )
            for hit in hits
        }

    def number(self, wanted) -> list[RankedRow]:
        """Put the few rows of each span in order and pick the wanted ones."""
        spans = list(dict.fromkeys(s for s, _ in wanted))
        rows = [r.select("_span", "_value", "_tie", "_weight") for r in self.inside(spans)]
        hits = self._hits(
            reduce(DataFrame.union, rows), ["_value", "_tie"], "_weight", spans, wanted
        )
        return [
            RankedRow(span.group, span.measure, hit["_rank"], hit["_value"], hit["_tie"])
            for hit in hits
            for span in [spans[hit["_span"]]]
        ]

    def _hits(self, pieces: DataFrame, order: list[str], count: str, spans, wanted):
        """The pieces, in order within their span, that hold a wanted rank (one row each)."""
        upto = F.sum(count).over(
            Window.partitionBy("_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        )
        return (
            pieces.withColumn("_skipped", upto - F.col(count))
            .join(self.looked_for(spans, wanted), "_span")
            .where(
                (F.col("_skipped") <= F.col("_offset"))
                & (F.col("_offset") < F.col("_skipped") + F.col(count))
            )
            .collect()
        )


@dataclass(frozen=True)
class _Bound:
    name: str
    of: Callable[[Span, int], int | bool]


_BOUNDS = (
    _Bound("low", lambda s, _: s.low),
    _Bound("high", lambda s, _: s.high),
    _Bound("tie_low", lambda s, _: s.tie_low),
    _Bound("tie_high", lambda s, _: s.tie_high),
    _Bound("by_value", lambda s, _: s.by_value()),
    _Bound("step", Span.step),
)


def _chosen(rows: DataFrame, spans: list[tuple[int, Span]], slices: int) -> DataFrame:
    """Without groups there are only as many spans as ranks, so they are literals."""
    tests = [
        F.col("_value").between(s.low, s.high) & F.col("_tie").between(s.tie_low, s.tie_high)
        for _, s in spans
    ]

    def pick(values) -> Column:
        chain = F
        for test, value in zip(tests, values):
            chain = chain.when(test, F.lit(value))
        return chain.otherwise(F.lit(None))

    return rows.select(
        "*",
        pick([number for number, _ in spans]).alias("_span"),
        *[pick([b.of(s, slices) for _, s in spans]).alias(f"_{b.name}") for b in _BOUNDS],
    ).where(F.col("_span").isNotNull())


def bucket_starts(buckets: int) -> Callable[[int], list[int]]:
    """Ranks at which NTILE buckets two to ``buckets`` begin among n rows.

    The first ``n mod buckets`` buckets hold one row more; with fewer rows than buckets the
    start lies past the end and the bucket stays empty.
    """

    def starts(n: int) -> list[int]:
        size, larger = divmod(n, buckets)
        return [j * size + min(j, larger) for j in range(1, buckets)]

    return starts
