"""The layers raw -> visits -> customers -> history of one input directory.

Every layer that several reports read is a stored table (see ``sources.scratch``); what is
only a projection of one (sales, scores, segments) stays a plan on top of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cleaning, dimensions, history as hist, profiling, returns, scoring, sketches, winsor
from ..operators.visits import first_purchases, visits
from ..sources.scratch import Stages
from ..sources.tables import retail_lines

INPUTS = ("lineitem", "orders", "customer", "nation", "part")


class Warehouse:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._stages = Stages(spark, directory, INPUTS)

    def raw(self) -> DataFrame:
        return self._stages.table("raw", lambda: retail_lines(self.spark, self.directory))

    def sales(self) -> DataFrame:
        return cleaning.sales(self.raw())

    def visits(self) -> DataFrame:
        return self._stages.table("visits", lambda: visits(self.sales()))

    def first_purchases(self) -> DataFrame:
        return first_purchases(self.visits())

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        return self._stages.table(name, lambda: frame)

    def cancellation_links(self) -> DataFrame:
        return self._stages.table(
            "cancellation_links", lambda: returns.cancellation_links(self.raw(), self.store)
        )

    def repeated_lines(self) -> DataFrame:
        return self._stages.table("repeated_lines", lambda: profiling.repeated_lines(self.raw(), self.store))

    def product_bounds(self) -> DataFrame:
        return self._stages.table(
            "product_bounds", lambda: winsor.product_bounds(self.sales(), store=self.store)
        )

    def winsorised(self) -> DataFrame:
        return winsor.winsorised(self.sales(), self.product_bounds())

    def families(self, until_year: int) -> DataFrame:
        """The family dimension after two loads: lines before ``until_year``, then the others."""
        early = F.coalesce(F.year("invoice_date") < until_year, F.lit(False))

        def load(part):
            return dimensions.product_variants(self.raw().where(part))

        first = self._stages.table(
            "families_first",
            lambda: dimensions.extended(None, load(early), "family_code", "family_key", "first"),
        )
        return self._stages.table(
            "families",
            lambda: dimensions.extended(first, load(~early), "family_code", "family_key", "second"),
        )

    def snapshot_sketches(self) -> DataFrame:
        return self._stages.table("snapshot_sketches", lambda: sketches.snapshot_sketches(self.history()))

    def rfm_base(self) -> DataFrame:
        return self._stages.table("rfm_base", lambda: self._scorable())

    def _scorable(self) -> DataFrame:
        scoring.require_sales(self.visits())
        return scoring.rfm_base(self.visits())

    def scored(self) -> DataFrame:
        base = self.rfm_base()
        starts = self._stages.value("rfm_starts", lambda: scoring.quintile_starts(base))
        return scoring.with_scores(base, starts)

    def segmented(self) -> DataFrame:
        return scoring.with_segments(self.scored())

    def customers(self) -> DataFrame:
        return self._stages.table("customers", self.segmented)

    def enriched(self) -> DataFrame:
        return scoring.enriched(self.customers())

    def history_states(self, calendar: str = hist.MONTH_END) -> DataFrame:
        return self._stages.table(
            f"history_states_{calendar}", lambda: hist.history_states(self.visits(), calendar)
        )

    def history_base(self, calendar: str = hist.MONTH_END) -> DataFrame:
        return self._repeated(self.history_states(calendar), calendar)

    def _repeated(self, states: DataFrame, calendar: str) -> DataFrame:
        return hist.repeated(states, hist.numbered_calendar(self.visits(), calendar))

    def _scored(self, base: DataFrame, calendar: str) -> DataFrame:
        starts = self._stages.value(
            f"history_starts_{calendar}", lambda: hist.history_starts(self.history_base(calendar))
        )
        return hist.history_scores(base, starts)

    def scored_history(self, calendar: str = hist.MONTH_END) -> DataFrame:
        return self._scored(self.history_base(calendar), calendar)

    def history(self, calendar: str = hist.MONTH_END) -> DataFrame:
        """The scored history as a table; the states are dealt for its write, not its rows."""

        def build() -> DataFrame:
            dealt = hist.by_snapshot(self.history_states(calendar))
            return self._scored(self._repeated(dealt, calendar), calendar)

        return self._stages.table(f"history_{calendar}", build, partition_by="snapshot_date")
