"""The staged run: raw -> clean -> customers -> history, each stage a written table.

``append`` adds a load to a finished run: lines and sales are added, visits of the months the load touches
are merged, and the history is built on from the last snapshot before the load.

A gate between two stages raises and ends the run. Tables behind a failed stage are empty
(they are purged first), except the history, which keeps its last state until its own
stage replaces it.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators import cleaning, history as hist, quality, scoring
from ..operators.visits import merged_visits, visits
from ..sources.readers import as_raw, write_raw
from ..sources.schemas import CUSTOMER_RFM, RAW, SALES as SALES_SCHEMA
from ..sources.scratch import hadoop_path, scratch_table
from . import movements
from .views import register_views

RAW_LINES = "raw/online_retail"
SALES = "clean/sales"
SIDE_BUCKETS = "clean/side_buckets"  # partitioned by bucket
VISITS = "clean/visits"
CUSTOMERS = "analytics/customer_rfm"
HISTORY = "analytics/customer_rfm_history"
SIDE_SCHEMA = T.StructType([*RAW.fields, T.StructField("bucket", T.StringType())])
PURGED = (SALES, SIDE_BUCKETS, VISITS, CUSTOMERS)
VISIT_MONTH = "sale_month"
#: What a table without files is read as.
SCHEMAS = {
    SALES: SALES_SCHEMA,
    SIDE_BUCKETS: SIDE_SCHEMA,
    VISITS: T.StructType(
        [
            T.StructField("customer_id", T.LongType()),
            T.StructField("invoice_id", T.StringType()),
            T.StructField("sale_date", T.DateType()),
            T.StructField("lines", T.LongType()),
            T.StructField("amount", T.DecimalType(18, 2)),
            T.StructField("opens", T.BooleanType()),
            T.StructField(VISIT_MONTH, T.DateType()),
        ]
    ),
    CUSTOMERS: T.StructType([*CUSTOMER_RFM.fields, T.StructField("computed_at", T.TimestampType())]),
}

Gates = Mapping[str, list[quality.Check]]


def standard_gates() -> Gates:
    """Expectations of the retail dataset, by table; pass others (or none) for other data."""
    return {
        "raw": quality.raw_suite(),
        "sales": quality.sales_suite(),
        "stock_movements": quality.stock_movements_suite(),
        "cancellations": quality.cancellations_suite(),
        "customer_rfm": quality.customer_rfm_suite(),
    }


@dataclass(frozen=True)
class Ingested:
    """What a load stored, and how it went."""

    rows_inserted: int
    customer_id_type: str
    size_mb: float
    elapsed_s: float

    def volume_ok(self, expected: int, tolerance: int = 100) -> bool:
        return abs(self.rows_inserted - expected) <= tolerance


@dataclass(frozen=True)
class Appended:
    """What an append stored: lines per bucket, months of visits and snapshots written anew."""

    ingested: Ingested
    buckets: dict[str, int]
    visit_months: list[date]
    snapshots: list[date]


@dataclass(frozen=True)
class Summary:
    """Figures of one run: a fixed number of values, whatever the size of the data."""

    ingested: Ingested
    buckets: dict[str, int]
    history: dict[str, object]
    last_macros: dict[str, int]


class Pipeline:
    def __init__(self, spark: SparkSession, folder: str, gates: Gates | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.gates = gates or {}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        """A table; one that was purged, or got no lines, has no rows."""
        reader = self.spark.read
        if table in SCHEMAS:
            reader = reader.schema(SCHEMAS[table])
        return reader.parquet(self.path(table))

    def side_bucket(self, name: str) -> DataFrame:
        lines = self.read(SIDE_BUCKETS)
        return lines.where(F.col("bucket") == name).drop("bucket")

    def _gate(self, name: str, frame: DataFrame) -> None:
        if name in self.gates:
            quality.gate(name, frame, self.gates[name])

    def purge(self) -> None:
        """Empty the tables behind the raw lines, but for the history."""
        for table in PURGED:
            path, fs = hadoop_path(self.spark, self.path(table))
            fs.delete(path, True)
            fs.mkdirs(path)

    def ingest(self, raw: DataFrame, truncate: bool = True) -> Ingested:
        """Store the raw lines; they are counted on the way into the files."""
        started = time.perf_counter()
        seen = Observation("ingest")
        write_raw(
            raw.observe(seen, F.count(F.lit(1)).alias("rows")), self.path(RAW_LINES), truncate
        )
        stored = self.read(RAW_LINES)
        path, fs = hadoop_path(self.spark, self.path(RAW_LINES))
        result = Ingested(
            seen.get["rows"],
            stored.schema["customer_id"].dataType.simpleString(),
            round(fs.getContentSummary(path).getLength() / 1e6, 1),
            round(time.perf_counter() - started, 1),
        )
        self._gate("raw", stored)
        return result

    def clean(self) -> dict[str, int]:
        """Sales need no shuffle; the small side buckets are packed into few files. The
        first pass counts every bucket on the way."""
        seen = Observation("buckets")
        raw = self.read(RAW_LINES)
        routed = cleaning.route(raw).observe(seen, *cleaning.bucket_counts())
        sales = cleaning.as_sales(routed.where(F.col("bucket") == "sales"))
        sales.write.mode("overwrite").parquet(self.path(SALES))
        cleaning.side_buckets(raw).hint("rebalance", "bucket").write.mode(
            "overwrite"
        ).partitionBy("bucket").parquet(self.path(SIDE_BUCKETS))
        self._gate("sales", self.read(SALES))
        for name in cleaning.BUCKETS[:3]:
            self._gate(name, self.side_bucket(name))
        self._write_visits(visits(self.read(SALES)))
        return seen.get

    def _write_visits(self, rows: DataFrame, mode: str = "static") -> None:
        by_month = rows.withColumn(VISIT_MONTH, F.trunc("sale_date", "month")).hint("rebalance", VISIT_MONTH)
        by_month.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
            VISIT_MONTH
        ).parquet(self.path(VISITS))

    def score(self) -> None:
        sold = self.read(VISITS)
        scoring.require_sales(sold)
        with scratch_table(scoring.rfm_base(sold), "rfm_base") as base:
            scored = scoring.score_customers(base).withColumn("computed_at", F.current_timestamp())
            scored.write.mode("overwrite").parquet(self.path(CUSTOMERS))
        self._gate("customer_rfm", self.read(CUSTOMERS))

    def build_history(self, calendar: str = hist.MONTH_END) -> None:
        sold = self.read(VISITS)
        self._write_history(hist.history_states(sold, calendar), hist.numbered_calendar(sold, calendar))

    def _write_history(self, rows: DataFrame, calendar: DataFrame, mode: str = "static") -> None:
        with scratch_table(rows, "history_states") as states:
            starts = hist.history_starts(hist.repeated(states, calendar))
            scored = hist.history_scores(hist.repeated(hist.by_snapshot(states), calendar), starts)
            scored.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
                "snapshot_date"
            ).parquet(self.path(HISTORY))

    def append(self, raw: DataFrame, calendar: str = hist.MONTH_END) -> Appended:
        """Add a load to a finished run with the same calendar.

        The result equals a run over all lines. Raw lines, sales and side lines are added as files;
        visits are rewritten for the months of the load's invoices; snapshots before the load's
        first sale keep their files. Customers are ranked among each other, so they are scored anew. A load
        with sales before all others moves the calendar's begin, and the history is then built anew. If an
        append fails, ``run`` over all raw lines is the way back.
        """
        with scratch_table(as_raw(raw), "load") as load:
            ingested = self.ingest(load, truncate=False)
            seen = Observation("load_buckets")
            routed = cleaning.route(load).observe(seen, *cleaning.bucket_counts())
            sales = cleaning.as_sales(routed.where(F.col("bucket") == "sales"))
            with scratch_table(sales, "load_sales") as sold:
                sold.write.mode("append").parquet(self.path(SALES))
                cleaning.side_buckets(load).hint("rebalance", "bucket").write.mode("append").partitionBy(
                    "bucket"
                ).parquet(self.path(SIDE_BUCKETS))
                self._gate("sales", self.read(SALES))
                for name in cleaning.BUCKETS[:3]:
                    self._gate(name, self.side_bucket(name))
                first, months = self._merge_visits(sold)
        snapshots: list[date] = []
        if first is not None:
            self.score()
            snapshots = self._extend_history(first, calendar)
            register_views(self.read(VISITS), self.read(CUSTOMERS), self.read(HISTORY))
        return Appended(ingested, seen.get, months, snapshots)

    def _merge_visits(self, sold: DataFrame) -> tuple[date | None, list[date]]:
        """The load's first sale date and the months whose visits were rewritten."""
        stored = self.read(VISITS)
        with scratch_table(visits(sold), "load_visits") as fresh:
            first = fresh.agg(F.min("sale_date")).first()[0]
            if first is None:
                return None, []
            with scratch_table(merged_visits(stored, fresh), "merged_visits") as merged:
                month = F.trunc("sale_date", "month")
                months = sorted(r[0] for r in merged.select(month).distinct().collect())  # a row per month
                touched = merged.select("customer_id", "invoice_id").distinct()
                others = stored.where(F.col(VISIT_MONTH).isin(months)).join(
                    touched, ["customer_id", "invoice_id"], "left_anti"
                )
                whole = others.select(*merged.columns).unionByName(merged)
                with scratch_table(whole, "visit_months") as rows:  # read before it is overwritten
                    self._write_visits(rows, "dynamic")
        return first, months

    def _extend_history(self, first: date, calendar: str) -> list[date]:
        """The snapshots that were built: those that see a sale of ``first`` or later."""
        history, sold = self.read(HISTORY), self.read(VISITS)
        dates = sorted(r[0] for r in history.select("snapshot_date").distinct().collect())  # a row per month
        wanted = [r[0] for r in hist.snapshot_calendar(sold, calendar).collect()]
        before = [d for d in dates if d < first]
        if not before or wanted[: len(dates)] != dates:
            self.build_history(calendar)
            return wanted
        later = [d for d in wanted if d > before[-1]]
        if later:
            states = history.where(F.col("snapshot_date") == F.lit(before[-1]))
            rows = hist.history_states(sold, calendar, states, before[-1])
            self._write_history(rows, hist.numbered_calendar(sold, calendar), "dynamic")
        return later

    def run(
        self,
        raw: DataFrame,
        calendar: str = hist.MONTH_END,
        expected_rows: int | None = None,
        tolerance: int = 100,
    ) -> Summary:
        """One whole run; it ends after the load if that is off ``expected_rows`` by more
        than ``tolerance`` lines."""
        ingested = self.ingest(raw)
        if expected_rows is not None and not ingested.volume_ok(expected_rows, tolerance):
            raise ValueError(f"{ingested.rows_inserted} lines loaded, {expected_rows} expected")
        self.purge()
        buckets = self.clean()
        self.score()
        self.build_history(calendar)
        history = self.read(HISTORY)
        register_views(self.read(VISITS), self.read(CUSTOMERS), history)
        return Summary(
            ingested,
            buckets,
            movements.history_volumes(history).first().asDict(),
            dict(movements.macro_last_snapshot(history).collect()),  # four macros at most
        )
