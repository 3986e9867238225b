"""Named queries over an input directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.codes import SEGMENT_CODES
from ..operators import (
    cleaning,
    dimensions,
    history as hist,
    mending,
    profiling,
    quality,
    returns,
    scoring,
    sketches,
    winsor,
)
from ..sources.readers import from_workbook_headers, union_sheets
from ..sources.schemas import RAW, WORKBOOK_HEADERS
from . import charts, kpis, movements, products, segments
from .warehouse import Warehouse

# parameters of the registered queries
EXPECTED_LINES, TOLERANCE = 1_067_371, 100
FILTER = list(SEGMENT_CODES)[:2]
VARIANT_ROOT = "1000"
SECOND_LOAD = 1998
SPAN = ("1995-01-01", "1996-12-31")


def _sheets(w: Warehouse) -> DataFrame:
    """The raw lines as two workbook sheets, early and late, brought together again."""
    sheet = w.raw().withColumnsRenamed(dict(zip(RAW.names, WORKBOOK_HEADERS)))
    late = F.coalesce(F.year("InvoiceDate") >= 1998, F.lit(False))
    return union_sheets(
        from_workbook_headers(sheet.where(part)) for part in (~late, late)
    )


def _bucket(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: cleaning.bucket(w.raw(), name)


def _history_base(calendar: str) -> Callable[[Warehouse], DataFrame]:
    columns = ("snapshot_date", "customer_id", "recency", "frequency", "monetary")
    return lambda w: w.history_base(calendar).select(*columns)


def _transitions(level: str) -> Callable[[Warehouse], DataFrame]:
    def query(w: Warehouse) -> DataFrame:
        history = w.history()
        pair = movements.latest_snapshots(history)
        if pair is None:
            return history.limit(0).select(
                F.col("macro_segment").alias("seg_from"),
                F.col("macro_segment").alias("seg_to"),
                F.lit(0).cast("bigint").alias("n_customers"),
            )
        return movements.segment_transitions(history, *pair, level)

    return query


def _dq_raw(w: Warehouse) -> DataFrame:
    simple = [c for c in quality.raw_suite() if not isinstance(c.metric, tuple)]
    return quality.run_checks("raw", w.raw(), simple)


def _dq_clean(w: Warehouse) -> DataFrame:
    """Sales, stock movements and cancellations from one pass over the raw lines."""
    routed = cleaning.route(w.raw())
    both = routed.select("*", F.col("invoice").alias("invoice_id"), F.col("price").alias("unit_price"))
    return quality.run_suites(
        both,
        "bucket",
        {
            "sales": quality.sales_suite(),
            "stock_movements": quality.stock_movements_suite(),
            "cancellations": quality.cancellations_suite(),
        },
    )


def _dq_duplicates(w: Warehouse) -> DataFrame:
    def keyed(suite):
        return [c for c in suite if isinstance(c.metric, tuple)]

    return quality.run_checks("raw", w.raw(), keyed(quality.raw_suite())).unionByName(
        quality.run_checks("customer_rfm", w.customers(), keyed(quality.customer_rfm_suite()))
    )


def _dq_customers(w: Warehouse) -> DataFrame:
    simple = [c for c in quality.customer_rfm_suite() if not isinstance(c.metric, tuple)]
    return quality.run_checks("customer_rfm", w.customers(), simple)


def _dq_code_coverage(w: Warehouse) -> DataFrame:
    """All codes have a segment, and so has every scored customer and history row."""
    return (
        quality.run_checks(
            "code_coverage", scoring.code_coverage(w.customers()), quality.coverage_suite()
        )
        .unionByName(quality.run_checks("customer_rfm", w.enriched(), quality.classified_suite()))
        .unionByName(
            quality.run_checks("customer_rfm_history", w.history(), quality.classified_suite())
        )
    )


def _dq_constraints(w: Warehouse) -> DataFrame:
    """Required columns and keys of the three target tables."""
    return (
        quality.run_checks("sales", w.sales(), quality.sales_constraints())
        .unionByName(
            quality.run_checks("customer_rfm", w.customers(), quality.customer_constraints())
        )
        .unionByName(
            quality.run_checks("customer_rfm_history", w.history(), quality.history_constraints())
        )
    )


def _top_products_nested(w: Warehouse) -> DataFrame:
    """Flattened to text, one entry per product, for comparison outside Spark."""
    nested = charts.top_products_nested(
        products.top_products_by_segment(w.sales(), w.enriched())
    )
    entry = F.transform(
        "products",
        lambda p: F.concat_ws(
            "|", p["stock_code"], F.coalesce(p["description"], F.lit("")), p["revenue"].cast("string")
        ),
    )
    return nested.select("segment_label", F.concat_ws(";", entry).alias("products"))


def _within(answers: DataFrame, keys: list[str]) -> DataFrame:
    """Sketched quantiles without their values, which differ from run to run within the error."""
    return answers.select(
        *keys, "measure", "percent", "n", (F.col("rank_error") <= sketches.RANK_ERROR).alias("within_error")
    )


def _snapshot_quantiles(w: Warehouse) -> DataFrame:
    answers = sketches.snapshot_quantiles(w.snapshot_sketches())
    return _within(sketches.rank_errors(w.history(), answers, ["snapshot_date"]), ["snapshot_date"])


def _span_quantiles(w: Warehouse) -> DataFrame:
    inside = F.col("snapshot_date").between(*(F.lit(d).cast("date") for d in SPAN))
    answers = sketches.span_quantiles(w.snapshot_sketches(), *SPAN)
    return _within(sketches.rank_errors(w.history().where(inside), answers, []), [])


def _misspelt(w: Warehouse) -> DataFrame:
    """The raw lines, some with a letter of the country doubled, some with one lost."""
    country = F.col("country")
    doubled = F.concat(F.substring(country, 1, 2), F.substring(country, 2, 99))
    return w.raw().withColumn(
        "country",
        F.when(F.col("quantity") % 17 == 3, doubled)
        .when(F.col("quantity") % 17 == 5, F.concat(F.substring(country, 1, 2), F.substring(country, 4, 99)))
        .when(F.col("quantity") % 17 == 7, F.concat(F.lit("xyz"), country))
        .otherwise(country),
    )


def _country_map(w: Warehouse) -> DataFrame:
    return dimensions.mapped_countries(_misspelt(w), dimensions.country_table(w.spark))


_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # ingest and cleaning
    "raw_ingest_union": _sheets,
    "ingest_audit": lambda w: cleaning.ingest_audit(w.raw(), EXPECTED_LINES, TOLERANCE),
    "clean_stock_movements": _bucket("stock_movements"),
    "clean_cancellations": _bucket("cancellations"),
    "clean_non_product_lines": _bucket("non_product_lines"),
    "clean_sales": lambda w: w.sales(),
    "clean_rejected": _bucket("rejected"),
    "clean_audit": lambda w: cleaning.audit(w.raw()),
    "cancellation_links": lambda w: w.cancellation_links(),
    "cancellation_link_summary": lambda w: returns.link_summary(w.cancellation_links()),
    "sales_net_of_cancellations": lambda w: returns.net_sales(w.raw(), w.cancellation_links()),
    # mending and dimensions
    "product_p99_bounds": lambda w: w.product_bounds(),
    "winsorised_sales": lambda w: w.winsorised(),
    "winsorised_products": lambda w: winsor.winsorised_products(w.winsorised()),
    "repaired_lines": lambda w: mending.repaired(w.raw()),
    "repair_counts": lambda w: mending.repair_counts(mending.repaired(w.raw())),
    "deduplicated_lines": lambda w: mending.deduplicated(w.raw()),
    "deduplicated_plausible": lambda w: mending.deduplicated(w.raw(), mending.KEEP_PLAUSIBLE),
    "removal_ledger": lambda w: mending.removal_ledger(w.raw()),
    "non_product_subtypes": lambda w: mending.non_product_subtypes(
        cleaning.bucket(w.raw(), "non_product_lines")
    ),
    "flagged_lines": lambda w: mending.flagged(w.raw()),
    "flag_counts": lambda w: mending.flag_counts(w.raw()),
    "product_families": lambda w: w.families(SECOND_LOAD),
    "product_dimension": lambda w: dimensions.product_dimension(
        dimensions.product_variants(w.raw()), w.families(SECOND_LOAD)
    ),
    "country_map": _country_map,
    "country_suggestions": lambda w: dimensions.country_suggestions(
        _country_map(w), dimensions.country_table(w.spark)
    ),
    # sketches
    "snapshot_quantiles_sketched": _snapshot_quantiles,
    "span_quantiles_sketched": _span_quantiles,
    "distinct_sketched": lambda w: sketches.distinct_within_error(
        w.raw(), sketches.approx_distinct(sketches.column_sketches(w.raw()))
    ),
    "repair_codes_sketched": lambda w: sketches.approx_repair_codes(sketches.code_sets(w.raw())),
    # scoring and segments
    "rfm_base": lambda w: w.rfm_base(),
    "rfm_scores": lambda w: w.scored(),
    "rfm_segments": lambda w: w.segmented(),
    "rfm_enriched": lambda w: w.enriched(),
    "code_coverage": lambda w: scoring.code_coverage(w.customers()),
    "first_purchase": lambda w: w.first_purchases(),
    # history
    "snapshot_calendar": lambda w: hist.snapshot_calendar(w.visits()),
    "snapshot_calendar_iterative": lambda w: hist.snapshot_calendar(w.visits(), hist.ITERATIVE),
    "history_base": _history_base(hist.MONTH_END),
    "history_base_iterative": _history_base(hist.ITERATIVE),
    "history_scores": lambda w: w.scored_history(),
    "history_scores_iterative": lambda w: w.scored_history(hist.ITERATIVE),
    "history_volumes": lambda w: movements.history_volumes(w.history()),
    "macro_last_snapshot": lambda w: movements.macro_last_snapshot(w.history()),
    "snapshot_dates": lambda w: movements.snapshot_dates(w.history()),
    # key figures
    "kpis": lambda w: kpis.kpis(w.customers()),
    "kpi_bar": lambda w: kpis.kpi_bar(w.raw(), w.visits(), w.customers()),
    "recency_kpis": lambda w: kpis.recency_kpis(w.customers()),
    "frequency_kpis": lambda w: kpis.frequency_kpis(w.customers()),
    "monetary_kpis": lambda w: kpis.monetary_kpis(w.customers()),
    "glossary_metrics": lambda w: kpis.glossary_metrics(w.visits(), w.customers()),
    # segments
    "segment_distribution": lambda w: segments.segment_distribution(w.customers()),
    "segment_kpi_table": lambda w: segments.segment_kpi_table(w.enriched()),
    "bubble_segments": lambda w: segments.bubble_segments(w.enriched()),
    "rf_heatmap": lambda w: segments.rf_heatmap(w.customers()),
    "all_segments": lambda w: segments.all_segments(w.customers()),
    "monetary_by_segment": lambda w: segments.monetary_by_segment(w.customers()),
    "recency_distribution": lambda w: segments.distribution(w.customers(), "recency"),
    "frequency_distribution": lambda w: segments.distribution(w.customers(), "frequency"),
    "monetary_distribution": lambda w: segments.distribution(w.customers(), "monetary"),
    "recency_bins": lambda w: segments.recency_bins(w.customers()),
    "frequency_bins": lambda w: segments.frequency_bins(w.customers(), w.visits()),
    "monetary_bins": lambda w: segments.monetary_bins(w.customers()),
    # customers and products
    "top_customers": lambda w: segments.top_customers(w.customers()),
    "top_customers_filtered": lambda w: segments.top_customers(w.customers(), FILTER),
    "scatter_sample": lambda w: segments.scatter_sample(w.enriched()),
    "top_products_by_segment": lambda w: products.top_products_by_segment(
        w.sales(), w.enriched()
    ),
    "monthly_revenue": lambda w: products.monthly_revenue(w.visits()),
    # movements and cohorts
    "macro_movements": lambda w: movements.macro_movements(w.history()),
    "acquisitions_trend": lambda w: products.acquisitions_trend(w.first_purchases()),
    "cohort_pivot": lambda w: segments.cohort_pivot(w.first_purchases(), w.enriched()),
    "transitions_macro": _transitions("macro"),
    "transitions_detailed": _transitions("detailed"),
    # quality
    "dq_raw": _dq_raw,
    "dq_clean_sales": _dq_clean,
    "dq_customer_rfm": _dq_customers,
    "dq_duplicates": _dq_duplicates,
    "dq_code_coverage": _dq_code_coverage,
    "dq_constraints": _dq_constraints,
    # profiling
    "column_profile": lambda w: profiling.column_profile(w.raw(), w.store),
    "missing_by_column": lambda w: profiling.missing_by_column(w.raw()),
    "date_span": lambda w: profiling.date_span(w.raw()),
    "null_profile": lambda w: profiling.null_profile(w.raw()),
    "description_repair_summary": lambda w: profiling.description_repair_summary(w.raw()),
    "description_recoverable": lambda w: profiling.description_recoverable(w.raw()),
    "description_unrecoverable": lambda w: profiling.description_unrecoverable(w.raw()),
    "quantity_anomalies": lambda w: profiling.quantity_anomalies(w.raw()),
    "price_anomalies": lambda w: profiling.price_anomalies(w.raw()),
    "negative_price_lines": lambda w: profiling.negative_price_lines(w.raw()),
    "zero_price_descriptions": lambda w: profiling.zero_price_descriptions(w.raw()),
    "zero_price_descriptions_all": lambda w: profiling.zero_price_descriptions(
        w.raw(), 30, include_missing=True
    ),
    "special_stock_codes": lambda w: profiling.special_stock_codes(w.raw()),
    "alpha_stock_codes": lambda w: profiling.alpha_stock_codes(w.raw()),
    "lowercase_descriptions": lambda w: profiling.lowercase_descriptions(w.raw()),
    "sku_variant_summary": lambda w: profiling.sku_variant_summary(w.raw()),
    "sku_variant_letters": lambda w: profiling.sku_variant_letters(w.raw()),
    "sku_variants_of_root": lambda w: profiling.sku_variants_of_root(w.raw(), VARIANT_ROOT),
    "exact_duplicates_summary": lambda w: profiling.exact_duplicates_summary(w.raw(), w.repeated_lines()),
    "exact_duplicates_sample": lambda w: profiling.exact_duplicates_sample(w.raw(), repeated=w.repeated_lines()),
    "country_distribution": lambda w: profiling.country_distribution(w.raw()),
    # chart shapes
    "rf_heatmap_matrix": lambda w: charts.rf_heatmap_matrix(w.customers()),
    "segment_treemap": lambda w: charts.segment_treemap(w.customers()),
    "monetary_boxplot": lambda w: charts.monetary_boxplot(w.customers()),
    "recency_boxplot": lambda w: charts.dimension_boxplot(w.customers(), "recency"),
    "frequency_boxplot": lambda w: charts.dimension_boxplot(w.customers(), "frequency"),
    "monetary_overall_boxplot": lambda w: charts.dimension_boxplot(
        w.customers(), "monetary"
    ),
    "sankey_links": lambda w: charts.sankey_links(_transitions("macro")(w)),
    "sankey_nodes": lambda w: charts.sankey_nodes(_transitions("macro")(w)),
    "macro_movements_wide": lambda w: charts.macro_movements_wide(
        movements.macro_movements(w.history())
    ),
    "top_products_nested": _top_products_nested,
}


def plain(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, the one number type every client reads alike."""
    return frame.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query):
        return lambda spark, directory: plain(query(Warehouse(spark, directory)))

    return {name: bind(query) for name, query in _QUERIES.items()}
