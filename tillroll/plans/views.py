"""Session views and SQL functions for callers that query in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.codes import (
    CODE_SEGMENT,
    SCORES,
    SEGMENT_MACRO,
    UNCLASSIFIED,
    UNCLASSIFIED_LABEL,
)
from ..operators.scoring import code_coverage, enriched
from ..operators.visits import first_purchases


def register_functions(spark: SparkSession) -> None:
    """``fn_rfm_segment(r, f, m)`` and ``fn_rfm_macro(segment)``; Catalyst inlines both."""
    names = ", ".join(
        f"'{CODE_SEGMENT.get(f'{r}{f}{m}', UNCLASSIFIED)}'"
        for r in SCORES
        for f in SCORES
        for m in SCORES
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION fn_rfm_segment(r INT, f INT, m INT)
        RETURNS STRING RETURN CASE
            WHEN r BETWEEN 1 AND 5 AND f BETWEEN 1 AND 5 AND m BETWEEN 1 AND 5
            THEN element_at(array({names}), (r - 1) * 25 + (f - 1) * 5 + m)
            ELSE '{UNCLASSIFIED}' END"""
    )
    arms = " ".join(f"WHEN '{name}' THEN '{macro}'" for name, macro in SEGMENT_MACRO.items())
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION fn_rfm_macro(segment STRING)
        RETURNS STRING RETURN CASE segment {arms} ELSE '{UNCLASSIFIED_LABEL}' END"""
    )


def register_views(visits: DataFrame, customers: DataFrame, history: DataFrame) -> None:
    """The tables and derived views under their usual names."""
    first_purchases(visits).createOrReplaceTempView("customer_first_purchase")
    customers.createOrReplaceTempView("customer_rfm")
    enriched(customers).createOrReplaceTempView("customer_rfm_v")
    code_coverage(customers).createOrReplaceTempView("v_rfm_codes_coverage")
    history.createOrReplaceTempView("customer_rfm_history")
