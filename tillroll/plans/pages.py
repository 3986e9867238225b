"""Report pages: the frames one page shows together."""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import charts, kpis, segments

DIMENSIONS = ("recency", "frequency", "monetary")


def dimension_page(
    raw: DataFrame, visits: DataFrame, customers: DataFrame, dimension: str
) -> dict[str, DataFrame]:
    """KPI bar, the dimension's own figures, its box plot and its bins."""
    if dimension not in DIMENSIONS:
        raise ValueError(f"dimension must be one of {DIMENSIONS}")
    figures = {
        "recency": kpis.recency_kpis,
        "frequency": kpis.frequency_kpis,
        "monetary": kpis.monetary_kpis,
    }[dimension]
    bins = {
        "recency": lambda: segments.recency_bins(customers),
        "frequency": lambda: segments.frequency_bins(customers, visits),
        "monetary": lambda: segments.monetary_bins(customers),
    }[dimension]
    return {
        "kpi_bar": kpis.kpi_bar(raw, visits, customers),
        "figures": figures(customers),
        "box": charts.dimension_boxplot(customers, dimension),
        "bins": bins(),
    }
