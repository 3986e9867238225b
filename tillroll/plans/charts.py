"""Chart-ready shapes; drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.codes import MACRO_SEGMENTS
from ..functions.exact import average_money, cents
from ..operators.stats import box_plot

ROWS = "*"
TREEMAP_ROOT = "Tous segments"


def rf_heatmap_matrix(customers: DataFrame) -> DataFrame:
    """One row per frequency score, one column per recency score, zeros where nobody is."""
    return (
        customers.groupBy("f_score")
        .agg(*[F.count_if(F.col("r_score") == r).alias(f"r{r}") for r in range(1, 6)])
        .orderBy("f_score")
    )


def segment_treemap(customers: DataFrame) -> DataFrame:
    """Root and segments with size and mean amount, the root's mean over all customers."""
    return (
        customers.rollup("rfm_segment")
        .agg(
            F.grouping("rfm_segment").alias("is_root"),
            F.count(ROWS).alias("n"),
            average_money("monetary", 0).alias("avg_monetary"),
        )
        .select(
            F.when(F.col("is_root") == 1, TREEMAP_ROOT)
            .otherwise(F.col("rfm_segment"))
            .alias("label"),
            F.when(F.col("is_root") == 1, "").otherwise(TREEMAP_ROOT).alias("parent"),
            "n",
            "avg_monetary",
        )
        .orderBy("parent", "label")
    )


def monetary_boxplot(customers: DataFrame) -> DataFrame:
    return box_plot(
        customers, "monetary", cents(F.col("monetary")), scale=100, group="rfm_segment"
    ).orderBy("rfm_segment")


def dimension_boxplot(customers: DataFrame, dimension: str) -> DataFrame:
    if dimension == "monetary":
        return box_plot(customers, dimension, cents(F.col(dimension)), scale=100)
    return box_plot(customers, dimension, F.col(dimension))


def sankey_links(transitions: DataFrame) -> DataFrame:
    """Links between numbered nodes: left side first, then the right side, each by name.

    Windows run over at most (segments + 1) squared rows.
    """
    left = F.dense_rank().over(Window.orderBy("seg_from"))
    right = F.dense_rank().over(Window.orderBy("seg_to"))
    numbered = transitions.select("*", left.alias("l"), right.alias("r"))
    n_left = F.max("l").over(Window.partitionBy())
    return numbered.select(
        (F.col("l") - 1).alias("source"),
        (n_left + F.col("r") - 1).alias("target"),
        F.col("n_customers").alias("value"),
        F.col("seg_from").alias("source_label"),
        F.col("seg_to").alias("target_label"),
    ).orderBy("source", "target")


def sankey_nodes(transitions: DataFrame) -> DataFrame:
    """The nodes that the links number: ``node``, its ``side`` and ``label``."""
    ends = F.array(
        F.struct(F.lit("from").alias("side"), F.col("seg_from").alias("label")),
        F.struct(F.lit("to").alias("side"), F.col("seg_to").alias("label")),
    )
    nodes = transitions.select(F.explode(ends).alias("e")).select("e.*").distinct()
    by_side = Window.orderBy("side", "label")  # at most two rows per segment
    return nodes.select((F.row_number().over(by_side) - 1).alias("node"), "side", "label").orderBy("node")


def macro_movements_wide(movements: DataFrame) -> DataFrame:
    """One row per snapshot, customers and share of the four macro segments side by side."""
    macro = F.col("macro_segment")
    short = {name: name.split(".")[1].lower() for name in MACRO_SEGMENTS}
    return (
        movements.groupBy("snapshot_date")
        .agg(
            *[F.max(F.when(macro == m, F.col("n_users"))).alias(f"n_{s}") for m, s in short.items()],
            *[
                F.max(F.when(macro == m, F.col("pct_users"))).alias(f"pct_{s}")
                for m, s in short.items()
            ],
        )
        .orderBy("snapshot_date")
    )


def top_products_nested(top_products: DataFrame) -> DataFrame:
    """Products of each segment as one array, best first; its length is the top-n."""
    ordered = F.array_sort(
        F.collect_list(
            F.struct(
                (-F.col("revenue")).alias("by"), "stock_code", "description", "revenue"
            )
        )
    )
    return (
        top_products.groupBy("segment_label")
        .agg(ordered.alias("products"))
        .select(
            "segment_label",
            F.transform(
                "products",
                lambda p: F.struct(
                    p["stock_code"].alias("stock_code"),
                    p["description"].alias("description"),
                    p["revenue"].alias("revenue"),
                ),
            ).alias("products"),
        )
        .orderBy("segment_label")
    )
