"""Retail lines derived from an order schema (orders, lines, customers, parts).

The rule for every column is listed in FIXTURES.md section 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .readers import as_raw


def _divides(column: Column, by: int) -> Column:
    return column % by == 0


def retail_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines as ``raw`` retail lines.

    Join sides are left to Catalyst and AQE: nation is a handful of rows, the others
    are broadcast only when their measured size allows it, and a hot order or part is
    split by the skew join.
    """

    def table(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{directory}/{name}.parquet").select(*columns)

    homes = table("customer", "c_custkey", "c_nationkey").join(
        table("nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table("orders", "o_orderkey", "o_custkey", "o_orderdate").join(
        homes, F.col("o_custkey") == F.col("c_custkey")
    )
    joined = (
        table("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            table("part", "p_partkey", "p_name", "p_retailprice"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
    )
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")

    internal = _divides(order * 7 + line, 241)
    cancelled = _divides(order, 53)
    unit = (F.col("p_retailprice").cast("decimal(12,2)") * F.lit("0.01").cast("decimal(2,2)")).cast(
        "decimal(10,3)"
    )
    plain_code = (part + 10000).cast("string")
    letter = F.char(part % 24 + 65)
    code = (
        F.when(part % 211 == 0, "POST")
        .when(part % 211 == 1, "M")
        .when(part % 211 == 2, F.concat(F.lit("gift_0001_"), (part % 30).cast("string")))
        .when(part % 211 == 3, "TEST001")
        .when(part % 211 == 4, "BANK CHARGES")
        .when(part % 211 == 5, "MUG")
        .when(_divides(part, 8), F.concat(plain_code, letter))
        .otherwise(plain_code)
    )
    quantity = F.col("l_quantity").cast("int")
    owner = F.col("o_custkey") * 10
    rows = joined.select(
        F.concat(
            F.when(cancelled, "C").otherwise(""), (F.col("o_orderkey") + 500000).cast("string")
        ).alias("invoice"),
        code.alias("stock_code"),
        F.when(internal | (part % 401 == 7), None)
        .when(_divides(part, 37), F.col("p_name"))
        .otherwise(F.upper("p_name"))
        .alias("description"),
        F.when(cancelled | _divides(order + line, 307), -quantity)
        .otherwise(quantity)
        .alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(_divides(order * 5 + line, 1009), None)
        .when(internal | _divides(order * 3 + line, 587), F.lit(0).cast("decimal(10,3)"))
        .when(_divides(order + line, 1511), -unit)
        .otherwise(unit)
        .alias("price"),
        F.when(_divides(order, 9) | internal, None)
        .when(_divides(F.col("o_custkey"), 20) | (order % 16 < 10), owner)
        .otherwise(owner + order % 16 - 9)
        .alias("customer_id"),
        F.col("n_name").alias("country"),
        # some lines occur twice; repeating them here saves a second scan and join
        F.explode(
            F.when(_divides(order, 101) & (line == 1), F.array(F.lit(1), F.lit(2))).otherwise(
                F.array(F.lit(1))
            )
        ).alias("copy"),
    )
    return as_raw(rows)
