"""Fixed bins of the three dimensions; a missing value falls into the last bin."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def recency_bin(days: Column) -> Column:
    return (
        F.when(days.between(0, 7), "A.0-7 days")
        .when(days.between(8, 30), "B.8-30 days")
        .when(days.between(31, 90), "C.31-90 days")
        .when(days.between(91, 180), "D.91-180 days")
        .otherwise("E.>180 days")
    )


def frequency_bin(invoices: Column) -> Column:
    return (
        F.when(invoices >= 11, "A.>10 #")
        .when(invoices >= 6, "B.6-10 #")
        .when(invoices >= 3, "C.3-5 #")
        .when(invoices == 2, "D.2 #")
        .otherwise("E.1 #")
    )


def monetary_bin(amount: Column) -> Column:
    return (
        F.when(amount > 10000, "A.>10k £")
        .when(amount > 3000, "B.3k-10k £")
        .when(amount > 1000, "C.1k-3k £")
        .when(amount > 300, "D.301-1k £")
        .otherwise("E.0-300 £")
    )
