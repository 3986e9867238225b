from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from conftest import DATA
from tillroll.functions import codes
from tillroll.operators import cleaning, scoring
from tillroll.operators.visits import first_purchases, visits
from tillroll.plans.views import register_functions
from tillroll.plans.warehouse import Warehouse


def at(day, hour=12, month=5):
    return datetime(2011, month, day, hour)


def visits_of(raw):
    return visits(cleaning.sales(raw))


def test_recency_counts_days_not_hours(raw_of):
    sold = visits_of(
        raw_of(
            {"customer_id": 1, "invoice_date": datetime(2011, 5, 31, 23, 59)},
            {"customer_id": 2, "invoice": "2", "invoice_date": datetime(2011, 6, 1, 0, 1)},
        )
    )
    recency = {r["customer_id"]: r["recency"] for r in scoring.rfm_base(sold).collect()}
    assert recency == {1: 2, 2: 1}


def test_invoice_counts_once_per_customer(raw_of):
    sold = visits_of(
        raw_of(
            {"invoice": "1", "customer_id": 1, "invoice_date": at(30)},
            {"invoice": "1", "customer_id": 1, "invoice_date": at(2, month=6)},
            {"invoice": "1", "customer_id": 2, "invoice_date": at(30)},
            {"invoice": "1", "customer_id": 2, "invoice_date": at(30, 13), "price": "2.005"},
        )
    )
    base = {r["customer_id"]: r for r in scoring.rfm_base(sold).collect()}
    assert {c: r["frequency"] for c, r in base.items()} == {1: 1, 2: 1}
    assert base[2]["monetary"] == Decimal("3.01")
    first = {r["customer_id"]: r for r in first_purchases(sold).collect()}
    assert str(first[1]["first_purchase_dt"]) == "2011-05-30"
    assert str(first[1]["acquisition_month"]) == "2011-05-01"


def test_fewer_customers_than_buckets(raw_of):
    base = scoring.rfm_base(
        visits_of(
            raw_of(
                *[
                    {"customer_id": c, "invoice": str(c), "invoice_date": at(10 - c)}
                    for c in (1, 2, 3)
                ]
            )
        )
    )
    scored = {r["customer_id"]: r for r in scoring.score_customers(base).collect()}
    assert [scored[c]["r_score"] for c in (1, 2, 3)] == [5, 4, 3]
    assert [scored[c]["f_score"] for c in (1, 2, 3)] == [1, 2, 3]


def test_no_sales_raise(raw_of):
    with pytest.raises(scoring.NoSales):
        scoring.require_sales(visits_of(raw_of({"quantity": -1})))


@pytest.mark.parametrize("small", [10, 100_000])
def test_scores_are_those_of_a_global_window(spark, small):
    base = Warehouse(spark, DATA).rfm_base()
    ours = scoring.with_scores(base, scoring.quintile_starts(base, small=small))

    def ntile(column):
        return F.ntile(5).over(Window.orderBy(column, "customer_id"))

    plain = base.select(
        "*",
        (6 - ntile("recency")).alias("r_score"),
        ntile("frequency").alias("f_score"),
        ntile("monetary").alias("m_score"),
    )
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_scoring_neither_sorts_nor_gathers_customers(spark, plan_of):
    plan = plan_of(Warehouse(spark, DATA).scored())
    for bad in ("Window", "Exchange", "Sort", "NestedLoop", "Cartesian"):
        assert bad not in plan


def test_code_table_is_complete():
    assert len(codes.CODE_SEGMENT) == 125
    sizes = {s: len(c.split()) for s, c in codes.SEGMENT_CODES.items()}
    assert sum(sizes.values()) == 125
    assert list(sizes.values()) == [7, 8, 24, 7, 16, 8, 8, 22, 8, 11, 6]
    assert codes.SEGMENT_MACRO.keys() == codes.SEGMENT_LABELS.keys() == sizes.keys()


def test_segments_of_codes_inside_and_outside(spark):
    rows = [(int(c[0]), int(c[1]), int(c[2]), s) for c, s in codes.CODE_SEGMENT.items()]
    rows += [(0, 1, 1, "Unclassified"), (1, 6, 1, "Unclassified"), (None, 1, 1, "Unclassified")]
    frame = spark.createDataFrame(rows, "r int, f int, m int, expected string")
    found = codes.segment_of(F.col("r"), F.col("f"), F.col("m"))
    assert frame.where(~found.eqNullSafe(F.col("expected"))).isEmpty()
    outside = spark.sql("select 'Unclassified' as s")
    row = outside.select(codes.macro_of(F.col("s")), codes.label_of(F.col("s"))).first()
    assert tuple(row) == ("Z.UNCLASSIFIED", "Z.UNCLASSIFIED")


def test_sql_functions_agree(spark):
    register_functions(spark)
    rows = [(int(c[0]), int(c[1]), int(c[2])) for c in (*codes.CODE_SEGMENT, "611")]
    spark.createDataFrame(rows, "r int, f int, m int").createOrReplaceTempView("triples")
    found = spark.sql(
        "SELECT r, f, m, fn_rfm_segment(r, f, m) s, fn_rfm_macro(fn_rfm_segment(r, f, m)) g FROM triples"
    ).collect()
    for row in found:
        segment = codes.CODE_SEGMENT.get(f"{row.r}{row.f}{row.m}", "Unclassified")
        assert row.s == segment
        assert row.g == codes.SEGMENT_MACRO.get(segment, "Z.UNCLASSIFIED")
