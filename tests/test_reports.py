import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tillroll.functions.exact import average_money, percent
from tillroll.operators import cleaning, profiling, quality, scoring
from tillroll.operators.visits import visits
from tillroll.plans import charts, kpis, pages, products, segments
from tillroll.plans.warehouse import Warehouse


def customers_of(spark, *rows):
    names = "customer_id bigint, recency int, frequency bigint, monetary decimal(18,2)"
    names += ", r_score int, f_score int, m_score int, rfm_segment string"
    return spark.createDataFrame([(*r[:3], Decimal(r[3]), *r[4:]) for r in rows], names)


def test_kpi_bar_of_empty_tables_is_zero(spark, raw_of):
    raw = raw_of({"quantity": 0})
    sold = visits(cleaning.sales(raw))
    nobody = customers_of(spark, (1, 1, 1, "1", 1, 1, 1, "Lost")).where("customer_id < 0")
    row = kpis.kpi_bar(raw, sold, nobody).first().asDict()
    assert row.pop("total_raw_lines") == 1
    assert set(row.values()) == {0}


def test_rates_leave_out_single_buyers_of_the_middle(spark):
    people = customers_of(
        spark,
        (1, 90, 1, "10", 5, 1, 1, "Lost"),
        (2, 100, 1, "10", 5, 1, 1, "Lost"),
        (3, 180, 2, "10", 5, 1, 1, "Lost"),
        (4, 181, 2, "10", 5, 1, 1, "Lost"),
    )
    rates = people.agg(
        kpis.share_where((F.col("frequency") == 1) & (F.col("recency") <= 90)),
        kpis.share_where((F.col("frequency") > 1) & (F.col("recency") <= 180)),
        kpis.share_where(F.col("recency") > 180),
    ).first()
    assert [int(r) for r in rates] == [25, 25, 25]


def test_ratios_round_half_away(spark):
    frame = spark.createDataFrame([(1, 8), (1, 3), (0, 0), (-1, 8)], "a bigint, b bigint")
    got = [r[0] for r in frame.select(percent(F.col("a"), F.col("b"), 0)).collect()]
    assert got == [Decimal(13), Decimal(33), None, Decimal(-13)]
    money = spark.createDataFrame([(Decimal("0.49"),), (Decimal("0.50"),)], "m decimal(18,2)")
    assert money.agg(average_money("m", 2)).first()[0] == Decimal("0.50")


def test_mean_recency_is_cut_on_its_page_and_rounded_on_the_bar(spark):
    people = customers_of(spark, (1, 1, 1, "1", 1, 1, 1, "Lost"), (2, 2, 1, "1", 1, 1, 1, "Lost"))
    assert kpis.recency_kpis(people).first()["mean_recency"] == 1
    assert segments.recency_bins(people).first()["avg_metric"] == 2


def test_bin_edges(spark):
    edges = [(0, "A"), (7, "A"), (8, "B"), (30, "B"), (31, "C"), (90, "C"), (91, "D"), (180, "D"), (181, "E")]
    people = customers_of(spark, *[(i, d, 1, "1", 1, 1, 1, "Lost") for i, (d, _) in enumerate(edges)])
    found = {r["bin_label"][0]: r["users"] for r in segments.recency_bins(people).collect()}
    assert found == {"A": 2, "B": 2, "C": 2, "D": 2, "E": 1}
    money = ["10000.01", "10000", "3000.01", "3000", "1000.01", "1000", "300.01", "300"]
    people = customers_of(spark, *[(i, 1, 1, m, 1, 1, 1, "Lost") for i, m in enumerate(money)])
    rows = segments.monetary_bins(people).collect()
    assert [r["bin_label"] for r in rows][0] == "A.>10k £"
    assert [r["users"] for r in rows] == [1, 2, 2, 2, 1]


def test_top_customers_filter_and_ties(spark):
    people = customers_of(
        spark,
        (2, 1, 1, "5", 1, 1, 1, "Lost"),
        (1, 1, 1, "5", 1, 1, 1, "Champions"),
        (3, 1, 1, "9", 1, 1, 1, "Lost"),
    )
    ids = [r["customer_id"] for r in segments.top_customers(people, [], 2).collect()]
    assert ids == [3, 1]
    chosen = segments.parse_segments(" Lost, ,At Risk ")
    assert chosen == ["Lost", "At Risk"] and segments.parse_segments(None) == []
    assert [r["customer_id"] for r in segments.top_customers(people, chosen).collect()] == [3, 2]


def test_scatter_sample_has_the_asked_size(spark):
    people = Warehouse(spark, DATA).enriched()
    sample = segments.scatter_sample(people, 40)
    assert sample.count() == 40
    assert sample.exceptAll(segments.scatter_sample(people.repartition(7), 40)).isEmpty()


def test_top_products_stay_whole_for_a_hot_customer(spark, raw_of):
    lines = [{"customer_id": 1, "invoice": str(i), "stock_code": f"2000{i % 3}"} for i in range(30)]
    lines += [{"customer_id": 2, "stock_code": "20009", "description": None}]
    sold = cleaning.sales(raw_of(*lines))
    people = spark.createDataFrame([(1, "A"), (2, "A")], "customer_id bigint, segment_label string")
    rows = products.top_products_by_segment(sold, people, 2).collect()
    assert [(r["stock_code"], r["revenue"]) for r in rows] == [("20000", 10), ("20001", 10)]
    nested = charts.top_products_nested(products.top_products_by_segment(sold, people, 9)).first()
    assert [p["stock_code"] for p in nested["products"]] == ["20000", "20001", "20002", "20009"]


def test_sums_agree_across_reports(spark):
    w = Warehouse(spark, DATA)
    revenue = w.sales().agg(F.sum("line_amount")).first()[0]
    assert products.monthly_revenue(w.visits()).agg(F.sum("revenue")).first()[0] == revenue
    bubbles = segments.bubble_segments(w.enriched()).agg(F.sum("total_revenue")).first()[0]
    assert bubbles == revenue
    acquired = products.acquisitions_trend(w.first_purchases()).agg(F.sum("user_acquisitions"))
    assert acquired.first()[0] == w.customers().count()


def test_code_coverage_lists_all_codes_even_unused(spark):
    nobody = customers_of(spark, (1, 1, 1, "1", 5, 5, 5, "Champions"))
    rows = scoring.code_coverage(nobody).collect()
    assert len(rows) == 125 and rows[0]["code"] == "555" and rows[0]["n_customers"] == 1
    results = quality.run_checks("c", scoring.code_coverage(nobody), quality.coverage_suite())
    assert results.where("not passed").isEmpty()


def test_sankey_numbers_nodes_per_side(spark):
    moves = spark.createDataFrame(
        [("A", "A", 5), ("B", "A", 1), ("NOUVEAUX", "B", 2)],
        "seg_from string, seg_to string, n_customers bigint",
    )
    links = charts.sankey_links(moves).collect()
    assert [(r["source"], r["target"], r["value"]) for r in links] == [(0, 3, 5), (1, 3, 1), (2, 4, 2)]


def test_dimension_pages(spark):
    w = Warehouse(spark, DATA)
    for dimension in pages.DIMENSIONS:
        page = pages.dimension_page(w.raw(), w.visits(), w.customers(), dimension)
        assert page.keys() == {"kpi_bar", "figures", "box", "bins"}
        assert page["bins"].agg(F.sum("users")).first()[0] == w.customers().count()


def test_checks_on_missing_and_duplicate_values(spark):
    frame = spark.createDataFrame(
        [(1, "1"), (1, "x"), (None, None), (None, None), (2, "2")], "k int, t string"
    )
    checks = [
        quality.row_count(5, 6),
        quality.missing_count("k"),
        quality.missing_percent("k", 41),
        quality.duplicate_count("k"),
        quality.duplicate_count("k", "t"),
        quality.invalid_by_pattern("t", r"\A[0-9]+\z"),
        quality.invalid_by_values("t", "x"),
        quality.min_more_than("k", 0),
    ]
    rows = quality.run_checks("d", frame, checks).collect()
    found = {(r["check"]): (float(r["value"]), r["passed"]) for r in rows}
    assert found["row_count"] == (5.0, True)
    assert found["missing_count(k)"] == (2.0, False)
    assert found["missing_percent(k)"] == (40.0, True)
    assert found["duplicate_count(k)"] == (1.0, False)
    assert found["duplicate_count(k, t)"] == (0.0, True)
    assert found["invalid_count(t)"] == (1.0, False)
    assert found["min(k)"] == (1.0, True)
    empty = quality.run_checks("d", frame.where("k > 9"), [quality.min_more_than("k", 0)]).first()
    assert empty["value"] is None and empty["passed"] is False


def test_duplicates_of_lines_with_missing_values(raw_of):
    twin = {"customer_id": None, "description": None}
    lines = raw_of(twin, twin, twin, {}, {}, {"invoice": "9"})
    summary = profiling.exact_duplicates_summary(lines).first()
    assert (summary["duplicated_values"], summary["extra_lines"]) == (2, 3)
    assert summary["pct_extra"] == Decimal("50.00")
    assert profiling.exact_duplicates_sample(lines, 10).count() == 5
    assert profiling.exact_duplicates_sample(lines, 4).count() == 4


def test_description_repair(raw_of):
    lines = raw_of(
        {"stock_code": "1", "description": None},
        {"stock_code": "1", "description": None},
        {"stock_code": "1"},
        {"stock_code": "2", "description": None},
        {"stock_code": "3"},
    )
    row = profiling.description_repair_summary(lines).first()
    assert (row["codes_total"], row["codes_recoverable"], row["codes_lost"]) == (2, 1, 1)
    assert (row["lines_total"], row["lines_recoverable"], row["lines_lost"]) == (3, 2, 1)
    assert profiling.description_recoverable(lines).count() == 2
    assert profiling.description_unrecoverable(lines).count() == 1


def test_variant_codes(raw_of):
    codes = ["85099B", "85099b", "85099C", "15056N", "85123", "850991", "POST"]
    lines = raw_of(*[{"stock_code": c} for c in codes])
    row = profiling.sku_variant_summary(lines).first()
    assert (row["variant_lines"], row["variant_codes"], row["families"]) == (4, 4, 2)
    assert row["codes_per_family"] == Decimal("2.0")
    letters = {r["letter"]: r["n"] for r in profiling.sku_variant_letters(lines).collect()}
    assert letters == {"B": 2, "C": 1, "N": 1}
    same_root = profiling.sku_variants_of_root(lines, "85099B").collect()
    assert [r["stock_code"] for r in same_root] == ["850991", "85099B", "85099C", "85099b"]
    special = [r["stock_code"] for r in profiling.special_stock_codes(lines).collect()]
    assert special == ["POST"]


def test_profile_of_an_empty_column(raw_of):
    rows = profiling.column_profile(raw_of({"customer_id": None}, {"customer_id": None})).collect()
    found = {(r["column_name"], r["metric"]): r["value"] for r in rows}
    assert found["customer_id", "non_null"] == 0 and found["customer_id", "median"] is None
    assert found["quantity", "mean"] == 1.0 and found["invoice", "max_length"] == 6.0


def test_lower_case_needs_a_letter(raw_of):
    lines = raw_of(*[{"description": d} for d in ("check", "123", "Check", "?", "ok 1", None)])
    found = {r[0] for r in profiling.lowercase_descriptions(lines).collect()}
    assert found == {"check", "ok 1"}


def test_date_span(raw_of):
    lines = raw_of({"invoice_date": datetime(2010, 1, 2, 3)}, {"invoice_date": datetime(2011, 1, 1)})
    assert tuple(profiling.date_span(lines).first()) == (datetime(2010, 1, 2, 3), datetime(2011, 1, 1))
    assert date(2010, 1, 2) < date(2011, 1, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_duplicate_keys_of_ids_are_counted_exactly(spark, seed):
    rng = random.Random(seed)
    ids = [*range(-70, 200), 2**62, -(2**63), 2**63 - 1, None]
    rows = [(rng.choice([None, "a", "b"]), rng.choice(ids)) for _ in range(700)]
    frame = spark.createDataFrame(rows, "d string, id bigint").repartition(5)
    for columns in (("id",), ("d", "id")):
        keys = [k for k in ((i,) if len(columns) == 1 else (d, i) for d, i in rows) if None not in k]
        expected = sum(n > 1 for n in Counter(keys).values())
        assert quality.duplicated_keys(frame, columns).first()["value"] == expected > 0
        once = frame.dropna("any").dropDuplicates(list(columns))
        assert quality.duplicated_keys(once, columns).first()["value"] == 0
        assert quality.duplicated_keys(frame.limit(0), columns).first()["value"] == 0


def test_neighbouring_ids_share_a_row_of_the_duplicate_count(spark, monkeypatch):
    """Ids that occur once are not grouped one by one, which took memory for every key."""
    kept = []

    def spy(frame, name):
        kept.append(frame.count())
        return frame

    monkeypatch.setattr(quality, "materialize", spy)
    frame = spark.range(10_000).union(spark.createDataFrame([(77,)], "id bigint"))
    assert quality.duplicated_keys(frame, ("id",)).first()["value"] == 1
    assert kept == [1]
