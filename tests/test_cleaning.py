from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import cleaning


def buckets(frame):
    return [r["bucket"] for r in cleaning.route(frame).collect()]


STOCK = {"description": None, "customer_id": None, "price": "0"}


def test_unknown_predicates_reach_no_bucket(raw_of):
    lines = raw_of(
        {"description": None, "customer_id": None, "price": None},
        {"invoice": None, **STOCK},
        {"invoice": None},
        {"stock_code": None},
        {"invoice": "C1", **STOCK},
        {"invoice": "C1"},
        {"customer_id": None},
        {"quantity": 0},
        {"price": "-1"},
        {"price": None},
        {},
    )
    assert buckets(lines) == [
        "rejected",
        "stock_movements",
        "rejected",
        "rejected",
        "stock_movements",
        "cancellations",
        "rejected",
        "rejected",
        "rejected",
        "rejected",
        "sales",
    ]


def test_code_pattern_is_anchored_and_case_sensitive(raw_of):
    codes = {
        "M": True, "m": False, "MEDIUM": False, "MUG": False, "M\n": False, "gift_": True,
        "gift_0001_20": True, "TESTX": True, "TEST\n1": True, "C2": True, "C2X": False,
        "BANK CHARGES": True, "DCGS0003": True, "XPOST": False,
    }
    found = buckets(raw_of(*[{"stock_code": c} for c in codes]))
    assert found == ["non_product_lines" if odd else "sales" for odd in codes.values()]


def test_amount_is_rounded_per_line(raw_of):
    lines = raw_of({"price": "1.005"}, {"price": "1.004"}, {"quantity": 3, "price": "0.335"})
    amounts = [r["line_amount"] for r in cleaning.sales(lines).collect()]
    assert amounts == [Decimal("1.01"), Decimal("1.00"), Decimal("1.01")]


def test_buckets_are_the_filters_and_add_up(spark, raw_of):
    lines = raw_of({}, STOCK, {"invoice": "C9"}, {"stock_code": "POST"}, {"price": None})
    audit = cleaning.audit(lines).first()
    assert audit["n_total_routed"] + audit["n_rejected"] == audit["n_raw"] == 5
    assert audit["pct_rejected"] == Decimal("20.00")
    for name in (*cleaning.BUCKETS, cleaning.REJECTED):
        assert cleaning.bucket(lines, name).count() == 1


def test_audit_of_nothing(raw_of):
    audit = cleaning.audit(raw_of({}).where(F.lit(False))).first()
    assert audit["n_raw"] == 0 and audit["pct_rejected"] is None


def test_sales_filter_reaches_the_scan(spark, raw_of, tmp_path, plan_of):
    raw_of({}).write.parquet(str(tmp_path / "raw"))
    plan = plan_of(cleaning.sales(spark.read.parquet(str(tmp_path / "raw"))))
    for pushed in ("IsNotNull(customer_id)", "GreaterThan(quantity,0)", "StringStartsWith"):
        assert pushed in plan


def test_csv_written_by_a_csv_writer_reads_back(spark, tmp_path):
    import csv

    from tillroll.sources.readers import read_retail_csv
    from tillroll.sources.schemas import RAW

    said = ['COLOUR "LEIS"', 'BOX "A", LARGE', "ends in \\", "two\nlines"]
    for names, multi_line in ((said[:3], False), (said, True)):
        path = tmp_path / f"{multi_line}.csv"
        with path.open("w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(RAW.names)
            for name in names:
                writer.writerow(["1", "2", name, "3", "2011-01-02 03:04:05", "1.500", "7", "FRANCE"])
        read = read_retail_csv(spark, str(path), multi_line=multi_line)
        assert sorted(r["description"] for r in read.collect()) == sorted(names)
        assert sorted(r[0] for r in read.select("description").collect()) == sorted(names)


def test_sales_need_a_date(raw_of):
    from tillroll.operators import cleaning

    lines = raw_of({}, {"invoice_date": None})
    assert cleaning.sales(lines).count() == 1
