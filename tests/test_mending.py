"""Repaired and repeated lines, marks, bounds of products, dimensions and countries on small tables."""

import random
from collections import Counter
from decimal import Decimal

import pytest

from tillroll.operators import dimensions, mending, sketches, winsor
from tillroll.operators.cleaning import as_sales, bucket
from tillroll.sources.schemas import RAW


def rows(frame):
    return Counter(map(tuple, frame.collect()))


def test_descriptions_come_from_the_most_frequent_one(raw_of):
    raw = raw_of(
        *({"stock_code": "1", "description": d} for d in ("B", "B", "A", "A", "C", None)),
        {"stock_code": "2", "description": None},
        {"stock_code": None, "description": None},
        {"stock_code": None, "description": "LOST"},
    )
    mended = mending.repaired(raw)
    assert mended.columns == [*RAW.names, "description_source"]
    found = Counter((r["stock_code"], r["description"], r["description_source"]) for r in mended.collect())
    assert found == Counter(
        [("1", "B", "given")] * 2 + [("1", "A", "given")] * 2 + [("1", "C", "given"), ("1", "A", "code")]
        + [("2", None, "none"), (None, None, "none"), (None, "LOST", "given")]
    )
    assert {r[0]: r[1:] for r in mending.repair_counts(mended).collect()} == {"given": (6, 1), "code": (1, 1), "none": (2, 1)}


@pytest.mark.parametrize("keep, lines, removed", [("one", 4, 302), ("plausible", 5, 301)])
def test_kept_and_removed_lines_add_up(raw_of, keep, lines, removed):
    raw = raw_of(*[{"customer_id": None}] * 302, {"quantity": 2}, {"quantity": 2}, {"quantity": 3}, {"description": None})
    kept, ledger = mending.deduplicated(raw, keep), mending.removal_ledger(raw, keep)
    assert kept.count() == lines and kept.columns == RAW.names
    assert ledger.count() == 2 and sum(r["n_removed"] for r in ledger.collect()) == removed
    assert kept.count() + removed == raw.count()
    with pytest.raises(ValueError):
        mending.deduplicated(raw, "all")


def test_copies_are_summed_before_they_are_shuffled(raw_of, plan_of):
    plan = plan_of(mending.deduplicated(raw_of({"quantity": 2})))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_subtypes_add_up_and_the_first_rule_counts(raw_of):
    codes = ["POST", "DOT", "M", "S", "BANK CHARGES", "gift_1", "TEST2", "PADS", "DCGS1", "10001", None]
    raw = raw_of(*({"stock_code": c} for c in codes))
    lines = bucket(raw, "non_product_lines")
    counts = {r["subtype"]: r["n_lines"] for r in mending.non_product_subtypes(lines).collect()}
    assert counts == {"postage": 2, "adjustment": 2, "fee": 1, "gift_card": 1, "test": 1, "other": 2}
    assert sum(counts.values()) == lines.count()
    first = mending.subtype((("any", "prefix", ("T", "P")), ("postage", "code", ("POST",))))
    assert {r[0] for r in raw.where("stock_code = 'POST'").select(first).collect()} == {"any"}


def test_marks(raw_of):
    marks = ("is_anonymous", "is_adjustment", "is_freebie", "freebie_kind")
    lines = {
        "plain": ({}, (False, False, False, None)),
        "movement": ({"description": None, "customer_id": None, "price": "0", "quantity": -1}, (False, False, False, None)),
        "anonymous": ({"customer_id": None}, (True, False, False, None)),
        "cancelled": ({"invoice": "C1", "quantity": -1}, (False, False, False, None)),
        "adjusted": ({"quantity": -1}, (False, True, False, None)),
        "note": ({"price": "0", "description": "damages"}, (False, False, True, "note")),
        "bare": ({"price": "-1", "description": None}, (False, False, True, "note")),
        "free": ({"price": "0"}, (False, False, True, "product")),
        "unknown": ({"price": None, "quantity": None, "invoice": None}, (False, False, False, None)),
    }
    for line, expected in lines.values():
        (found,) = mending.flagged(raw_of(line)).collect()
        assert tuple(found[m] for m in marks) == expected, line


def nearest_rank(values, percent):
    values = sorted(values)
    return values[-(-len(values) * percent // 100) - 1]


@pytest.mark.parametrize("percent", [1, 50, 99, 100])
def test_bounds_of_hot_and_rare_products(raw_of, percent):
    rng = random.Random(percent)
    lines = [{"stock_code": "HOT", "quantity": rng.randint(1, 5000), "price": f"{rng.randint(1, 9999) / 1000:.3f}"} for _ in range(1500)]
    lines += [{"stock_code": rng.choice("abcdef"), "quantity": rng.randint(1, 4), "price": "1.500"} for _ in range(200)]
    lines += [{"stock_code": "one"}, {"stock_code": None, "quantity": 7}, {"stock_code": None, "quantity": 9}]
    sales = as_sales(raw_of(*lines))
    bounds = {r["stock_code"]: r for r in winsor.product_bounds(sales, percent).collect()}
    codes = {line["stock_code"] for line in lines}
    assert bounds.keys() == codes
    for code in codes:
        own = [line for line in lines if line["stock_code"] == code]
        assert bounds[code]["n_lines"] == len(own)
        assert bounds[code]["quantity_bound"] == nearest_rank([x.get("quantity", 1) for x in own], percent)
        assert bounds[code]["price_bound"] == nearest_rank([Decimal(x.get("price", "1.000")) for x in own], percent)


def test_winsorised_lines_keep_every_line(raw_of):
    sales = as_sales(raw_of(*({"quantity": q, "price": f"{q}.000"} for q in range(1, 201))))
    lines = winsor.winsorised(sales, winsor.product_bounds(sales))
    assert lines.count() == 200 and lines.where("is_capped").count() == 2
    assert lines.where("is_capped").selectExpr("max(quantity_capped)", "max(unit_price_capped)").first()[:] == (198, Decimal("198.000"))
    (row,) = winsor.winsorised_products(lines).collect()
    assert row["n_capped"] == 2 and row["revenue_capped"] == sum(min(q, 198) ** 2 for q in range(1, 201))
    assert winsor.product_bounds(sales.limit(0)).count() == 0


def test_keys_stay_over_loads(spark):
    def members(*names):
        return spark.createDataFrame([(n,) for n in names], "family_code string")

    def keys(frame):
        return {r["family_code"]: (r["family_key"], r["load"]) for r in frame.collect()}

    one = dimensions.extended(None, members("c", "a", "b", "a", None), "family_code", "family_key", "first")
    two = dimensions.extended(one, members("b", "aa", "z", "aa"), "family_code", "family_key", "second")
    three = dimensions.extended(two, members("a", "z"), "family_code", "family_key", "third")
    assert keys(one) == {"a": (1, "first"), "b": (2, "first"), "c": (3, "first")}
    assert keys(two) == keys(one) | {"aa": (4, "second"), "z": (5, "second")} == keys(three)
    many = members(*(f"{i:04d}" for i in range(2000)))
    assert keys(dimensions.extended(None, many, "family_code", "family_key", "x")) == {f"{i:04d}": (i + 1, "x") for i in range(2000)}
    none = dimensions.extended(None, members(), "family_code", "family_key", "x")
    assert keys(dimensions.extended(none, members("q"), "family_code", "family_key", "y")) == {"q": (1, "y")}


def test_variants(raw_of):
    raw = raw_of(*({"stock_code": c} for c in ("12345A", "12345b", "12345", "POST", "123456", None)))
    found = {r["stock_code"]: (r["family_code"], r["variant_code"]) for r in dimensions.product_variants(raw).collect()}
    assert found == {
        "12345A": ("12345", "A"), "12345b": ("12345", "b"), "12345": ("12345", None), "POST": ("POST", None), "123456": ("123456", None),
    }


def test_countries(spark, raw_of):
    raw = raw_of(*({"country": c} for c in ("France", "  united  kingdom", "EIRE", "Unspecified", None, " ", "FRANSE", "GERMNAY", "ATLANTIS", "IRA")))
    table = dimensions.country_table(spark)
    mapped = dimensions.mapped_countries(raw, table)
    found = {r["country"]: (r["iso_code"], r["status"]) for r in mapped.collect()}
    assert found["France"] == ("FR", "mapped") and found["  united  kingdom"] == ("GB", "mapped") and found["EIRE"] == ("IE", "mapped")
    assert {found[c] for c in ("Unspecified", None, " ")} == {("unknown", "unknown")}
    assert {found[c] for c in ("FRANSE", "GERMNAY", "ATLANTIS", "IRA")} == {(None, "unmatched")}
    hints = {r["country"]: (r["suggestion"], r["distance"]) for r in dimensions.country_suggestions(mapped, table).collect()}
    assert hints == {"FRANSE": ("FRANCE", 1), "GERMNAY": ("GERMANY", 2), "IRA": ("IRAN", 1)}


def test_suggestions_miss_nothing_within_two_edits(spark):
    rng = random.Random(2)
    names = {"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(120)}
    listed = dict.fromkeys(list(names)[:60], "XX")
    asked = sorted(names - listed.keys())

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    frame = spark.createDataFrame([(n, None, "unmatched", 1) for n in asked], "country string, iso_code string, status string, n_lines long")
    table = dimensions.country_table(spark, {n.upper(): c for n, c in listed.items()})
    found = {r["country"]: (r["distance"], r["suggestion"]) for r in dimensions.country_suggestions(frame, table).collect()}
    expected = {}
    for name in asked:
        best = min((distance(name.upper(), n.upper()), n.upper()) for n in listed)
        if best[0] <= 2:
            expected[name] = best
    assert found == expected


def test_sketches_of_spans_do_not_read_customers(spark):
    values = [(f"2011-0{1 + i % 6}-28", i, (i * 7919) % 30_011, i % 97, Decimal(i % 5003)) for i in range(30_000)]
    history = spark.createDataFrame(values, "day string, customer_id long, recency int, frequency long, monetary decimal(18,2)")
    history = history.selectExpr("to_date(day) AS snapshot_date", "customer_id", "recency", "frequency", "monetary")
    stored = sketches.snapshot_sketches(history).cache()
    for first, last in ((None, None), ("2011-02-01", "2011-04-30"), ("2011-06-28", "2011-06-28")):
        inside = history
        if first:
            inside = history.where(f"snapshot_date BETWEEN '{first}' AND '{last}'")
        answers = sketches.span_quantiles(stored, first, last, (1, 25, 50, 75, 99))
        errors = sketches.rank_errors(inside, answers, [])
        assert errors.count() == 15
        assert errors.selectExpr("max(rank_error)", "max(n)").first()[:] <= (sketches.RANK_ERROR, inside.count())
    assert sketches.span_quantiles(stored, "1999-01-01", "1999-02-01").count() == 0


def test_distinct_sketches_take_one_scan_and_merge(raw_of, plan_of):
    one = raw_of(*({"invoice": str(i), "country": None, "quantity": i % 7} for i in range(3000)))
    two = raw_of(*({"invoice": str(i), "country": "X", "quantity": i % 9} for i in range(2000, 4000)))
    merged = sketches.column_sketches(one).union(sketches.column_sketches(two))
    found = {r["column_name"]: (r["non_null"], r["n_distinct"]) for r in sketches.approx_distinct(merged).collect()}
    assert found["country"] == (2000, 1) and found["quantity"] == (5000, 9)
    assert abs(found["invoice"][1] - 4000) <= 4000 * sketches.DISTINCT_ERROR
    plan = plan_of(sketches.approx_distinct(sketches.column_sketches(one)))
    assert plan.count("Scan") == 1
    checked = sketches.distinct_within_error(one, sketches.approx_distinct(sketches.column_sketches(one)))
    assert {r["within_error"] for r in checked.collect()} == {True} and checked.count() == 8
