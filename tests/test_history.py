from datetime import date, datetime

import pytest
from pyspark.sql import Window, functions as F

from conftest import DATA
from tillroll.operators import cleaning, history
from tillroll.operators.visits import visits
from tillroll.plans import movements
from tillroll.plans.warehouse import Warehouse


@pytest.fixture
def tricky(raw_of):
    """Month ends at both sides of midnight, invoices over two days, months and customers."""
    return cleaning.sales(
        raw_of(
            {"customer_id": 1, "invoice": "1", "invoice_date": datetime(2011, 12, 31, 23, 59)},
            {"customer_id": 1, "invoice": "2", "invoice_date": datetime(2012, 1, 1, 0, 1)},
            {"customer_id": 2, "invoice": "3", "invoice_date": datetime(2012, 1, 31, 9)},
            {"customer_id": 2, "invoice": "3", "invoice_date": datetime(2012, 2, 1, 9)},
            {"customer_id": 3, "invoice": "3", "invoice_date": datetime(2012, 3, 30, 9)},
            {"customer_id": 3, "invoice": "4", "invoice_date": datetime(2012, 4, 29, 9)},
            {"customer_id": 3, "invoice": "5", "invoice_date": datetime(2012, 4, 30, 9)},
            {"customer_id": 4, "invoice": "6", "invoice_date": datetime(2012, 4, 30, 9)},
        )
    )


def by_theta_join(sales, calendar):
    """Every sale paired with every later snapshot."""
    day = F.to_date("invoice_date")
    return (
        sales.join(calendar, day <= F.col("snapshot_date"))
        .groupBy("snapshot_date", "customer_id")
        .agg(
            F.max(day).alias("last"),
            F.count_distinct("invoice_id").alias("frequency"),
            F.sum("line_amount").cast("decimal(18,2)").alias("monetary"),
        )
        .select(
            "snapshot_date",
            "customer_id",
            (F.datediff("snapshot_date", "last") + 1).alias("recency"),
            "frequency",
            "monetary",
        )
    )


@pytest.mark.parametrize(
    "kind, days",
    [("month_end", (31, 31, 29, 31, 30)), ("iterative", (31, 31, 29, 29, 29))],
)
def test_calendar_over_a_leap_february(tricky, kind, days):
    dates = [r[0] for r in history.snapshot_calendar(visits(tricky), kind).collect()]
    months = [(2011, 12), (2012, 1), (2012, 2), (2012, 3), (2012, 4)]
    assert dates == [date(y, m, d) for (y, m), d in zip(months, days)]


@pytest.mark.parametrize("kind", history.CALENDARS)
def test_history_equals_the_theta_join(spark, tricky, kind):
    for sales in (tricky, Warehouse(spark, DATA).sales()):
        sold = visits(sales)
        ours = history.history_base(sold, kind)
        plain = by_theta_join(sales, history.snapshot_calendar(sold, kind))
        assert ours.count() > 0
        assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


@pytest.mark.parametrize("small", [20, 100_000])
def test_history_scores_equal_a_window_per_snapshot(spark, small):
    base = Warehouse(spark, DATA).history_base()
    ours = history.history_scores(base, history.history_starts(base, small))

    def ntile(column):
        return F.ntile(5).over(Window.partitionBy("snapshot_date").orderBy(column, "customer_id"))

    plain = base.select(
        "snapshot_date",
        "customer_id",
        (6 - ntile("recency")).alias("r_score"),
        ntile("frequency").alias("f_score"),
        ntile("monetary").alias("m_score"),
    )
    assert ours.select(*plain.columns).exceptAll(plain).isEmpty()
    assert ours.count() == plain.count()


def test_no_sale_is_paired_with_all_snapshots(spark, plan_of):
    w = Warehouse(spark, DATA)
    plan = plan_of(history.history_base(w.visits()))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Exchange SinglePartition" not in plan
    scored = plan_of(w.scored_history())
    assert "Window" not in scored and "Sort" not in scored


def test_states_are_dealt_for_the_write_and_not_rows(spark, plan_of):
    """A task has a bounded number of rows, of few snapshots; the starting code dealt and sorted whole rows."""
    w = Warehouse(spark, DATA)
    states, calendar = w.history_states(), history.numbered_calendar(w.visits())
    plain, dealt = history.repeated(states, calendar), history.by_snapshot(states, 12, 1000)
    rows = history.repeated(dealt, calendar)
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    assert dealt.count() < plain.count() / 3
    tasks = rows.groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("n"), F.count_distinct("snapshot_date").alias("dates")
    )
    most = tasks.agg(F.count("*"), F.max("n"), F.max("dates")).first()
    assert most[0] > 20 and most[1] < 3000 and most[2] <= 24
    plan = plan_of(rows)
    assert plan.index("Generate explode(sequence(since") < plan.index("Exchange rangepartitioning")
    assert plan.count("Exchange") == plan.count("BroadcastExchange") + 1


def test_history_base_is_not_stored(spark):
    w = Warehouse(spark, DATA)
    assert w.history_base().count() == 25471
    assert not [key for key in w._stages._stored if str(key[0]).startswith("history_base")]


def test_dealt_states_of_an_empty_history(spark, raw_of):
    sold = visits(cleaning.sales(raw_of({"quantity": 0})))
    dealt = history.by_snapshot(history.history_states(sold))
    assert history.repeated(dealt, history.numbered_calendar(sold)).isEmpty()


def test_last_snapshot_agrees_with_the_customers(spark):
    w = Warehouse(spark, DATA)
    last = w.history().where(F.col("snapshot_date") == w.history().agg(F.max("snapshot_date")).scalar())
    columns = ["customer_id", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_segment"]
    ours, theirs = last.select(*columns), w.customers().select(*columns)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_a_customer_never_shrinks(spark):
    step = Window.partitionBy("customer_id").orderBy("snapshot_date")
    frame = Warehouse(spark, DATA).history_base()
    worse = frame.select(
        *[(F.col(c) < F.lag(c).over(step)).alias(c) for c in ("frequency", "monetary")]
    )
    assert worse.where("frequency or monetary").isEmpty()


def test_empty_history(raw_of):
    assert history.history_base(visits(cleaning.sales(raw_of({"quantity": 0})))).isEmpty()


def test_unknown_calendar(tricky):
    with pytest.raises(ValueError):
        history.snapshot_calendar(visits(tricky), "weekly")


@pytest.fixture
def small_history(spark):
    rows = [
        (date(2011, 1, 31), 1, "Champions", "A.LOYAL"),
        (date(2011, 2, 28), 1, "Lost", "D.LOST"),
        (date(2011, 2, 28), 2, "Odd", "Z.UNCLASSIFIED"),
        (date(2011, 3, 31), 1, "Lost", "D.LOST"),
    ]
    return spark.createDataFrame(
        rows, "snapshot_date date, customer_id bigint, rfm_segment string, macro_segment string"
    )


def test_transitions_forward_and_reversed(small_history):
    def pairs(*args):
        found = movements.segment_transitions(small_history, *args).collect()
        return [tuple(r) for r in found]

    jan, feb = date(2011, 1, 31), date(2011, 2, 28)
    assert pairs(jan, feb) == [("A.LOYAL", "D.LOST", 1), ("NOUVEAUX", "Z.UNCLASSIFIED", 1)]
    assert pairs(feb, jan) == [("D.LOST", "A.LOYAL", 1), ("Z.UNCLASSIFIED", "DISPARUS", 1)]
    assert pairs("2011-01-31", "2011-02-28", "detailed") == [
        ("A.CHAMPIONS", "K.LOST", 1),
        ("NOUVEAUX", "Odd", 1),
    ]
    assert pairs(jan, jan) == [("A.LOYAL", "A.LOYAL", 1)]
    assert movements.latest_snapshots(small_history) == (feb, date(2011, 3, 31))


def test_transition_parameters_are_checked(small_history):
    with pytest.raises(ValueError):
        movements.segment_transitions(small_history, "2011-01-31", "2011-02-28", "segment")
    with pytest.raises(ValueError):
        movements.segment_transitions(small_history, "31/01/2011", "2011-02-28")


def test_transitions_read_two_snapshots_only(spark, plan_of):
    w = Warehouse(spark, DATA)
    pair = movements.latest_snapshots(w.history())
    plan = plan_of(movements.segment_transitions(w.history(), *pair))
    assert "PartitionFilters: [snapshot_date" in plan
    assert "Join" not in plan


def test_transitions_add_up(spark):
    w = Warehouse(spark, DATA)
    pair = movements.latest_snapshots(w.history())
    total = movements.segment_transitions(w.history(), *pair).agg(F.sum("n_customers")).first()[0]
    known = w.history().where(F.col("snapshot_date").isin(*pair)).select("customer_id").distinct()
    assert total == known.count()
