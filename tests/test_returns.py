"""Cancellation links against a queue of sales, and the plans without pair joins."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from tillroll.operators import returns


def by_queue(lines):
    """Links by going through each customer's and code's lines in order of time."""
    sold, back = Counter(), Counter()
    for line in lines:
        key = line["customer_id"], line["stock_code"], line["invoice_date"], line["invoice"]
        if line["invoice"].startswith("C"):
            if line["quantity"] < 0:
                back[key] -= line["quantity"]
        elif line["quantity"] > 0 and None not in key[:3]:
            sold[key] += line["quantity"]
    events = sorted(
        [(c, s, t, 0, i, u) for (c, s, t, i), u in sold.items()]
        + [(c, s, t, 1, i, u) for (c, s, t, i), u in back.items() if None not in (c, s, t)]
    )
    queues, links = defaultdict(list), Counter()
    for c, s, t, is_return, invoice, units in events:
        queue = queues[c, s]
        if not is_return:
            queue.append([invoice, t, units])
            continue
        while units and queue:
            used = min(units, queue[0][2])
            links[invoice, t, c, s, queue[0][0], queue[0][1], used] += 1
            units -= used
            queue[0][2] -= used
            if not queue[0][2]:
                queue.pop(0)
        if units:
            links[invoice, t, c, s, None, None, units] += 1
    for (c, s, t, i), u in back.items():
        if None in (c, s, t):
            links[i, t, c, s, None, None, u] += 1
    return links, sold


def made(seed, n, customers, codes):
    rng = random.Random(seed)
    begin = datetime(2011, 1, 1)
    for k in range(n):
        cancelled = rng.random() < 0.35
        yield {
            "invoice": f"{'C' if cancelled else ''}{500_000 + (k if rng.random() < 0.9 else k // 3)}",
            "stock_code": rng.choice(codes) if rng.random() < 0.98 else None,
            "quantity": (-1 if cancelled and rng.random() < 0.97 else 1) * rng.randint(1, 9),
            "invoice_date": begin + timedelta(hours=rng.randint(0, 900)) if rng.random() < 0.98 else None,
            "customer_id": rng.choice(customers) if rng.random() < 0.97 else None,
        }


# one key with most rows, several keys, hardly any match
@pytest.mark.parametrize(
    "seed, n, customers, codes",
    [(1, 3000, [1], ["10001"]), (2, 2500, [1, 1, 1, 2, 3], ["10001", "10002"]), (3, 400, list(range(90)), ["10001", "10002"])],
)
def test_links_against_a_queue(raw_of, seed, n, customers, codes):
    lines = list(made(seed, n, customers, codes))
    expected, sold = by_queue(lines)
    raw = raw_of(*lines)
    links = returns.cancellation_links(raw)
    found = Counter(map(tuple, links.collect()))
    assert found == expected
    taken = Counter()
    for (_, _, c, s, invoice, t, units), times in found.items():
        if invoice:
            taken[c, s, t, invoice] += units * times
    assert all(units <= sold[key] for key, units in taken.items())
    net = {(r[0], r[1], r[3], r[2]): r["units_returned"] for r in returns.net_sales(raw, links).collect()}
    assert net == dict(taken)


def test_one_to_many_and_many_to_one(raw_of):
    day = lambda n: datetime(2011, 5, n)
    raw = raw_of(
        {"invoice": "1", "quantity": 3, "invoice_date": day(1)},
        {"invoice": "2", "quantity": 4, "invoice_date": day(2)},
        {"invoice": "C3", "quantity": -5, "invoice_date": day(3)},
        {"invoice": "C4", "quantity": -1, "invoice_date": day(4)},
        {"invoice": "C5", "quantity": -9, "invoice_date": day(5)},
        {"invoice": "6", "quantity": 20, "invoice_date": day(6)},
    )
    found = {(r["cancellation"], r["invoice"]): r["units"] for r in returns.cancellation_links(raw).collect()}
    assert found == {("C3", "1"): 3, ("C3", "2"): 2, ("C4", "2"): 1, ("C5", "2"): 1, ("C5", None): 8}
    summary = returns.link_summary(returns.cancellation_links(raw)).first()
    assert summary.asDict() | {"pct_units_linked": 0} == {
        "n_cancelled": 3, "n_linked": 3, "units_cancelled": 15, "units_linked": 7, "pct_units_linked": 0,
    }


def test_empty(raw_of):
    raw = raw_of({"quantity": 5}).limit(0)
    links = returns.cancellation_links(raw)
    assert links.count() == 0
    assert returns.link_summary(links).first()["n_cancelled"] == 0


def test_plans_join_no_pairs(raw_of, plan_of):
    raw = raw_of(*made(4, 50, [1], ["10001"]))
    stored = []
    returns.cancellation_links(raw, lambda frame, name: stored.append(plan_of(frame)) or returns.materialize(frame, name))
    assert len(stored) == 3
    for plan in stored:
        assert "NestedLoop" not in plan and "Cartesian" not in plan
