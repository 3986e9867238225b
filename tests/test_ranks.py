import random

import pytest
from pyspark.sql import Window, functions as F

from tillroll.operators import ranks
from tillroll.operators.ranks import bucket_starts, rows_at_ranks
from tillroll.operators.stats import box_plot, quantiles


def brute(rows, wanted):
    ordered = sorted(rows)
    return {(rank, *ordered[rank]) for rank in wanted(len(ordered)) if rank < len(ordered)}


@pytest.fixture
def coarse(monkeypatch):
    """Few slices, so that several rounds are needed on a small frame."""
    monkeypatch.setattr(ranks, "SLICES", 7)


@pytest.mark.parametrize("small", [1, 5, 100_000])
def test_rows_at_ranks_with_a_hot_value(spark, coarse, small):
    rng = random.Random(3)
    rows = [(3 if i % 3 == 0 else rng.randint(-50, 10**9), i * 17) for i in range(400)]
    frame = spark.createDataFrame(rows, "v bigint, id bigint").repartition(5)
    found = rows_at_ranks(frame, {"v": F.col("v")}, bucket_starts(5), tie="id", small=small)
    assert {(r.rank, r.value, r.tie) for r in found} == brute(rows, bucket_starts(5))


@pytest.mark.parametrize("small", [1, 50])
def test_rows_at_ranks_by_group(spark, coarse, small):
    rng = random.Random(5)
    rows = [(g, rng.choice([1, 1, 1, 2, 9]), i) for g in "abc" for i in range(rng.randint(3, 90))]
    frame = spark.createDataFrame(rows, "g string, v int, id bigint")
    found = rows_at_ranks(
        frame, {"v": F.col("v"), "w": -F.col("v")}, bucket_starts(5), ("g",), "id", small=small
    )
    for g in "abc":
        for name, sign in (("v", 1), ("w", -1)):
            mine = [(sign * v, i) for h, v, i in rows if h == g]
            assert {
                (r.rank, r.value, r.tie) for r in found if r.group == (g,) and r.measure == name
            } == brute(mine, bucket_starts(5))


def test_all_rows_equal(spark, coarse):
    frame = spark.range(100).select(F.lit(4).alias("v"), "id")
    found = rows_at_ranks(frame, {"v": F.col("v")}, bucket_starts(5), tie="id", small=3)
    assert sorted(r.tie for r in found) == [20, 40, 60, 80]
    untied = rows_at_ranks(frame, {"v": F.col("v")}, bucket_starts(5), small=3)
    assert {r.value for r in untied} == {4}


@pytest.mark.parametrize("n", range(0, 13))
def test_bucket_starts_are_those_of_ntile(spark, n):
    buckets = [r[0] for r in spark.range(n).select(F.ntile(5).over(Window.orderBy("id"))).collect()]
    starts = bucket_starts(5)(n)
    assert buckets == [1 + sum(i >= s for s in starts) for i in range(n)]


@pytest.mark.parametrize("small", [2, 100_000])
def test_quantiles_interpolate(spark, coarse, small):
    values = [1, 2, 2, 2, 50, 1000, 7]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    found = quantiles(frame, {"v": F.col("v")}, (25, 50, 75), small=small)[("v", ())]
    assert [float(found[p]) for p in (25, 50, 75)] == [2.0, 2.0, 28.5]


def test_weights_repeat_a_row(spark, coarse):
    frame = spark.createDataFrame([(1, 10), (5, 1), (9, 10)], "v bigint, n bigint")
    for small in (1, 100):
        found = quantiles(frame, {"v": F.col("v")}, (50,), weight="n", small=small)
        assert float(found[("v", ())][50]) == 5.0


def test_box_plot_ignores_missing_values(spark):
    frame = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 100, None]], "v int")
    box = box_plot(frame, "v", F.col("v")).first()
    assert (box["n"], box["n_outliers"]) == (5, 1)
    assert (float(box["q1"]), float(box["median"]), float(box["q3"])) == (2.0, 3.0, 4.0)
    assert (float(box["whisker_low"]), float(box["whisker_high"])) == (1.0, 4.0)
    assert float(box["upper_fence"]) == 7.0


@pytest.mark.parametrize("around", [0.01, 0.3, -0.3])
def test_ranks_with_good_wide_and_wrong_sketches(spark, coarse, monkeypatch, around):
    """A sketch only says where to look first: bounds that overlap or miss the rank change nothing."""
    monkeypatch.setattr(ranks, "AROUND", around)
    rng = random.Random(8)
    rows = [(g, rng.randint(0, 9) ** 9, i) for g in "ab" for i in range(4000)]
    frame = spark.createDataFrame(rows, "g string, v bigint, id bigint")
    for groups in (("g",), ()):
        found = rows_at_ranks(frame.where("g = 'a'") if not groups else frame, {"v": F.col("v")}, bucket_starts(5), groups, "id", small=40)
        for g in "ab" if groups else "a":
            mine = [(v, i) for h, v, i in rows if h == g]
            own = [r for r in found if not groups or r.group == (g,)]
            assert {(r.rank, r.value, r.tie) for r in own} == brute(mine, bucket_starts(5))


def test_slices_of_all_spans_together_are_bounded(spark, monkeypatch):
    """Many groups share the slices of a round, so what a task counts does not grow with their number."""
    monkeypatch.setattr(ranks, "ALL_SLICES", 600)
    rng = random.Random(4)
    rows = [(g, rng.randint(0, 10**9), i) for g in range(40) for i in range(200)]
    frame = spark.createDataFrame(rows, "g int, v bigint, id bigint")
    counted, hits = [], ranks._Search._hits

    def counting(search, pieces, order, *rest):
        if order == ["_slice"]:
            counted.append(pieces.count())
        return hits(search, pieces, order, *rest)

    monkeypatch.setattr(ranks._Search, "_hits", counting)
    monkeypatch.setattr(ranks._Search, "sketched", lambda search, wanted: wanted)
    found = rows_at_ranks(frame, {"v": F.col("v")}, bucket_starts(5), ("g",), "id", small=5)
    for g in range(40):
        mine = {(r.rank, r.value, r.tie) for r in found if r.group == (g,)}
        assert mine == brute([(v, i) for h, v, i in rows if h == g], bucket_starts(5))
    assert counted and max(counted) <= 600
