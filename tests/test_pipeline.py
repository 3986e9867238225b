from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tillroll.operators import cleaning, quality
from tillroll.operators.scoring import NoSales
from tillroll.plans import pipeline as pl
from tillroll.plans.warehouse import Warehouse
from tillroll.sources import readers
from tillroll.sources.schemas import RAW, WORKBOOK_HEADERS
from tillroll.sources.scratch import Stages


def test_full_run(spark, tmp_path):
    w = Warehouse(spark, DATA)
    gates = {"sales": [quality.row_count(1, 10**6)], "customer_rfm": quality.customer_rfm_suite()[1:]}
    run = pl.Pipeline(spark, str(tmp_path), gates)
    summary = run.run(w.raw())
    assert summary.buckets == {
        "n_raw": 6005,
        "n_stock_movements": 22,
        "n_cancellations": 102,
        "n_non_product_lines": 181,
        "n_sales": 5076,
    }
    loaded = summary.ingested
    assert (loaded.rows_inserted, loaded.customer_id_type) == (6005, "bigint")
    assert loaded.size_mb > 0 and loaded.volume_ok(6000) and not loaded.volume_ok(7000)
    assert summary.history["total_rows"] == 25471 and summary.history["n_snapshots"] == 80
    assert sum(summary.last_macros.values()) == 502
    assert run.read(pl.SALES).exceptAll(w.sales()).isEmpty()
    for name in cleaning.BUCKETS[:3]:
        assert run.side_bucket(name).count() == summary.buckets[f"n_{name}"]
    ours = run.read(pl.CUSTOMERS).drop("computed_at")
    assert ours.exceptAll(w.customers()).isEmpty() and ours.count() == 502
    columns = w.history().columns
    assert run.read(pl.HISTORY).select(*columns).exceptAll(w.history()).isEmpty()
    assert spark.table("customer_rfm_v").count() == 502
    assert spark.table("v_rfm_codes_coverage").count() == 125
    assert spark.table("customer_first_purchase").count() == 502
    # a second run replaces, it does not add
    assert run.run(w.raw()).history["total_rows"] == 25471


def test_failed_gate_empties_customers_but_keeps_the_history(spark, tmp_path, raw_of):
    good = raw_of({})
    pl.Pipeline(spark, str(tmp_path)).run(good)
    strict = pl.Pipeline(spark, str(tmp_path), {"sales": [quality.row_count(5, 9)]})
    with pytest.raises(quality.GateFailed, match="row_count"):
        strict.run(good)
    for table in (pl.CUSTOMERS, pl.VISITS):
        assert strict.read(table).count() == 0
    assert "r_score" in strict.read(pl.CUSTOMERS).columns
    assert strict.read(pl.HISTORY).count() == 1


def test_run_without_sales_raises(spark, tmp_path, raw_of):
    with pytest.raises(NoSales):
        pl.Pipeline(spark, str(tmp_path)).run(raw_of({"quantity": -1}))


def test_workbook_gate_fails_on_other_data(spark, tmp_path, raw_of):
    with pytest.raises(quality.GateFailed):
        pl.Pipeline(spark, str(tmp_path), pl.standard_gates()).run(raw_of({}))


def test_csv_sheets_round_trip(spark, tmp_path):
    raw = Warehouse(spark, DATA).raw()
    early = F.year("invoice_date") < 1998
    paths = []
    for name, part in (("early", early), ("late", ~early)):
        paths.append(str(tmp_path / name))
        raw.where(part).write.option("header", True).option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
        ).csv(paths[-1])
    loaded = readers.read_retail_csv(spark, paths)
    assert loaded.schema == RAW
    assert loaded.exceptAll(raw).isEmpty() and raw.exceptAll(loaded).isEmpty()


def test_bad_csv_row_fails_the_load(spark, tmp_path):
    header = ",".join(RAW.names)
    (tmp_path / "bad.csv").write_text(f"{header}\n1,2,x,many,2011-01-01 00:00:00,1.0,3,FR\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_retail_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_sheets_under_original_headers(spark, raw_of):
    sheet = raw_of({}, {"customer_id": None}).withColumnsRenamed(
        dict(zip(RAW.names, WORKBOOK_HEADERS))
    )
    union = readers.union_sheets([readers.from_workbook_headers(sheet)] * 2)
    assert union.schema == RAW and union.count() == 4


def test_truncate_and_append(spark, tmp_path, raw_of):
    path = str(tmp_path / "raw")
    for truncate, expected in ((True, 1), (False, 2), (True, 1)):
        readers.write_raw(raw_of({}), path, truncate)
        assert readers.read_retail_parquet(spark, path).count() == expected


def test_stage_is_reused_until_the_input_changes(spark, tmp_path):
    def rows(n):
        spark.range(n).write.mode("overwrite").parquet(str(tmp_path / "in.parquet"))

    builds = []

    def build():
        builds.append(1)
        return spark.read.parquet(str(tmp_path / "in.parquet"))

    stages = Stages(spark, str(tmp_path), ("in",))
    rows(3)
    assert stages.table("t", build).count() == stages.table("t", build).count() == 3
    assert len(builds) == 1
    rows(40)
    assert stages.table("t", build).count() == 40 and len(builds) == 2


def rows_of(frame):
    return Counter(map(tuple, frame.select(*sorted(frame.columns)).collect()))


def files_of(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def same_tables(one, other):
    for table in (pl.RAW_LINES, pl.SALES, pl.SIDE_BUCKETS, pl.VISITS, pl.HISTORY):
        assert rows_of(one.read(table)) == rows_of(other.read(table)), table
    assert rows_of(one.read(pl.CUSTOMERS).drop("computed_at")) == rows_of(other.read(pl.CUSTOMERS).drop("computed_at"))


@pytest.mark.parametrize("calendar", ["month_end", "iterative"])
def test_append_equals_a_full_run_and_leaves_early_files(spark, tmp_path, calendar):
    raw = Warehouse(spark, DATA).raw()
    # the load has late lines, and some lines of early invoices of one month
    late = (F.col("invoice_date") >= "1997-11-17") | ((F.trunc("invoice_date", "month") == "1997-03-01") & (F.col("quantity") % 3 == 0))
    late = F.coalesce(late, F.lit(False))
    run, whole = (pl.Pipeline(spark, str(tmp_path / name)) for name in ("parts", "whole"))
    run.run(raw.where(~late), calendar)
    before = {t: files_of(run.path(t)) for t in (pl.RAW_LINES, pl.SALES, pl.VISITS, pl.HISTORY)}
    told = run.append(raw.where(late), calendar)
    whole.run(raw, calendar)
    same_tables(run, whole)
    assert str(told.visit_months[0]) == "1997-03-01" and 5 < len(told.visit_months) < 60
    assert told.snapshots and str(told.snapshots[0]) >= "1997-03-01"
    assert before[pl.RAW_LINES] <= files_of(run.path(pl.RAW_LINES)) and before[pl.SALES] <= files_of(run.path(pl.SALES))
    for table, key, written in ((pl.VISITS, pl.VISIT_MONTH, told.visit_months), (pl.HISTORY, "snapshot_date", told.snapshots)):
        touched = tuple(f"{key}={d}" for d in written)
        kept = {f for f in before[table] if not f.startswith(touched)}
        assert kept and kept <= files_of(run.path(table))
    assert told.buckets["n_raw"] == raw.where(late).count()


def test_append_before_all_sales_and_without_sales(spark, tmp_path, raw_of):
    later, early = raw_of({"customer_id": 1}), raw_of({"invoice_date": datetime(2010, 1, 3), "invoice": "4"})
    run, whole = (pl.Pipeline(spark, str(tmp_path / name)) for name in ("parts", "whole"))
    run.run(later)
    told = run.append(early)
    whole.run(later.union(early))
    same_tables(run, whole)
    assert len(told.snapshots) == 17
    nothing = run.append(raw_of({"quantity": -1}))
    assert nothing.snapshots == [] and nothing.visit_months == [] and nothing.buckets["n_sales"] == 0
    assert run.read(pl.RAW_LINES).count() == 3 and run.read(pl.SALES).count() == 2
