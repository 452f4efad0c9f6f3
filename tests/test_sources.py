"""Report window (S5), dated sink (S7) and detail attachment edge cases."""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from tillwork.sources.invoices import attach_details, in_window, report_window
from tillwork.sources.sinks import read_dated, write_dated


def test_report_window_previous_local_day():
    lo, hi, a, b = report_window(datetime(2024, 3, 6, 8, 30, tzinfo=ZoneInfo("Asia/Ho_Chi_Minh")))
    assert (a, b) == ("05-03-2024", "05-03-2024")
    assert hi - lo == 86_399_000
    # local midnight of 2024-03-05 is 17:00 UTC on 2024-03-04
    assert lo == int(datetime(2024, 3, 4, 17, 0, tzinfo=ZoneInfo("UTC")).timestamp() * 1000)
    lo7, _, a7, _ = report_window(datetime(2024, 3, 6, 8, 30, tzinfo=ZoneInfo("Asia/Ho_Chi_Minh")), days=7)
    assert a7 == "28-02-2024" and lo7 < lo


def test_in_window_filter(spark):
    lo, hi, _, _ = report_window(datetime(2024, 3, 6, tzinfo=ZoneInfo("Asia/Ho_Chi_Minh")))
    df = spark.createDataFrame([(lo - 1,), (lo,), (hi,), (hi + 1,)], "t bigint")
    assert sorted(r[0] for r in in_window(df, "t", (lo, hi)).collect()) == [lo, hi]


def test_write_dated_is_idempotent_per_date(spark, tmp_path):
    path = str(tmp_path / "sales")
    day1 = spark.createDataFrame([("2024-03-05", "a", 1.0), ("2024-03-06", "b", 2.0)], "report_date string, k string, v double")
    write_dated(day1, path)
    rerun = spark.createDataFrame([("2024-03-06", "c", 3.0)], "report_date string, k string, v double")
    write_dated(rerun, path)  # replaces only 2024-03-06
    got = sorted((str(r["report_date"]), r["k"]) for r in read_dated(spark, path).collect())
    assert got == [("2024-03-05", "a"), ("2024-03-06", "c")]
    assert read_dated(spark, path, dates=["2024-03-05"]).count() == 1


def test_attach_details_line_wins_and_missing_details_drop(spark):
    headers = spark.createDataFrame([("T1", "u", "hdr", 1.0), ("T2", "u", "hdr", 2.0)],
                                    "tran_id string, store_uid string, item_name string, total_amount double")
    line_t = "array<struct<item_name:string,quantity:double>>"
    details = spark.createDataFrame([("u", "T1", [("Trà", 2.0), ("Bánh", 1.0)]), ("u", "T2", None)],
                                    f"store_uid string, tran_id string, sale_detail {line_t}")
    got = sorted((r["tran_id"], r["item_name"], r["quantity"], r["total_amount"])
                 for r in attach_details(headers, details).collect())
    assert got == [("T1", "Bánh", 1.0, 1.0), ("T1", "Trà", 2.0, 1.0)]  # T2 (no lines) disappears


def _landing(root, spark):
    """Two stores' pages and details of the compact landing; times 100, 200 and 300."""
    import json

    def lines(name, rows):
        (root / name).mkdir()
        (root / name / "part.json").write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")

    page = lambda store, day, entries: {"store_uid": store, "report_date": day, "page_no": 1, "body": json.dumps({"data": entries})}
    head = lambda n, at: {"id": f"T{n}", "tran_id": f"T{n}", "tran_no": f"N{n}", "tran_date": at, "extra_data": "{}"}
    entry = lambda n, at: {"tran_id": f"T{n}", "tran_no": f"N{n}", "tran_date": at, "employee_name": "Lan", "log_type": "SALE_CHANGE",
                           "extra_data": "{}", "change_data": "{'sale_detail': [{'item_name': 'Trà', 'quantity': 1}]}"}
    days = [(1, 100, "a", "2024-03-05"), (2, 200, "b", "2024-03-05"), (3, 300, "a", "2024-03-06")]
    lines("inv", [page(s, d, [head(n, at)]) for n, at, s, d in days])
    lines("log", [page(s, d, [entry(n, at)]) for n, at, s, d in days] + [{"store_uid": "a", "report_date": "2024-03-06", "page_no": 2, "body": ""}])
    lines("det", [{"store_uid": s, "tran_id": f"T{n}", "body": json.dumps({"data": {"sale_detail": [{"item_name": "Trà", "quantity": 1}]}})}
                  for n, _, s, _ in days])
    from tillwork.plans.pipeline import LandedPaths

    return LandedPaths(change_log=str(root / "log"), invoices=str(root / "inv"), details=str(root / "det"), compact=True)


def test_acquire_window_saved_by_date_and_reloaded(spark, tmp_path):
    from tillwork.plans.pipeline import acquire

    paths, raw = _landing(tmp_path, spark), str(tmp_path / "raw")
    stores = {"a": "A", "b": "B"}
    flat, lines = acquire(spark, paths, stores, window=(150, 300), raw_root=raw)
    assert sorted((r["tran_no"], r["report_date"], r["item_name"]) for r in flat.collect()) == [("N2", "2024-03-05", "Trà"), ("N3", "2024-03-06", "Trà")]
    assert sorted((r["tran_no"], r["store_name"]) for r in lines.collect()) == [("N2", "B"), ("N3", "A")]
    plain, _ = acquire(spark, paths, stores, window=(150, 300))
    assert flat.schema.simpleString() == plain.schema.simpleString()
    # a later run over one day replaces that day only; one that finds nothing replaces nothing
    acquire(spark, paths, stores, window=(300, 300), raw_root=raw)
    none, no_lines = acquire(spark, paths, stores, window=(900, 901), raw_root=raw)
    assert none.count() == 0 and no_lines.count() == 0 and none.schema.simpleString() == plain.schema.simpleString()
    assert sorted(r["tran_no"] for r in read_dated(spark, f"{raw}/change_log").collect()) == ["N2", "N3"]


def test_daily_job_over_compact_landing_writes_its_outputs(spark, tmp_path):
    from tillwork.plans.pipeline import JobConfig, daily_job

    out = daily_job(spark, _landing(tmp_path, spark), {"a": "A", "b": "B"}, JobConfig(), raw_root=str(tmp_path / "raw"), out_root=str(tmp_path / "out"))
    assert out["sales"].count() == 3
    assert read_dated(spark, str(tmp_path / "out" / "sales")).count() == 3
