"""End-to-end daily job on hand-written landed pages (invented values)."""

import json
import os
from datetime import datetime, timezone

import pytest

from tillwork.plans.pipeline import JobConfig, LandedPaths, daily_job

STORES = {"u-a": "Cửa hàng A", "u-b": "Cửa hàng B"}
# 2024-03-05 10:00 local (UTC+7) = 03:00 UTC
T0 = int(datetime(2024, 3, 5, 3, 0, tzinfo=timezone.utc).timestamp() * 1000)


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj, ensure_ascii=False))


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    d = "report_date=2024-03-05"
    headers = {"data": [
        {"id": "X1", "tran_id": "T1", "tran_no": "N1", "tran_date": T0, "start_hour": "9", "start_minute": 30.0,
         "end_hour": "10.0", "end_minute": "15", "table_name": "B1", "total_amount": 90000, "amount_discount_detail": 0,
         "extra_data": "{'peo_count': 2, 'Membership_Type_Name': 'Gold', 'customer_name': 'An', 'customer_phone': '0901'}"},
        {"id": "X2", "tran_id": "T2", "tran_no": "N2", "tran_date": T0 + 60000, "start_hour": "x", "start_minute": 1,
         "end_hour": None, "end_minute": 2, "table_name": "B2", "total_amount": 25000, "amount_discount_detail": 0,
         "extra_data": "{}"},
    ]}
    _write(f"{root}/inv/{d}/store=u-a/page=1.json", headers)
    _write(f"{root}/inv/{d}/store=u-b/page=1.json", "")  # empty page → nothing
    _write(f"{root}/det/{d}/store=u-a/tran=T1.json", {"data": {"sale_detail": [
        {"item_name": "Trà", "quantity": 2, "price_org": 30000, "price": 30000, "amount": 60000,
         "toppings": "[{'item_name': 'Topping Hạt đác', 'price': 5000, 'quantity': 1, 'amount': 5000}]"}]}})
    _write(f"{root}/det/{d}/store=u-a/tran=T2.json", {"data": {"sale_detail": [
        {"item_name": "Cà phê", "quantity": 1, "price_org": 25000, "price": 25000, "amount": 25000, "toppings": "[]"}]}})
    log = [
        {"tran_id": "T1", "tran_no": "N1", "tran_date": T0, "table_name": "B1", "employee_name": "Lan",
         "log_type": "SALE_CHANGE", "extra_data": "{'message_modify_table': ''}",
         "change_data": "{'sale_detail': [{'item_name': 'Trà', 'quantity': 2, 'price': 30000, 'amount': 60000, "
                        "'toppings': [{'item_name': 'Topping Hạt đác', 'quantity': 1, 'price': 5000}]}]}"},
        {"tran_id": "T2", "tran_no": "N2", "tran_date": T0 + 60000, "table_name": "B2", "employee_name": "Minh",
         "log_type": "SALE_CHANGE", "extra_data": "{}",
         "change_data": {"sale_detail": [{"item_name": "Cà phê", "quantity": 1}]}},
        {"tran_id": "T2", "tran_no": "N2", "tran_date": T0 + 120000, "table_name": "B2", "employee_name": "Minh",
         "log_type": "PRINT", "extra_data": "{}", "change_data": "{}"},
    ]
    _write(f"{root}/log/{d}/store=u-a/page=1.json", {"data": {"items": log}})
    return LandedPaths(change_log=f"{root}/log", invoices=f"{root}/inv", details=f"{root}/det")


def test_daily_job_end_to_end(spark, landed):
    out = daily_job(spark, landed, STORES, JobConfig())
    items = sorted((r["invoice_no"], r["item"], r["qty"], r["unit_price"], r["customer_type"], r["time_in"],
                    r["time_out"], r["date"], r["occurrence"]) for r in out["invoice_items"].collect())
    assert items == [
        ("N1", "+ Topping Hạt đác", 1.0, 30000.0, "Khách quay lại", "09:30:00", "10:15:00", "2024/03/05", 1),
        ("N1", "Trà", 2.0, 30000.0, "Khách quay lại", "09:30:00", "10:15:00", "2024/03/05", 1),
        ("N2", "Cà phê", 1.0, 25000.0, "Khách lẻ", "00:00:00", "00:00:00", "2024/03/05", 1),
    ]
    log = sorted((r["invoice_id"], r["item"], r["qty"], r["employee"], r["ts"]) for r in out["order_log"].collect())
    assert log == [
        ("T1", "+ Topping Hạt đác", 1.0, "Lan", "2024/03/05 10:00:00"),
        ("T1", "Trà", 2.0, "Lan", "2024/03/05 10:00:00"),
        ("T2", "Cà phê", 1.0, "Minh", "2024/03/05 10:01:00"),
    ]
    sales = sorted((r["invoice_no"], r["item"], r["qty"], r["unit_price"], r["order_value"], r["employee"])
                   for r in out["sales"].collect())
    assert sales == [
        ("N1", "+ Topping Hạt đác", 1, 15000.0, 15000.0, "Lan"),
        ("N1", "Trà", 2, 30000.0, 60000.0, "Lan"),
        ("N2", "Cà phê", 1, 25000.0, 25000.0, "Minh"),
    ]
    kpi = sorted(tuple(r) for r in out["staff_kpi"].collect())
    assert kpi == [
        ("05/03/2024", "10-2024", "03-2024", 2024, "Cửa hàng A", "N1", 2, "Khách quay lại", "Lan", "0901", 75000.0),
        ("05/03/2024", "10-2024", "03-2024", 2024, "Cửa hàng A", "N2", 0, "Khách lẻ", "Minh", "", 25000.0),
    ]
    stats = out["log_stats"].collect()[0]
    assert (stats["merge_rows"], stats["split_rows"], stats["edit_rows"], stats["total_rows"]) == (0, 0, 3, 3)
