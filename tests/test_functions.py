"""Column functions on hand fixtures (FIXTURES §C: parse_list, extract_fields,
dates, classify, notes, prices)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillwork.functions import nested as N
from tillwork.functions import predicates as P
from tillwork.functions import scalars as S

TOP = "struct<item_name:string,price:double,quantity:double>"


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).collect()[0]["r"]


@pytest.mark.parametrize("text,json_n,py_n", [
    (None, 0, 0), ("", 0, 0), ("[]", 0, 0), ("None", 0, 0), ("nan", 0, 0), ("bad text", 0, 0),
    ("{'item_name': 'a'}", 0, 0),                                    # object, not a list
    ("[{'item_name': 'a', 'price': 1}]", 1, 1),                       # single quotes
    ("[{'item_name': \"Cà phê d'Arc\", 'price': 1}]", 0, 1),          # apostrophe: strict JSON flavour breaks
    ("[{'item_name': 'a', 'price': None}, {'item_name': 'b'}]", 0, 2),  # None only in Python flavour
    ("[{'item_name': 'None', 'quantity': 2}]", 1, 1),                 # 'None' inside a string stays text
    ("[{'item_name': 'a', 'extra': {'k': True}}]", 0, 1),             # nested object; bare True breaks JSON
])
def test_parse_list_cases(spark, text, json_n, py_n):
    assert one(spark, F.size(N.parse_list("x", TOP, style="json")), text) == json_n
    assert one(spark, F.size(N.parse_list("x", TOP, style="python")), text) == py_n


def test_parse_list_keeps_values(spark):
    r = one(spark, N.parse_list("x", TOP, style="python"), "[{'item_name': 'None', 'price': None, 'quantity': 2}]")
    assert (r[0]["item_name"], r[0]["price"], r[0]["quantity"]) == ("None", None, 2.0)


def test_extract_fields_defaults_and_present_null(spark):
    spec = {"peo_count": ("int", 0), "customer_name": ("string", ""), "customer_phone": ("string", "")}
    rows = spark.createDataFrame([("{'peo_count': 3, 'customer_phone': None}",), ("nan",), (None,), ("{bad",),
                                  ("[1, 2]",)], "x string")
    cols = N.extract_fields("x", spec)
    got = [tuple(r) for r in rows.select(*[c.alias(n) for n, c in cols.items()]).collect()]
    assert got[0] == (3, "", None)  # absent → default, present null stays null
    assert got[1:] == [(0, "", "")] * 4


def test_extract_id_dict_or_list(spark):
    df = spark.createDataFrame([("{'tran_id': 'A'}",), ("[{'tran_id': 'x'}, {'tran_id': 'B'}]",), ("[]",),
                                ("{'other': 1}",), (None,)], "x string")
    assert [r[0] for r in df.select(N.extract_id("x")).collect()] == ["A", "B", None, None, None]


def test_local_time_across_midnight(spark):
    # 2024-03-04 17:30 UTC = 2024-03-05 00:30 local (UTC+7)
    ms = int(datetime(2024, 3, 4, 17, 30).timestamp() * 1000) - int(datetime(1970, 1, 1).timestamp() * 1000)
    assert one(spark, S.local_time_text("x"), ms, "x bigint") == "2024/03/05"
    assert one(spark, S.local_time_text("x", fmt=S.DATETIME_TEXT), ms, "x bigint") == "2024/03/05 00:30:00"
    assert one(spark, S.local_time_text("x"), None, "x bigint") is None


def test_iso_week_year_boundary(spark):
    parts = S.calendar_parts(F.col("x"))
    df = spark.createDataFrame([(datetime(2024, 12, 30),), (None,)], "x timestamp_ntz")
    got = [tuple(r) for r in df.select(parts["date"], parts["week"], parts["month"], parts["year"]).collect()]
    assert got == [("30/12/2024", "01-2025", "12-2024", 2024), (None, None, None, None)]


@pytest.mark.parametrize("h,m,out", [("7", "5", "07:05:00"), ("7.0", "5", "07:05:00"), ("x", "5", "00:00:00"),
                                     (None, "5", "00:00:00"), ("123", "1", "123:01:00"), (" 7 ", "0", "07:00:00"),
                                     ("nan", "1", "00:00:00")])
def test_time_of_day(spark, h, m, out):
    df = spark.createDataFrame([(h, m)], "h string, m string")
    assert df.select(S.time_of_day("h", "m")).collect()[0][0] == out


@pytest.mark.parametrize("name,phone,member,label", [
    ("iPOS-O2O", "09", "Gold", "Khách lẻ"), ("  ", "09", "Gold", "Khách lẻ"), ("An", " ", "Gold", "Khách lẻ"),
    ("An", None, None, "Khách lẻ"), ("An", "09", None, "Khách mới"), ("An", "09", "Thành viên mặc định", "Khách mới"),
    ("An", "09", "Gold", "Khách quay lại")])
def test_classify_customer(spark, name, phone, member, label):
    df = spark.createDataFrame([(name, phone, member)], "n string, p string, m string")
    assert df.select(S.classify_customer("n", "p", "m")).collect()[0][0] == label


def test_note_parsing(spark):
    df = spark.createDataFrame([("Bàn 3 gộp vào HD001 - abc",), ("x gộp vào A gộp vào B-2",), ("Gộp vào C - d",),
                                (None,)], "x string")
    got = [r[0] for r in df.select(S.text_between("x", "gộp vào", "-")).collect()]
    assert got == ["HD001", "B", "Gộp vào C", None]  # case-sensitive cut, missing marker keeps text
    cap = S.capture("x", r"([A-Z0-9]{10,})\s*-")
    df2 = spark.createDataFrame([("bỏ món tạo thành hóa đơn AB12345678 - x",), ("short AB12 - x",)], "x string")
    assert [r[0] for r in df2.select(cap).collect()] == ["AB12345678", None]


def test_predicates_null_safe(spark):
    df = spark.createDataFrame([(None,), ("A [Gộp đơn] b",), ("SALE_SPLIT_ORDER",)], "x string")
    got = [tuple(r) for r in df.select(P.contains_text("x", "[gộp đơn]"), P.contains_text("x", "[Gộp đơn]", False),
                                       P.contains_any("x", "sale_split_order|SALE_MERGE_ORDER"),
                                       P.is_empty("x")).collect()]
    assert got == [(False, False, False, True), (True, True, False, False), (False, False, True, False)]


def test_price_override_later_rule_wins(spark):
    rules = [("+ Topping Hạt đác", 15000.0), ("+ Topping", 1.0), ("+ Không lấy Topping", 0.0)]
    df = spark.createDataFrame([("+ Topping Hạt đác",), ("+ Không lấy Topping",), ("Trà",), (None,)], "i string")
    got = [r[0] for r in df.select(S.override_price("i", F.lit(9.0), rules)).collect()]
    assert got == [1.0, 0.0, 9.0, 9.0]


def test_to_number(spark):
    df = spark.createDataFrame([("3.7",), ("x",), (None,), ("-2.5",)], "x string")
    assert [r[0] for r in df.select(S.to_number("x")).collect()] == [3.7, 0.0, 0.0, -2.5]
    assert [r[0] for r in df.select(S.to_number("x", truncate=True)).collect()] == [3, 0, 0, -2]
