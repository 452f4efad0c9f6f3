"""Query plans over the driver tables, one per operator family, each paired
with an independently written DuckDB oracle (``ORACLE_SQL``).

Every query reads whole tables; the only row reductions are the operators'
own semantics (a type filter, a deduction removing spent rows, …).
Computed columns carry the same alias on both sides; doubles are rounded to
2 decimals where sums are involved.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import nested as N
from tillwork.functions import predicates as P
from tillwork.functions import scalars as S
from tillwork.operators import aggregates as A
from tillwork.operators import deduct, fill, joins, keys
from tillwork.plans.standins import STANDIN_PRICE_RULES, invoice_lines, order_log, table
from tillwork.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------
# Shared oracle fragments (DuckDB spelling of the stand-in derivations).
LOG_CTE = """
log AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         user_id AS bill,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS grp,
         event_type AS item,
         CASE WHEN event_id % 5 = 0 THEN -(CAST(trunc(value) AS BIGINT) + 1)
              ELSE CAST(trunc(value) AS BIGINT) + 1 END AS qty,
         CASE WHEN event_id % 7 = 0 THEN event_type END AS sparse,
         CASE WHEN event_type = 'click' AND event_id % 97 = 0 THEN 'SALE_SPLIT_ORDER'
              WHEN event_type = 'signup' AND event_id % 89 = 0 THEN 'SALE_MERGE_ORDER'
              WHEN event_type = 'error' THEN 'PRINT'
              ELSE 'SALE_CHANGE' END AS log_type
  FROM events)"""

INVOICE_CTE = """
inv AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice, l.l_shipdate, c.c_custkey,
         n.n_name AS store,
         CAST(o.o_orderkey AS VARCHAR) AS invoice_no,
         (o.o_orderkey % 4) + 1 AS guests,
         s.s_name AS employee,
         CASE WHEN c.c_custkey % 17 = 0 THEN 'iPOS-O2O' WHEN c.c_custkey % 19 = 0 THEN ' ' ELSE c.c_name END AS customer,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 7 = 0 THEN ''
              ELSE '09' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') END AS phone,
         CASE WHEN c.c_custkey % 3 = 0 THEN NULL WHEN c.c_custkey % 3 = 1 THEN 'Thành viên mặc định'
              ELSE c.c_mktsegment END AS membership,
         CASE WHEN l.l_linenumber > 1 THEN '+ ' || p.p_name ELSE p.p_name END AS item,
         CAST(trunc(l.l_quantity) AS BIGINT) AS qty,
         p.p_retailprice AS unit_price,
         l.l_shipdate AS ts
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey),
inv_c AS (
  SELECT *,
         CASE WHEN customer = 'iPOS-O2O' OR customer IS NULL OR trim(customer) = ''
                   OR phone IS NULL OR trim(phone) = '' THEN 'Khách lẻ'
              WHEN membership IS NULL OR trim(membership) = '' OR membership = 'Thành viên mặc định' THEN 'Khách mới'
              ELSE 'Khách quay lại' END AS customer_type
  FROM inv)"""

LOG_ORDER = ["ts", "event_id"]


def log_buckets():
    """Order-monotone buckets of the log: days, and the minutes inside a day."""
    return [F.to_date("ts"), F.date_trunc("minute", "ts")]


# --------------------------------------------------------------------------
# A1 C4 C11 C12 C13 (X7 X8): staff KPI — the flagship.
def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = invoice_lines(spark, sf_dir)
    cal = S.calendar_parts("ts")
    price = S.override_price("item", "unit_price", STANDIN_PRICE_RULES)
    return inv.select("*", *[c.alias(n) for n, c in cal.items()]).withColumn("unit_price", price) \
              .withColumn("order_value", S.order_value("qty", "unit_price"))


@register("staff_kpi", f"""
WITH {INVOICE_CTE.strip()},
priced AS (
  SELECT *,
         strftime(ts, '%d/%m/%Y') AS date, strftime(ts, '%V-%G') AS week, strftime(ts, '%m-%Y') AS month,
         CAST(year(ts) AS INTEGER) AS year,
         CASE WHEN item LIKE '%+ red widget%' THEN 12000.0 WHEN item LIKE '%+ blue%' THEN 10000.0
              WHEN item LIKE '%+ red%' THEN 15000.0 ELSE unit_price END AS price2
  FROM inv_c)
SELECT date, week, month, year, store, invoice_no, guests, customer_type, employee, phone,
       round(coalesce(sum(qty * price2), 0), 2) AS order_value
FROM priced
WHERE date IS NOT NULL AND week IS NOT NULL AND month IS NOT NULL AND year IS NOT NULL AND store IS NOT NULL
  AND invoice_no IS NOT NULL AND guests IS NOT NULL AND customer_type IS NOT NULL AND employee IS NOT NULL
  AND phone IS NOT NULL
GROUP BY date, week, month, year, store, invoice_no, guests, customer_type, employee, phone
""")
def q_staff_kpi(spark, sf_dir):
    # date/week/month/year are functions of the day: group on the DATE value
    # (narrow key) and render the four labels per group afterwards.
    inv = invoice_lines(spark, sf_dir)
    price = S.override_price("item", "unit_price", STANDIN_PRICE_RULES)
    lines = inv.select(F.to_date("ts").alias("day"), "store", "invoice_no", "guests", "customer_type", "employee",
                       "phone", S.order_value("qty", price).alias("order_value"))
    keys_ = ["day", "store", "invoice_no", "guests", "customer_type", "employee", "phone"]
    res = A.kpi_sum(lines, keys_, "order_value")
    cal = S.calendar_parts(F.col("day").cast("timestamp_ntz"))
    return res.select(*[cal[n].alias(n) for n in ("date", "week", "month", "year")], *keys_[1:],
                      F.round("order_value", 2).alias("order_value"))


# A2 A3 F1: log statistics ---------------------------------------------------
@register("log_stats", f"""
WITH {LOG_CTE.strip()}
SELECT count(*) FILTER (WHERE contains(log_type, 'SALE_MERGE_ORDER')) AS merge_rows,
       count(*) FILTER (WHERE contains(log_type, 'SALE_SPLIT_ORDER')) AS split_rows,
       count(*) FILTER (WHERE contains(log_type, 'SALE_CHANGE')) AS edit_rows,
       count(*) FILTER (WHERE contains(log_type, 'SALE_MERGE_ORDER'))
       + count(*) FILTER (WHERE contains(log_type, 'SALE_SPLIT_ORDER'))
       + count(*) FILTER (WHERE contains(log_type, 'SALE_CHANGE')) AS total_rows,
       CAST(coalesce(sum(qty), 0) AS BIGINT) AS total_qty
FROM log WHERE log_type IN ('SALE_CHANGE', 'SALE_SPLIT_ORDER', 'SALE_MERGE_ORDER')
""")
def q_log_stats(spark, sf_dir):
    lg = order_log(spark, sf_dir).filter(P.is_one_of("log_type", A.LOG_TYPES))
    return A.log_stats(lg, "log_type", extra=[F.coalesce(F.sum("qty"), F.lit(0)).cast("bigint").alias("total_qty")])


# Customer classification -------------------------------------------
@register("classify_customer", """
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 17 = 0 THEN 'iPOS-O2O' WHEN c_custkey % 19 = 0 THEN ' ' ELSE c_name END AS customer,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ''
              ELSE '09' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS phone,
         CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'Thành viên mặc định'
              ELSE c_mktsegment END AS membership
  FROM customer)
SELECT c_custkey, customer, phone, membership,
       CASE WHEN customer = 'iPOS-O2O' OR customer IS NULL OR trim(customer) = ''
                 OR phone IS NULL OR trim(phone) = '' THEN 'Khách lẻ'
            WHEN membership IS NULL OR trim(membership) = '' OR membership = 'Thành viên mặc định' THEN 'Khách mới'
            ELSE 'Khách quay lại' END AS customer_type
FROM c
""")
def q_classify_customer(spark, sf_dir):
    from tillwork.plans.standins import customer_fields

    c = customer_fields(table(spark, sf_dir, "customer"))
    return c.select("c_custkey", "customer", "phone", "membership",
                    S.classify_customer("customer", "phone", "membership").alias("customer_type"))


# C4: calendar parts -----------------------------------------------------------
@register("calendar_parts", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS date, strftime(o_orderdate, '%V-%G') AS week,
       strftime(o_orderdate, '%m-%Y') AS month, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders
""")
def q_calendar_parts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", *[c.alias(n) for n, c in S.calendar_parts("o_orderdate").items()])


# Epoch ms → local text ------------------------------------------------------
@register("local_time_text", """
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms,
       strftime(ts + INTERVAL 7 HOUR, '%Y/%m/%d') AS local_date,
       strftime(ts + INTERVAL 7 HOUR, '%Y/%m/%d %H:%M:%S') AS local_time
FROM events
""")
def q_local_time_text(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    staged = ev.select("event_id", ms.alias("epoch_ms"))
    return staged.select("event_id", "epoch_ms",
                         S.local_time_text("epoch_ms").alias("local_date"),
                         S.local_time_text("epoch_ms", fmt=S.DATETIME_TEXT).alias("local_time"))


# Hour + minute → HH:MM:00 -----------------------------------------------------
@register("time_of_day", """
SELECT event_id,
       CASE event_id % 6 WHEN 2 THEN '00:00:00' WHEN 3 THEN '00:00:00'
            WHEN 4 THEN printf('%02d:%02d:00', hour(ts) + 100, minute(ts))
            ELSE printf('%02d:%02d:00', hour(ts), minute(ts)) END AS time_in
FROM events
""")
def q_time_of_day(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    h = F.hour("ts").cast("string")
    m = F.minute("ts")
    r = F.col("event_id") % 6
    hour_text = (F.when(r == 0, h).when(r == 1, F.concat(h, F.lit(".0"))).when(r == 2, F.lit("x"))
                 .when(r == 3, F.lit(None).cast("string")).when(r == 4, (F.hour("ts") + 100).cast("string"))
                 .otherwise(F.concat(F.lit(" "), h, F.lit(" "))))
    minute_val = F.when(r == 1, m.cast("double")).otherwise(m.cast("double"))
    return ev.select("event_id", S.time_of_day(hour_text, minute_val).alias("time_in"))


# Note parsing ------------------------------------------------------
NOTE_SQL = """
CASE event_id % 5
  WHEN 0 THEN 'Bàn ' || CAST(user_id AS VARCHAR) || ' gộp vào HD' || lpad(CAST(user_id // 2 AS VARCHAR), 8, '0') || ' - ghi chú'
  WHEN 1 THEN 'bỏ món ' || event_type || ' tạo thành hóa đơn HD' || lpad(CAST(event_id AS VARCHAR), 10, '0') || ' - mới'
  WHEN 2 THEN NULL
  WHEN 3 THEN 'Gộp vào ' || CAST(user_id AS VARCHAR)
  ELSE '[Gộp đơn] hóa đơn được tạo mới' END"""


def note_column():
    eid, uid = F.col("event_id"), F.col("user_id")
    r = eid % 5
    return (F.when(r == 0, F.concat(F.lit("Bàn "), uid.cast("string"), F.lit(" gộp vào HD"),
                                    F.lpad((uid.cast("bigint") / 2).cast("bigint").cast("string"), 8, "0"),
                                    F.lit(" - ghi chú")))
            .when(r == 1, F.concat(F.lit("bỏ món "), F.col("event_type"), F.lit(" tạo thành hóa đơn HD"),
                                   F.lpad(eid.cast("string"), 10, "0"), F.lit(" - mới")))
            .when(r == 2, F.lit(None).cast("string"))
            .when(r == 3, F.concat(F.lit("Gộp vào "), uid.cast("string")))
            .otherwise(F.lit("[Gộp đơn] hóa đơn được tạo mới")))


@register("note_targets", f"""
WITH {LOG_CTE.strip()},
n AS (SELECT event_id, log_type, {NOTE_SQL.strip()} AS note FROM log)
SELECT event_id, note,
       CASE WHEN lower(note) LIKE '%gộp vào%'
            THEN nullif(trim(split_part(trim(string_split(note, 'gộp vào')[-1]), '-', 1)), '') END AS merge_target,
       CASE WHEN lower(note) LIKE '%bỏ món%' AND lower(note) LIKE '%tạo thành hóa đơn%'
            THEN nullif(regexp_extract(note, '([A-Z0-9]{{10,}})\\s*-', 1), '') END AS split_target,
       coalesce(lower(note) LIKE '%hóa đơn được tạo mới%', false) AS is_new_note,
       coalesce(contains(note, '[Gộp đơn]'), false) AS is_merge_row,
       coalesce(regexp_matches(log_type, '(?i)SALE_SPLIT_ORDER|SALE_MERGE_ORDER'), false) AS restructured
FROM n
""")
def q_note_targets(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "user_id", "event_type", "log_type")
    lg = lg.withColumn("note", note_column())
    merge_hit = P.contains_text("note", "gộp vào")
    split_hit = P.contains_text("note", "bỏ món") & P.contains_text("note", "tạo thành hóa đơn")
    return lg.select(
        "event_id", "note",
        F.when(merge_hit, S.blank_to_null(S.text_between("note", "gộp vào", "-"))).alias("merge_target"),
        F.when(split_hit, S.capture("note", r"([A-Z0-9]{10,})\s*-")).alias("split_target"),
        P.contains_text("note", "hóa đơn được tạo mới").alias("is_new_note"),
        P.contains_text("note", "[Gộp đơn]", ignore_case=False).alias("is_merge_row"),
        P.contains_any("log_type", "SALE_SPLIT_ORDER|SALE_MERGE_ORDER").alias("restructured"),
    )


# Fills ------------------------------------------------------------------------
_FWD = "last_value(sparse IGNORE NULLS) OVER (PARTITION BY grp ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_FIRST = "first_value(sparse IGNORE NULLS) OVER (PARTITION BY grp ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


@register("fill_group", f"""
WITH {LOG_CTE.strip()}
SELECT event_id, grp, CASE WHEN grp IS NULL THEN NULL ELSE coalesce({_FWD}, {_FIRST}) END AS sparse FROM log
""")
def q_fill_group(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "ts", "grp", "sparse", "day")
    return fill.fill_group(lg, "grp", "sparse", order=LOG_ORDER, bucket="day").select("event_id", "grp", "sparse")


@register("fill_masked", f"""
WITH {LOG_CTE.strip()}
SELECT event_id, grp, log_type,
       CASE WHEN grp IS NULL OR log_type <> 'SALE_CHANGE' THEN NULL ELSE coalesce({_FWD}, {_FIRST}) END AS sparse
FROM log
""")
def q_fill_masked(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "ts", "grp", "sparse", "day", "log_type")
    res = fill.fill_masked(lg, "grp", "sparse", F.col("log_type") == "SALE_CHANGE", order=LOG_ORDER, bucket="day")
    return res.select("event_id", "grp", "log_type", "sparse")


@register("fill_global", f"""
WITH {LOG_CTE.strip()}
SELECT event_id, last_value(sparse IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sparse
FROM log
""")
def q_fill_global(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "ts", "sparse")
    return fill.fill_global(lg, "sparse", order=LOG_ORDER, bucket=log_buckets()).select("event_id", "sparse")


@register("fill_group_then_global", f"""
WITH {LOG_CTE.strip()},
f AS (SELECT event_id, ts, CASE WHEN grp IS NULL THEN NULL ELSE {_FWD} END AS fwd FROM log)
SELECT event_id, first_value(fwd IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sparse
FROM f
""")
def q_fill_group_then_global(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "ts", "grp", "sparse")
    return fill.fill_group_then_global(lg, "grp", "sparse", order=LOG_ORDER, bucket=log_buckets()).select("event_id", "sparse")


# Carry the parent's sign --------------------------------------------------------
@register("carry_sign", f"""
WITH {LOG_CTE.strip()}
SELECT event_id,
       CAST(abs(qty) * CASE WHEN grp IS NULL THEN 1 ELSE coalesce(
         last_value(CASE WHEN event_id % 3 = 0 THEN sign(qty) END IGNORE NULLS)
           OVER (PARTITION BY grp ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1) END AS DOUBLE) AS qty
FROM log
""")
def q_carry_sign(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "ts", "grp", "qty", "day")
    res = fill.carry_sign(lg, "grp", "qty", F.col("event_id") % 3 != 0, order=LOG_ORDER, bucket="day")
    return res.select("event_id", F.col("qty").cast("double").alias("qty"))


# Numbering and picking ------------------------------------------------------------
_LI_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@register("occurrence", """
WITH li AS (SELECT *, CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS shipdate,
       CAST(CASE WHEN flag IS NULL THEN 0 ELSE row_number() OVER (
            PARTITION BY l_orderkey, flag, l_quantity
            ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) END AS INTEGER) AS occurrence
FROM li
""")
def q_occurrence(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn("flag", F.when(F.col("l_linenumber") % 7 == 0, F.lit(None).cast("string"))
                       .otherwise(F.col("l_returnflag")))
    res = keys.occurrence(li, ["l_orderkey", "flag", "l_quantity"], order=_LI_ORDER, bucket=F.year("l_shipdate"))
    return res.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                      F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"), "occurrence")


@register("keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
""")
def q_keep_first(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_quantity", "l_shipdate", "l_extendedprice")
    res = keys.keep_first(li, "l_orderkey", order=_LI_ORDER)
    return res.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@register("last_wins", """
WITH li AS (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem)
SELECT l_partkey, flag AS last_flag FROM li
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                           l_suppkey DESC, l_extendedprice DESC) = 1
""")
def q_last_wins(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn("flag", F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string"))
                       .otherwise(F.col("l_returnflag")))
    return keys.last_value_map(li, "l_partkey", "flag",
                               order=["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"],
                               out_value="last_flag")


# Reverse deduction --------------------------------------------------------------------
@register("reverse_deduct", f"""
WITH {LOG_CTE.strip()},
debt AS (SELECT bill, item, sum(-qty) AS d FROM log WHERE qty < 0 GROUP BY bill, item),
r AS (
  SELECT p.event_id, p.bill, p.item, p.qty,
         coalesce(sum(p.qty) OVER (PARTITION BY p.bill, p.item ORDER BY p.ts DESC, p.event_id DESC
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS after,
         coalesce(d.d, 0) AS d
  FROM log p LEFT JOIN debt d ON p.bill = d.bill AND p.item = d.item
  WHERE p.qty > 0)
SELECT event_id, bill, item, CAST(greatest(0, least(qty, qty - greatest(0, d - after))) AS BIGINT) AS qty
FROM r WHERE greatest(0, least(qty, qty - greatest(0, d - after))) > 0
""")
def q_reverse_deduct(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "ts", "bill", "item", "qty", "day")
    res = deduct.reverse_deduct(lg, "qty", ["bill", "item"], order=LOG_ORDER, bucket="day")
    return res.select("event_id", "bill", "item", "qty")


# Merge / split chains ----------------------------------------------------------------
# Links between bills derived from events: users 3→5→7→3 form a cycle, 9 links
# to itself, 11 points at a bill outside the data, every other user u points
# at u div 2 (so chains run down to 0, which links to itself); an event whose
# id is divisible by 4 carries no target, and the *last* event of a user
# (by ts, event_id) decides its link, even when it carries none.
def _link_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    u = F.col("user_id")
    target = (F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("string"))
              .when(u == 3, F.lit("U5")).when(u == 5, F.lit("U7")).when(u == 7, F.lit("U3"))
              .when(u == 9, F.lit("U9")).when(u == 11, F.lit("U999999"))
              .otherwise(F.concat(F.lit("U"), F.floor(u / 2).cast("string"))))
    return ev.select("event_id", "ts", F.concat(F.lit("U"), u.cast("string")).alias("bill_id"),
                     F.concat(F.lit("N"), u.cast("string"), F.lit("-"), (F.col("event_id") % 3).cast("string")).alias("bill_no"),
                     target.alias("target"))


LINK_SQL = """
e AS (
  SELECT event_id, ts, 'U' || CAST(user_id AS VARCHAR) AS bill_id,
         'N' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) AS bill_no,
         CASE WHEN event_id % 4 = 0 THEN NULL
              WHEN user_id = 3 THEN 'U5' WHEN user_id = 5 THEN 'U7' WHEN user_id = 7 THEN 'U3'
              WHEN user_id = 9 THEN 'U9' WHEN user_id = 11 THEN 'U999999'
              ELSE 'U' || CAST(user_id // 2 AS VARCHAR) END AS target
  FROM events),
m AS (SELECT bill_id AS src, target AS dst FROM e
      QUALIFY row_number() OVER (PARTITION BY bill_id ORDER BY ts DESC, event_id DESC) = 1)"""

_WALK_STOP = "(m.src IS NULL OR m.dst IS NULL OR m.dst = w.cur OR list_contains(w.visited, m.dst))"
_WALK_REENTER = "(m.src IS NULL OR list_contains(w.visited, w.cur) OR m.dst IS NULL OR m.dst = w.cur)"


def _walk_sql(edges: str, stop: str) -> str:
    return f"""
WITH RECURSIVE {LINK_SQL.strip()},
{edges},
walk(start, cur, visited, done) AS (
  SELECT DISTINCT bill_id, bill_id, CAST([] AS VARCHAR[]), false FROM e
  UNION ALL
  SELECT w.start,
         CASE WHEN {stop} THEN w.cur ELSE m.dst END,
         CASE WHEN {stop} THEN w.visited ELSE list_append(w.visited, w.cur) END,
         {stop}
  FROM walk w LEFT JOIN lk m ON m.src = w.cur
  WHERE NOT w.done)"""


@register("resolve_final", _walk_sql("lk AS (SELECT * FROM m)", _WALK_STOP) + """
SELECT start AS id, cur AS final FROM walk WHERE done
""")
def q_resolve_final(spark, sf_dir):
    from tillwork.operators.links import resolve_links
    e = _link_events(spark, sf_dir)
    edges = keys.last_value_map(e, "bill_id", "target", order=LOG_ORDER, out_key="src", out_value="dst")
    return resolve_links(e.select(F.col("bill_id").alias("id")), edges, cycle="stop")


@register("resolve_root", _walk_sql("lk AS (SELECT src, dst FROM e2 QUALIFY row_number() OVER (PARTITION BY src ORDER BY ts DESC, event_id DESC) = 1),\n"
                                    "e2x AS (SELECT 1)", _WALK_REENTER).replace(
    "lk AS (SELECT src", "e2 AS (SELECT bill_id AS src, target AS dst, ts, event_id FROM e WHERE target IS NOT NULL),\nlk AS (SELECT src") + """
SELECT start AS id, cur AS final FROM walk WHERE done
""")
def q_resolve_root(spark, sf_dir):
    from tillwork.operators.links import resolve_links
    e = _link_events(spark, sf_dir)
    edges = keys.last_value_map(e.filter(F.col("target").isNotNull()), "bill_id", "target", order=LOG_ORDER,
                                out_key="src", out_value="dst")
    return resolve_links(e.select(F.col("bill_id").alias("id")), edges, cycle="reenter")


@register("rewrite_ids", _walk_sql("lk AS (SELECT * FROM m)", _WALK_STOP) + """,
fin AS (SELECT start AS id, cur AS final FROM walk WHERE done),
nos AS (SELECT bill_id, bill_no FROM e QUALIFY row_number() OVER (PARTITION BY bill_id ORDER BY ts, event_id) = 1)
SELECT e.event_id, fin.final AS bill_id, nos.bill_no AS bill_no
FROM e JOIN fin ON e.bill_id = fin.id LEFT JOIN nos ON nos.bill_id = fin.final
""")
def q_rewrite_ids(spark, sf_dir):
    from tillwork.operators.links import resolve_links, rewrite_ids
    e = _link_events(spark, sf_dir)
    edges = keys.last_value_map(e, "bill_id", "target", order=LOG_ORDER, out_key="src", out_value="dst")
    resolved = resolve_links(e.select(F.col("bill_id").alias("id")), edges, cycle="stop")
    numbers = keys.keep_first(e.select("bill_id", "bill_no", "ts", "event_id"), "bill_id", order=LOG_ORDER)
    res = rewrite_ids(e, resolved, numbers.select(F.col("bill_id").alias("id"), F.col("bill_no").alias("no")),
                      "bill_id", "bill_no")
    return res.select("event_id", "bill_id", "bill_no")


# Explode next to the parent, overlay, mark --------------------------------------------
def _children_frame(spark, sf_dir, with_id_clash: bool):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    k = N.extract_field("props", "k", None, "int", style="json")
    n = (F.col("event_id") % 3).cast("int")
    kids = []
    for i in (1, 2):
        fields = [F.concat(F.col("event_type"), F.lit(f"#{i}")).alias("item_name"),
                  (k + F.lit(i)).cast("double").alias("quantity"),
                  F.lit(i * 1000.0).alias("price")]
        if with_id_clash:
            fields += [(F.col("event_id") + F.lit(100000 * i)).alias("event_id"),
                       F.concat(F.lit("SKU"), F.lit(str(i))).alias("sku")]
        else:
            fields += [(F.lit("L") if i == 2 else F.lit(None).cast("string")).alias("size")]
        kids.append(F.struct(*fields))
    base = ev.select("event_id", F.col("event_type").alias("item_name"), F.col("value").alias("quantity"),
                     F.lit(None).cast("double").alias("price"),
                     F.slice(F.array(*kids), 1, n).alias("children"))
    from tillwork.operators.nested import explode_keep_parent
    return explode_keep_parent(base, "children").drop("children")


_KIDS_SQL = """
b AS (SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id % 3 AS n
      FROM events),
kid AS (SELECT b.*, CAST(t.i AS INTEGER) AS i FROM b JOIN range(1, 3) t(i) ON t.i <= b.n)"""


@register("explode_keep_parent", f"""
WITH {_KIDS_SQL.strip()}
SELECT event_id, 0 AS child_pos, event_type AS item_name, value AS quantity, CAST(NULL AS DOUBLE) AS price,
       CAST(NULL AS VARCHAR) AS size FROM b
UNION ALL
SELECT event_id, i AS child_pos, '+ ' || event_type || '#' || CAST(i AS VARCHAR) AS item_name,
       CAST(k + i AS DOUBLE) AS quantity, i * 1000.0 AS price, CASE WHEN i = 2 THEN 'L' END AS size FROM kid
""")
def q_explode_keep_parent(spark, sf_dir):
    from tillwork.operators.nested import mark_children, overlay_children
    ex = _children_frame(spark, sf_dir, with_id_clash=False)
    is_child = F.col("child").isNotNull()
    ex = ex.withColumn("__is_child", is_child)
    res = overlay_children(ex, "child", overwrite="all")
    res = mark_children(res, F.col("__is_child"), "item_name")
    return res.select("event_id", "child_pos", "item_name", "quantity", "price", "size")


@register("overwrite_children", f"""
WITH {_KIDS_SQL.strip()}
SELECT event_id, 0 AS child_pos, event_type AS item_name, value AS quantity, CAST(NULL AS DOUBLE) AS price,
       CAST(NULL AS VARCHAR) AS sku FROM b
UNION ALL
SELECT event_id, i AS child_pos, '+ ' || event_type || '#' || CAST(i AS VARCHAR) AS item_name,
       CAST(k + i AS DOUBLE) AS quantity, i * 1000.0 AS price, 'SKU' || CAST(i AS VARCHAR) AS sku FROM kid
""")
def q_overwrite_children(spark, sf_dir):
    from tillwork.operators.nested import DISPLAY_FIELDS, mark_children, overlay_children
    ex = _children_frame(spark, sf_dir, with_id_clash=True)
    ex = ex.withColumn("__is_child", F.col("child").isNotNull())
    res = overlay_children(ex, "child", overwrite=DISPLAY_FIELDS)
    res = mark_children(res, F.col("__is_child"), "item_name")
    return res.select("event_id", "child_pos", "item_name", "quantity", "price", "sku")


# List text ---------------------------------------------------------------------------
def _list_text():
    k = F.get_json_object("props", "$.k")
    r = F.col("event_id") % 6
    return (F.when(r == 0, F.concat(F.lit("[{'item_name': 'A', 'quantity': "), k, F.lit("}]")))
            .when(r == 1, F.lit(""))
            .when(r == 2, F.lit("None"))
            .when(r == 3, F.concat(F.lit("[{'item_name': 'Cà phê d'Arc', 'quantity': "), k, F.lit("}]")))
            .when(r == 4, F.lit("{'item_name': 'A'}"))
            .otherwise(F.concat(F.lit("[{'item_name': 'B', 'quantity': "), k,
                                F.lit("}, {'item_name': 'C', 'quantity': None, 'flag': True}]"))))


@register("parse_list", """
WITH b AS (SELECT event_id, event_id % 6 AS r, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
SELECT event_id,
       CASE r WHEN 0 THEN 1 ELSE 0 END AS n_json,
       CASE r WHEN 0 THEN 1 WHEN 5 THEN 2 ELSE 0 END AS n_python,
       CASE WHEN r = 0 THEN k END AS first_qty_json,
       CASE WHEN r IN (0, 5) THEN k END AS first_qty_python,
       CASE WHEN r = 5 THEN 'C' END AS second_name_python
FROM b
""")
def q_parse_list(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    schema = "struct<item_name:string,quantity:double,flag:boolean>"
    ev = spread(ev).select("event_id", _list_text().alias("text"))
    staged = ev.select("event_id", N.parse_list("text", schema, style="json").alias("j"),
                       N.parse_list("text", schema, style="python").alias("p"))
    return staged.select("event_id", F.size("j").alias("n_json"), F.size("p").alias("n_python"),
                         F.try_element_at("j", F.lit(1))["quantity"].alias("first_qty_json"),
                         F.try_element_at("p", F.lit(1))["quantity"].alias("first_qty_python"),
                         F.try_element_at("p", F.lit(2))["item_name"].alias("second_name_python"))


# Dict text fields ------------------------------------------------------------------
def _dict_text():
    k = F.get_json_object("props", "$.k")
    eid = F.col("event_id").cast("string")
    r = F.col("event_id") % 5
    return (F.when(r == 0, F.concat(F.lit("{'peo_count': "), k, F.lit(", 'Membership_Type_Name': 'Gold', "
                                                                       "'customer_name': 'An', 'customer_phone': None, 'tran_id': 'D"),
                                    eid, F.lit("'}")))
            .when(r == 1, F.concat(F.lit("{'peo_count': "), k, F.lit("}")))
            .when(r == 2, F.lit("nan"))
            .when(r == 3, F.lit("{'customer_name': 'Bình', 'message_modify_table': 'Bàn 5 gộp vào HD00000001 - x'}"))
            .otherwise(F.concat(F.lit("[{'tran_id': 'T1'}, {'tran_id': 'T"), eid, F.lit("'}]"))))


@register("extract_fields", """
WITH b AS (SELECT event_id, event_id % 5 AS r, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, k,
       CASE WHEN r IN (0, 1) THEN k ELSE 0 END AS peo_count,
       CASE WHEN r = 0 THEN 'Gold' ELSE '' END AS membership,
       CASE r WHEN 0 THEN 'An' WHEN 3 THEN 'Bình' ELSE '' END AS customer_name,
       CASE WHEN r = 0 THEN NULL ELSE '' END AS customer_phone,
       CASE WHEN r = 3 THEN 'Bàn 5 gộp vào HD00000001 - x' ELSE '' END AS note,
       CASE r WHEN 0 THEN 'D' || CAST(event_id AS VARCHAR) WHEN 4 THEN 'T' || CAST(event_id AS VARCHAR)
              ELSE 'E' || CAST(event_id AS VARCHAR) END AS tran_id
FROM b
""")
def q_extract_fields(spark, sf_dir):
    ev = spread(table(spark, sf_dir, "events").select("event_id", "props"))
    staged = ev.select("event_id", "props", _dict_text().alias("extra"))
    staged = N.with_dict_fields(staged, "extra", {"peo_count": ("int", 0), "Membership_Type_Name": ("string", ""),
                                                  "customer_name": ("string", ""), "customer_phone": ("string", ""),
                                                  "message_modify_table": ("string", "")},
                                names={"Membership_Type_Name": "membership", "message_modify_table": "note"})
    return staged.select(
        "event_id",
        N.extract_field("props", "k", None, "int", style="json").alias("k"),
        "peo_count", "membership", "customer_name", "customer_phone", "note",
        F.coalesce(N.extract_id("extra", "tran_id"),
                   F.concat(F.lit("E"), F.col("event_id").cast("string"))).alias("tran_id"),
    )


# N1-N5 on texts whose quotes or ends mislead a reader ------------------------------------------------
# (list text, dict text, entries of the Python list, guests, customer, id) by event_id % 8
MISLEADING = (
    ("[{'item_name': 'Tra, None, da', 'quantity': None}]", "{'peo_count': 4, 'customer_name': 'A, null, B', 'tran_id': 'D1'}", 1, 4, "A, null, B", "D1"),
    ("[{'item_name': 'a'}],'k':2", "{'peo_count': 4},'k':{}", 0, 0, "", None),
    ("[{'item_name': 'a'}],[{'item_name': 'b'}]", "{'peo_count': 4}]", 0, 0, "", None),
    ("[{'item_name': 'None'}, {'item_name': '[True]', 'flag': True}]", "{'peo_count': 2, 'customer_name': 'True], x', 'flag': False}", 2, 2, "True], x", None),
    ("[{'item_name': 'it\\'s None', 'quantity': 1}]", "{'customer_name': 'x', 'd': {'peo_count': 9}, 'tran_id': 'D4'}", 1, 0, "x", "D4"),
    ("[{'item_name': 'a', 'flag': null}]", "{'peo_count': null}", 0, 0, "", None),
    ("[{'item_name': 'a', 'tags': [None, 'x]']}]],[[", "[{'tran_id': 'D6'}, {'tran_id': 'null, D6'}]", 0, 0, "", "null, D6"),
    ("[]", "{'peo_count': 3, 'customer_name': '}', 'tran_id': 'D7'},'x':{'y':1}", 0, 0, "", None),
)


def _by_rest(values) -> str:
    return " ".join(f"WHEN {i} THEN {_sql_text(v)}" for i, v in enumerate(values))


def _sql_text(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


@register("misleading_texts", f"""
SELECT event_id, CASE event_id % 8 {_by_rest([m[2] for m in MISLEADING])} END AS n_items,
       CASE event_id % 8 WHEN 0 THEN 'Tra, None, da' WHEN 3 THEN 'None' WHEN 4 THEN 'it''s None' END AS first_name,
       CASE event_id % 8 WHEN 3 THEN '[True]' END AS flagged_name,
       CASE event_id % 8 {_by_rest([m[3] for m in MISLEADING])} END AS peo_count,
       CASE event_id % 8 {_by_rest([m[4] for m in MISLEADING])} END AS customer_name,
       CASE event_id % 8 {_by_rest([m[5] for m in MISLEADING])} END AS tran_id
FROM events
""")
def q_misleading_texts(spark, sf_dir):
    case = lambda i: F.get(F.array(*[F.lit(m[i]) for m in MISLEADING]), (F.col("event_id") % 8).cast("int"))
    ev = spread(table(spark, sf_dir, "events").select("event_id")).select("event_id", case(0).alias("items"), case(1).alias("extra"))
    staged = N.with_dict_fields(ev, "extra", {"peo_count": ("int", 0), "customer_name": ("string", "")})
    staged = staged.select("*", N.parse_list("items", "struct<item_name:string,quantity:double,flag:boolean>", style="python").alias("list"),
                           N.extract_id("extra", "tran_id").alias("tran_id"))
    return staged.select("event_id", F.size("list").alias("n_items"), F.get("list", F.lit(0))["item_name"].alias("first_name"),
                         F.get(F.filter("list", lambda x: x["flag"]), F.lit(0))["item_name"].alias("flagged_name"),
                         "peo_count", "customer_name", "tran_id")


# C12 with a table of rules: one rule per part, a piece of its label; the last rule in a label wins ----
@register("price_rules", """
WITH labels AS (SELECT p_partkey, p_name || ' ' || p_partkey AS label, p_retailprice FROM part),
rules AS (SELECT p_partkey AS no, substr(label, CAST(1 + p_partkey % 4 AS INTEGER), CAST(4 + p_partkey % 9 AS INTEGER)) AS pattern, p_retailprice + 1 AS price FROM labels),
best AS (SELECT label, arg_max(price, no) AS price FROM (SELECT DISTINCT label FROM labels) JOIN rules ON contains(label, pattern) GROUP BY label)
SELECT l_orderkey, l_linenumber, l_extendedprice, label AS item, round(coalesce(best.price, p_retailprice), 2) AS unit_price
FROM lineitem JOIN labels ON l_partkey = p_partkey LEFT JOIN best USING (label)
""")
def q_price_rules(spark, sf_dir):
    from tillwork.operators.prices import override_price_table

    key = F.col("p_partkey")
    label = F.concat_ws(" ", "p_name", key.cast("string"))
    parts = table(spark, sf_dir, "part").select("p_partkey", label.alias("item"), F.col("p_retailprice").alias("unit_price"))
    rules = parts.select(key.alias("rule_no"), F.substring("item", (1 + key % 4).cast("int"), (4 + key % 9).cast("int")).alias("pattern"), (F.col("unit_price") + 1).alias("price"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    lines = lines.join(parts, F.col("l_partkey") == key)
    out = override_price_table(lines, "item", "unit_price", rules)
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", "item", F.round("unit_price", 2).alias("unit_price"))


# Pages that a broken fetch left out, per store and day --------------------------------------
@register("missing_pages", """
WITH p AS (SELECT user_id % 5 AS store, strftime(ts, '%Y-%m-%d') AS day, CAST(user_id // 10 % 12 AS INTEGER) AS page, count(*) AS n FROM events GROUP BY ALL),
g AS (SELECT *, coalesce(lag(page) OVER w, 0) AS before, lead(page) OVER w AS next FROM p WHERE page > 0 WINDOW w AS (PARTITION BY store, day ORDER BY page))
SELECT 'S' || store AS store_uid, day AS report_date, before + 1 AS from_page, page - 1 AS to_page FROM g WHERE page > before + 1
UNION ALL
SELECT 'S' || store, day, page + 1, NULL FROM g WHERE next IS NULL AND n >= 3
""")
def q_missing_pages(spark, sf_dir):
    from tillwork.sources.pages import missing_pages

    ev = table(spark, sf_dir, "events")
    page = (F.floor(F.col("user_id") / 10) % 12).cast("int")
    landed = (ev.groupBy(F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("store_uid"), F.date_format("ts", "yyyy-MM-dd").alias("report_date"), page.alias("page_no"))
              .agg(F.count("*").alias("entries")).where(F.col("page_no") > 0))
    return missing_pages(landed, page_size=3)


# Flagged history, exclusion, lookup ------------------------------------------------------
@register("flagged_history", f"""
WITH {LOG_CTE.strip()}
SELECT event_id, grp, log_type FROM log l
WHERE EXISTS (SELECT 1 FROM log f WHERE f.grp IS NOT DISTINCT FROM l.grp
              AND regexp_matches(f.log_type, '(?i)SALE_SPLIT_ORDER|SALE_MERGE_ORDER'))
""")
def q_flagged_history(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "grp", "log_type")
    return joins.keep_flagged(lg, "grp", P.contains_any("log_type", "SALE_SPLIT_ORDER|SALE_MERGE_ORDER"))


@register("exclude_list", f"""
WITH {LOG_CTE.strip()}
SELECT event_id, grp, log_type FROM log l
WHERE l.log_type IN ('SALE_CHANGE', 'SALE_SPLIT_ORDER', 'SALE_MERGE_ORDER')
  AND NOT EXISTS (SELECT 1 FROM log x WHERE x.grp IS NOT DISTINCT FROM l.grp
                  AND x.log_type IN ('SALE_CHANGE', 'SALE_SPLIT_ORDER', 'SALE_MERGE_ORDER')
                  AND NOT coalesce(regexp_matches(x.log_type, '(?i)SALE_CHANGE'), false))
""")
def q_exclude_list(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "grp", "log_type")
    lg = lg.filter(P.is_one_of("log_type", A.LOG_TYPES))
    others = lg.filter(~P.contains_any("log_type", "SALE_CHANGE")).select("grp")
    return joins.exclude_listed(lg, "grp", others, "grp")


@register("lookup", """
SELECT e.event_id, c.c_name AS customer FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def q_lookup(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.lookup(ev, "user_id", cust, "c_custkey", "c_name", out="customer").select("event_id", "customer")


# J2–J5 (X6): two-pass matching of log rows to invoice lines ---------------------------------
# Both sides come from lineitem: the invoice side is the line as is; the log
# side changes the quantity of every 5th line number (strict miss, loose hit)
# and the item of every 6th (miss on both); every 7th has a null item on both
# sides (null-safe keys, occurrence 0).
_IDENT = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _match_sides(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    code = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    q = F.col("l_quantity").cast("bigint")
    base = li.select("l_orderkey", *_IDENT, "l_shipdate",
                     F.col("l_orderkey").cast("string").alias("bill"), q.alias("q"),
                     F.when(ln % 7 == 0, F.lit(None).cast("string")).otherwise(code).alias("vi"),
                     F.when(ln % 7 == 0, F.lit(None).cast("string")).when(ln % 6 == 0, F.lower(code))
                      .otherwise(code).alias("li_item"),
                     F.when(ln % 5 == 0, q + 1).otherwise(q).alias("li_qty"))
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    yb = F.year("l_shipdate")
    v = keys.occurrence(base, ["bill", "vi", "q"], order=order, out="v_occ", bucket=yb).select(
        F.col("bill").alias("v_invoice_id"), F.col("vi").alias("v_item"), F.col("q").alias("v_qty"), "v_occ",
        *[F.col(c).alias("v_" + c[2:]) for c in _IDENT])
    lg = keys.occurrence(base, ["bill", "li_item", "li_qty"], order=order, out="l_occ", bucket=yb).select(
        F.col("bill").alias("l_invoice_id"), F.col("li_item").alias("l_item"), F.col("li_qty").alias("l_qty"), "l_occ",
        F.struct(*order).alias("l_ord"), *[F.col(c).alias("lg_" + c[2:]) for c in _IDENT])
    return lg, v


MATCH_CTE = """
li AS (SELECT *, CAST(trunc(l_quantity) AS BIGINT) AS q, l_returnflag || l_linestatus AS code FROM lineitem),
b AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS bill,
             CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE code END AS vi,
             CASE WHEN l_linenumber % 7 = 0 THEN NULL WHEN l_linenumber % 6 = 0 THEN lower(code) ELSE code END AS li_item,
             CASE WHEN l_linenumber % 5 = 0 THEN q + 1 ELSE q END AS li_qty
      FROM li),
v AS (SELECT bill AS v_invoice_id, vi AS v_item, q AS v_qty,
             CAST(CASE WHEN vi IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY bill, vi, q
                  ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) END AS INTEGER) AS v_occ,
             l_linenumber AS v_linenumber, l_partkey AS v_partkey, l_suppkey AS v_suppkey, l_extendedprice AS v_extendedprice
      FROM b),
l AS (SELECT bill AS l_invoice_id, li_item AS l_item, li_qty AS l_qty,
             CAST(CASE WHEN li_item IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY bill, li_item, li_qty
                  ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) END AS INTEGER) AS l_occ,
             l_shipdate, l_linenumber AS lg_linenumber, l_partkey AS lg_partkey, l_suppkey AS lg_suppkey,
             l_extendedprice AS lg_extendedprice
      FROM b),
strict AS (SELECT v.*, l.lg_linenumber, l.lg_partkey, l.lg_suppkey, l.lg_extendedprice, l.l_item
           FROM l RIGHT JOIN v ON l.l_invoice_id IS NOT DISTINCT FROM v.v_invoice_id
             AND l.l_item IS NOT DISTINCT FROM v.v_item AND l.l_qty IS NOT DISTINCT FROM v.v_qty
             AND l.l_occ IS NOT DISTINCT FROM v.v_occ)"""

_V_OUT = "v_invoice_id, v_linenumber, v_partkey, v_suppkey, v_extendedprice"
_L_OUT = "lg_linenumber, lg_partkey, lg_suppkey, lg_extendedprice"


@register("match_strict", f"""
WITH {MATCH_CTE.strip()}
SELECT {_V_OUT}, {_L_OUT} FROM strict
""")
def q_match_strict(spark, sf_dir):
    lg, v = _match_sides(spark, sf_dir)
    m = joins.match_strict(lg, v, [("l_invoice_id", "v_invoice_id"), ("l_item", "v_item"), ("l_qty", "v_qty"),
                                   ("l_occ", "v_occ")], how="right")
    return m.select(*_V_OUT.split(", "), *_L_OUT.split(", "))


@register("unmatched_log", f"""
WITH {MATCH_CTE.strip()}
SELECT l_invoice_id, {_L_OUT} FROM l
WHERE NOT EXISTS (SELECT 1 FROM v WHERE l.l_invoice_id IS NOT DISTINCT FROM v.v_invoice_id
                  AND l.l_item IS NOT DISTINCT FROM v.v_item AND l.l_qty IS NOT DISTINCT FROM v.v_qty
                  AND l.l_occ IS NOT DISTINCT FROM v.v_occ)
""")
def q_unmatched_log(spark, sf_dir):
    lg, v = _match_sides(spark, sf_dir)
    left = joins.unmatched(lg, v, [("l_invoice_id", "v_invoice_id"), ("l_item", "v_item"), ("l_qty", "v_qty"),
                                   ("l_occ", "v_occ")])
    return left.select("l_invoice_id", *_L_OUT.split(", "))


@register("match_loose", f"""
WITH {MATCH_CTE.strip()},
left_log AS (SELECT * FROM l
             WHERE NOT EXISTS (SELECT 1 FROM v WHERE l.l_invoice_id IS NOT DISTINCT FROM v.v_invoice_id
                   AND l.l_item IS NOT DISTINCT FROM v.v_item AND l.l_qty IS NOT DISTINCT FROM v.v_qty
                   AND l.l_occ IS NOT DISTINCT FROM v.v_occ)
             QUALIFY row_number() OVER (PARTITION BY l_invoice_id, l_item
                     ORDER BY l_shipdate, lg_linenumber, lg_partkey, lg_suppkey, lg_extendedprice) = 1),
left_inv AS (SELECT * FROM strict WHERE l_item IS NULL)
SELECT {_V_OUT.replace("v_", "left_inv.v_")}, {_L_OUT.replace("lg_", "left_log.lg_")}
FROM left_log JOIN left_inv ON left_log.l_invoice_id IS NOT DISTINCT FROM left_inv.v_invoice_id
                           AND left_log.l_item IS NOT DISTINCT FROM left_inv.v_item
""")
def q_match_loose(spark, sf_dir):
    lg, v = _match_sides(spark, sf_dir)
    pairs = [("l_invoice_id", "v_invoice_id"), ("l_item", "v_item"), ("l_qty", "v_qty"), ("l_occ", "v_occ")]
    strict = joins.match_strict(lg, v, pairs, how="right")
    _, left_inv = joins.split_matched(strict, "l_item")
    left_log = joins.unmatched(lg, v, pairs)
    loose = joins.match_loose(left_log, left_inv.select(*[c for c in left_inv.columns if c.startswith("v_")]),
                              [("l_invoice_id", "v_invoice_id"), ("l_item", "v_item")],
                              dedupe_keys=["l_invoice_id", "l_item"], order=["l_ord"])
    return loose.select(*_V_OUT.split(", "), *_L_OUT.split(", "))


# Net orders — calendar parts, reverse deduction, occurrence --------------------------------
@register("net_orders", f"""
WITH {LOG_CTE.strip()},
debt AS (SELECT bill, item, sum(-qty) AS d FROM log WHERE qty < 0 GROUP BY bill, item),
r AS (
  SELECT p.event_id, p.ts, p.bill, p.item, p.qty,
         coalesce(sum(p.qty) OVER (PARTITION BY p.bill, p.item ORDER BY p.ts DESC, p.event_id DESC
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS after,
         coalesce(d.d, 0) AS d
  FROM log p LEFT JOIN debt d ON p.bill = d.bill AND p.item = d.item
  WHERE p.qty > 0),
n AS (SELECT event_id, ts, bill, item, greatest(0, least(qty, qty - greatest(0, d - after))) AS q FROM r)
SELECT event_id, strftime(ts, '%d/%m/%Y') AS date, strftime(ts, '%V-%G') AS week, strftime(ts, '%m-%Y') AS month,
       CAST(year(ts) AS INTEGER) AS year, CAST(q AS BIGINT) AS qty,
       CAST(row_number() OVER (PARTITION BY bill, item, q ORDER BY ts, event_id) AS INTEGER) AS occurrence
FROM n WHERE q > 0
""")
def q_net_orders(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("event_id", "ts", "bill", "item", "qty", "day")
    lg = lg.withColumns(S.calendar_parts("ts"))
    net = deduct.reverse_deduct(lg, "qty", ["bill", "item"], order=LOG_ORDER, bucket="day")
    occ = keys.occurrence(net, ["bill", "item", "qty"], order=LOG_ORDER, out="occurrence", bucket="day")
    return occ.select("event_id", "date", "week", "month", "year", "qty", "occurrence")


# Split inventory on the events stand-in (no SQL: checked against a
# sequential walk on small fixtures in tests/test_driver_splits.py) -------------------------------
def split_inventory_input(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid = F.col("event_id")
    whole = F.col("value").cast("bigint") + F.lit(1)
    is_split = eid % 10 == 0
    target = F.concat(F.lit("C"), F.col("user_id").cast("string"), F.lit("-"), (eid % 3).cast("string"))
    return ev.select(
        "event_id", "ts",
        F.concat(F.lit("F"), F.col("user_id").cast("string")).alias("family"),
        F.col("event_type").alias("item"),
        F.when(is_split, -whole).when(eid % 7 == 0, -whole).otherwise(whole).cast("double").alias("qty"),
        F.when(is_split, F.lit("SALE_SPLIT_ORDER")).otherwise(F.lit("SALE_CHANGE")).alias("log_type"),
        F.when(is_split, target).alias("split_to"),
        F.when(is_split, F.concat(F.lit("N"), target)).alias("split_no"),
        F.concat(F.lit("I"), F.col("user_id").cast("string")).alias("invoice_id"),
        F.concat(F.lit("N"), F.col("user_id").cast("string")).alias("invoice_no"),
        F.struct("event_id").alias("ord"),
    )


# The oracle is the closed form: an edit's layer lies on the stock b below it and keeps
# min(its quantity, least later stay - b); each event takes what it makes that smaller.
# closed form over inp(event_id, ts, family, item, qty, target, log_type or none): portions p(event_id, target, qty)
SPLIT_CTE = """calls AS (SELECT family, ts, target, min(event_id) AS pos FROM inp WHERE target IS NOT NULL AND family IS NOT NULL GROUP BY ALL),
listed AS (SELECT family, ts, target, item, abs(sum(qty)) AS stays FROM inp WHERE target IS NOT NULL GROUP BY ALL),
adds AS (SELECT * FROM inp WHERE target IS NULL AND qty > 0 AND family IS NOT NULL),
things AS (SELECT DISTINCT family, item FROM adds),
steps AS (
  SELECT family, item, ts, event_id AS pos, qty AS q, CAST(NULL AS DOUBLE) AS stays, CAST(NULL AS VARCHAR) AS target FROM adds
  UNION ALL
  SELECT c.family, t.item, c.ts, c.pos, 0, coalesce(l.stays, 0), c.target
  FROM calls c JOIN things t USING (family)
  LEFT JOIN listed l ON l.family = c.family AND l.ts IS NOT DISTINCT FROM c.ts AND l.target = c.target AND l.item IS NOT DISTINCT FROM t.item),
running AS (
  SELECT *, row_number() OVER o AS rn, sum(q) OVER o AS c FROM steps
  WINDOW o AS (PARTITION BY family, item ORDER BY ts NULLS LAST, pos ROWS UNBOUNDED PRECEDING)),
heights AS (
  SELECT *, c - greatest(0, coalesce(max(c - stays) OVER (PARTITION BY family, item ORDER BY rn ROWS UNBOUNDED PRECEDING), 0)) AS height FROM running),
layers AS (SELECT family, item, pos AS event_id, rn, q, height - q AS b FROM heights WHERE stays IS NULL),
later AS (
  SELECT l.event_id, l.q, l.b, s.target, s.rn,
         least(l.q, greatest(0, min(s.stays) OVER (PARTITION BY l.event_id ORDER BY s.rn ROWS UNBOUNDED PRECEDING) - l.b)) AS keeps
  FROM layers l JOIN heights s ON s.family = l.family AND s.item IS NOT DISTINCT FROM l.item AND s.rn > l.rn AND s.stays IS NOT NULL),
moved AS (SELECT event_id, target, coalesce(lag(keeps) OVER (PARTITION BY event_id ORDER BY rn), q) - keeps AS qty FROM later),
kept AS (SELECT l.event_id, CAST(NULL AS VARCHAR) AS target, coalesce(min(t.keeps), min(l.q)) AS qty FROM layers l LEFT JOIN later t USING (event_id) GROUP BY l.event_id)"""

SPLIT_SQL = f"""
WITH inp AS (
  SELECT event_id, ts, 'F' || user_id AS family, event_type AS item,
         CASE WHEN event_id % 10 = 0 OR event_id % 7 = 0 THEN -1 ELSE 1 END * CAST(CAST(trunc(value) AS BIGINT) + 1 AS DOUBLE) AS qty,
         CASE WHEN event_id % 10 = 0 THEN 'C' || user_id || '-' || (event_id % 3) END AS target,
         'I' || user_id AS invoice_id, 'N' || user_id AS invoice_no
  FROM events),
{SPLIT_CTE}
SELECT i.event_id, i.family, i.item, coalesce(p.target, i.invoice_id) AS invoice_id,
       CASE WHEN p.target IS NULL THEN i.invoice_no ELSE 'N' || p.target END AS invoice_no, p.qty
FROM (SELECT * FROM moved UNION ALL SELECT * FROM kept) p JOIN inp i USING (event_id) WHERE p.qty > 0
"""


@register("split_inventory", SPLIT_SQL)
def q_split_inventory(spark, sf_dir):
    from tillwork.operators.splits import split_inventory

    df = split_inventory_input(spark, sf_dir)
    res = split_inventory(df, "family", "ts", "item", "qty", "log_type", "split_to", "split_no",
                          "invoice_id", "invoice_no", bucket=F.to_date)
    return res.select("event_id", "family", "item", "invoice_id", "invoice_no", "qty")


# X3 T2 T3 (J1 C9 C10 W2 W3 G1 G2 G3 T1): merged and split bills ------------------------------------
# Eight events a bill.  By the bill number's rest of 5: 0 is merged into 1 (or into a bill that is
# merged back, or into one that is not there), 1 now and then into the next 1 (chains), 2 is
# neither, 3 is split into 4 (or into an absent bill), 4 now and then into the next 4.
MERGE_NOTE, MERGED_NOTE = "Bàn 1 gộp vào {} - chuyển bàn", "[Gộp đơn] từ bàn 1"  # fixed values: the phrases
SPLIT_NOTE, NEW_NOTE = "bỏ món ra, tạo thành hóa đơn {} - tách", "Hóa đơn được tạo mới từ bàn 2"  # of the log's notes


def bill_log(spark, sf_dir) -> DataFrame:
    """A change log as X2 gives it, with chains of merges, splits, cycles, absent targets, null
    ids, null times, blank items and cancellations, from all events."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    eid = F.col("event_id")
    b, r = F.floor(eid / 8), eid % 8
    m, f = b % 5, F.floor(b / 5)
    code = lambda n: F.concat(F.lit("HD"), F.lpad(n.cast("string"), 10, "0"))
    absent = F.concat(F.lit("HDX"), F.lpad(b.cast("string"), 10, "0"))
    merge_to = (F.when((m == 0) & (f % 14 == 2), code(b + 5)).when((m == 0) & (f % 14 == 3), code(b - 5))
                .when((m == 0) & (f % 13 == 0), absent).when(m == 0, code(b + 1))
                .when((m == 1) & (f % 10).isin(3, 4, 5), code(b + 5)))
    split_to = F.when((m == 3) & (f % 11 == 0), absent).when(m == 3, code(b + 1)).when((m == 4) & (f % 4 == 0), code(b + 5))
    is_merge = ((r == 7) & merge_to.isNotNull()) | ((r == 4) & (m == 1))
    is_split = ((r >= 6) & split_to.isNotNull()) | ((r == 0) & (m == 4))
    text = lambda pattern, c: F.concat(F.lit(pattern.split("{}")[0]), c, F.lit(pattern.split("{}")[1]))
    note = (F.when((r == 7) & merge_to.isNotNull(), text(MERGE_NOTE, merge_to)).when((r == 4) & (m == 1), MERGED_NOTE)
            .when((r == 6) & split_to.isNotNull(), text(SPLIT_NOTE, split_to)).when((r == 0) & (m == 4), NEW_NOTE)
            .when(eid % 3 == 0, "").otherwise(None))
    whole = (F.col("value").cast("bigint") + 1).cast("double")
    seconds = b * 60 + F.when(is_split & (r >= 6), 6).otherwise(r)  # the rows of one split have one time
    return ev.select(
        F.struct(eid.alias("event_id"), F.lit(0).cast("long").alias("part")).alias("ord"), eid.alias("event_id"),
        F.when(eid % 97 != 0, code(b)).alias("invoice_id"), F.concat(F.lit("N"), F.lpad(b.cast("string"), 8, "0")).alias("invoice_no"),
        F.when(eid % 101 != 0, F.date_format(F.timestamp_seconds(F.lit(1704067200) + seconds), "yyyy/MM/dd HH:mm:ss")).alias("ts"),
        F.concat(F.lit("B"), (b % 20).cast("string")).alias("table_name"), F.concat(F.lit("E"), (F.col("user_id") % 7).cast("string")).alias("employee"),
        F.when(is_merge, "SALE_MERGE_ORDER").when(is_split, "SALE_SPLIT_ORDER").otherwise("SALE_CHANGE").alias("log_type"), note.alias("note"),
        F.when(eid % 53 == 0, " ").when(eid % 4 == 0, F.concat(F.lit(" "), "event_type")).otherwise(F.col("event_type")).alias("item"),
        F.when(eid % 89 == 0, None).when(is_split | (eid % 7 == 0), -whole).otherwise(whole).alias("qty"))


BILL_LOG_CTE = f"""
b0 AS (SELECT *, event_id // 8 AS b, event_id % 8 AS r FROM events),
b1 AS (SELECT *, b % 5 AS m, b // 5 AS f, 'HDX' || lpad(CAST(b AS VARCHAR), 10, '0') AS absent FROM b0),
b2 AS (SELECT *, CASE WHEN m = 0 AND f % 14 = 2 THEN b + 5 WHEN m = 0 AND f % 14 = 3 THEN b - 5 WHEN m = 0 AND f % 13 = 0 THEN -1
                      WHEN m = 0 THEN b + 1 WHEN m = 1 AND f % 10 IN (3, 4, 5) THEN b + 5 END AS mb,
              CASE WHEN m = 3 AND f % 11 = 0 THEN -1 WHEN m = 3 THEN b + 1 WHEN m = 4 AND f % 4 = 0 THEN b + 5 END AS sb FROM b1),
b3 AS (SELECT *, CASE WHEN mb = -1 THEN absent WHEN mb >= 0 THEN 'HD' || lpad(CAST(mb AS VARCHAR), 10, '0') END AS merge_to,
              CASE WHEN sb = -1 THEN absent WHEN sb >= 0 THEN 'HD' || lpad(CAST(sb AS VARCHAR), 10, '0') END AS split_to FROM b2),
log AS (
  SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN 'HD' || lpad(CAST(b AS VARCHAR), 10, '0') END AS invoice_id,
         'N' || lpad(CAST(b AS VARCHAR), 8, '0') AS invoice_no,
         CASE WHEN event_id % 101 <> 0 THEN strftime(TIMESTAMP '2024-01-01' + to_seconds(b * 60 + CASE WHEN r = 7 AND split_to IS NOT NULL THEN 6 ELSE r END), '%Y/%m/%d %H:%M:%S') END AS ts,
         'B' || (b % 20) AS table_name, 'E' || (user_id % 7) AS employee,
         CASE WHEN (r = 7 AND merge_to IS NOT NULL) OR (r = 4 AND m = 1) THEN 'SALE_MERGE_ORDER'
              WHEN (r >= 6 AND split_to IS NOT NULL) OR (r = 0 AND m = 4) THEN 'SALE_SPLIT_ORDER' ELSE 'SALE_CHANGE' END AS log_type,
         CASE WHEN r = 7 AND merge_to IS NOT NULL THEN replace('{MERGE_NOTE}', '{{}}', merge_to) WHEN r = 4 AND m = 1 THEN '{MERGED_NOTE}'
              WHEN r = 6 AND split_to IS NOT NULL THEN replace('{SPLIT_NOTE}', '{{}}', split_to) WHEN r = 0 AND m = 4 THEN '{NEW_NOTE}'
              WHEN event_id % 3 = 0 THEN '' END AS note,
         CASE WHEN event_id % 53 = 0 THEN ' ' WHEN event_id % 4 = 0 THEN ' ' || event_type ELSE event_type END AS item,
         CASE WHEN event_id % 89 = 0 THEN NULL WHEN (r >= 6 AND split_to IS NOT NULL AND NOT (r = 7 AND merge_to IS NOT NULL)) OR (r = 0 AND m = 4) OR event_id % 7 = 0
              THEN -1 ELSE 1 END * CAST(CAST(trunc(value) AS BIGINT) + 1 AS DOUBLE) AS qty FROM b3)"""

RESTRUCTURED_SQL = f"""
WITH RECURSIVE {BILL_LOG_CTE.strip()},
flagged AS (SELECT DISTINCT invoice_id FROM log WHERE log_type IN ('SALE_SPLIT_ORDER', 'SALE_MERGE_ORDER')),
g0 AS (SELECT l.*, row_number() OVER (ORDER BY l.invoice_id NULLS LAST, l.ts NULLS LAST, l.event_id) AS o
       FROM log l WHERE EXISTS (SELECT 1 FROM flagged x WHERE x.invoice_id IS NOT DISTINCT FROM l.invoice_id)),
-- T2: merge notes, filled by number, followed to the end
g1 AS (SELECT *, CASE WHEN note LIKE '%gộp vào%' THEN nullif(trim(split_part(split_part(note, 'gộp vào', 2), '-', 1)), '') END AS raw_to FROM g0),
g2 AS (SELECT *, coalesce(last_value(raw_to IGNORE NULLS) OVER (PARTITION BY invoice_no ORDER BY o ROWS UNBOUNDED PRECEDING),
                          first_value(raw_to IGNORE NULLS) OVER (PARTITION BY invoice_no ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS merge_to FROM g1),
g3 AS (SELECT * FROM g2 WHERE note IS NULL OR note NOT LIKE '%[Gộp đơn]%'),
merged AS (SELECT invoice_id AS src, arg_max_null(merge_to, o) AS dst FROM g3 WHERE invoice_id IS NOT NULL GROUP BY invoice_id),
first_no AS (SELECT invoice_id AS id, arg_min_null(invoice_no, o) AS no FROM g3 WHERE invoice_id IS NOT NULL GROUP BY invoice_id),
walk AS (
  SELECT DISTINCT invoice_id AS start, invoice_id AS cur, CAST([] AS VARCHAR[]) AS seen FROM g3 WHERE invoice_id IS NOT NULL
  UNION ALL
  SELECT w.start, e.dst, list_append(w.seen, w.cur) FROM walk w JOIN merged e ON e.src = w.cur
  WHERE e.dst IS NOT NULL AND e.dst <> w.cur AND NOT list_contains(w.seen, e.dst)),
final AS (SELECT start, arg_max(cur, len(seen)) AS id FROM walk GROUP BY start),
g4 AS (SELECT g3.* EXCLUDE (invoice_id, invoice_no, raw_to, merge_to), coalesce(final.id, g3.invoice_id) AS invoice_id, n.no AS invoice_no
       FROM g3 LEFT JOIN final ON final.start = g3.invoice_id LEFT JOIN first_no n ON n.id = final.id),
-- T3: split notes, filled by bill on split rows, parents followed to the root
s1 AS (SELECT *, CASE WHEN note ILIKE '%bỏ món%' AND note ILIKE '%tạo thành hóa đơn%' THEN nullif(regexp_extract(note, '([A-Z0-9]{{10,}})\s*-', 1), '') END AS raw_to FROM g4),
s2 AS (SELECT *, CASE WHEN log_type = 'SALE_SPLIT_ORDER' AND invoice_id IS NOT NULL THEN
         coalesce(last_value(raw_to IGNORE NULLS) OVER (PARTITION BY invoice_id ORDER BY o ROWS UNBOUNDED PRECEDING),
                  first_value(raw_to IGNORE NULLS) OVER (PARTITION BY invoice_id ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) END AS split_to FROM s1),
pairs AS (SELECT invoice_id, split_to, min(o) AS o FROM s2 WHERE split_to IS NOT NULL GROUP BY ALL),
parent AS (SELECT split_to AS src, arg_max(invoice_id, o) AS dst FROM pairs GROUP BY split_to),
last_no AS (SELECT invoice_id AS id, arg_max_null(invoice_no, o) AS no FROM s2 WHERE invoice_id IS NOT NULL GROUP BY invoice_id),
climb AS (
  SELECT DISTINCT invoice_id AS start, invoice_id AS cur, CAST([] AS VARCHAR[]) AS seen FROM s2 WHERE invoice_id IS NOT NULL
  UNION ALL
  SELECT c.start, e.dst, list_append(c.seen, c.cur) FROM climb c JOIN parent e ON e.src = c.cur
  WHERE e.dst IS NOT NULL AND e.dst <> c.cur AND NOT list_contains(c.seen, c.cur)),
root AS (SELECT start, arg_max(cur, len(seen)) AS family FROM climb GROUP BY start),
s3 AS (SELECT s2.* EXCLUDE (item, qty), root.family, nullif(trim(coalesce(item, 'nan')), '') AS item, coalesce(qty, 0) AS qty, n.no AS split_no,
              row_number() OVER (ORDER BY ts NULLS LAST, right(coalesce(n.no, ''), 4), o) AS pos
       FROM s2 LEFT JOIN root ON root.start = s2.invoice_id LEFT JOIN last_no n ON n.id = s2.split_to
       WHERE (note IS NULL OR note NOT ILIKE '%hóa đơn được tạo mới%') AND (split_to IS NULL OR n.no IS NOT NULL)),
inp AS (SELECT pos AS event_id, ts, family, item, qty, CASE WHEN log_type = 'SALE_SPLIT_ORDER' THEN split_to END AS target, split_no FROM s3
        WHERE log_type IN ('SALE_CHANGE', 'SALE_SPLIT_ORDER') AND (log_type = 'SALE_CHANGE' OR split_to IS NOT NULL)),
{{SPLIT_CTE}},
portion AS (SELECT * FROM (SELECT * FROM moved UNION ALL SELECT * FROM kept) WHERE qty > 0)
SELECT 'rest' AS source, event_id, invoice_id, invoice_no, ts, table_name, employee, log_type, item, coalesce(qty, 0) AS qty
FROM g4 WHERE log_type <> 'SALE_SPLIT_ORDER'
UNION ALL
SELECT 'stock', s.event_id, coalesce(p.target, s.invoice_id), CASE WHEN p.target IS NULL THEN s.invoice_no ELSE n.no END, s.ts, s.table_name, s.employee, s.log_type, s.item, p.qty
FROM portion p JOIN s3 s ON s.pos = p.event_id LEFT JOIN last_no n ON n.id = p.target
""".replace("{SPLIT_CTE}", SPLIT_CTE)


@register("restructured_bills", RESTRUCTURED_SQL)
def q_restructured_bills(spark, sf_dir):
    from tillwork.plans.pipeline import JobConfig, restructured

    out = restructured(bill_log(spark, sf_dir), JobConfig())
    source = F.when(F.col("ord.src") == 0, "rest").otherwise("stock")
    return out.select(source.alias("source"), "event_id", "invoice_id", "invoice_no", "ts", "table_name", "employee", "log_type", "item", "qty")


# Landed pages → entries → flattened change log ------------------------------------------
# Pages are built by Spark from events: one page per (store = user_id % 5,
# page = event_id div 100), so a page holds at most 100 entries; the payload
# shape rotates over list / {"data": list} / {"data": {"items": list}}.
def landed_log_pages(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k")
    item1 = F.concat(F.lit("{'item_name': '"), F.col("event_type"), F.lit("', 'quantity': "), k)
    cd = (F.when(eid % 9 == 0, F.lit("bad{"))
          .when(eid % 4 == 0, F.concat(F.lit("{'table_name': 'H"), uid.cast("string"), F.lit("'}")))
          .when(eid % 3 == 0, F.concat(F.lit("{'table_name': 'H"), uid.cast("string"), F.lit("', 'sale_detail': ["),
                                       item1, F.lit("}, {'item_name': '"), F.col("event_type"),
                                       F.lit("-2', 'quantity': 1, 'table_name': null}]}")))
          .otherwise(F.concat(F.lit("{'sale_detail': ["), item1, F.lit(", 'price': 1000}]}"))))
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    entry = F.struct(
        F.concat(F.lit("T"), uid.cast("string")).alias("tran_id"),
        F.concat(F.lit("N"), eid.cast("string")).alias("tran_no"),
        ms.alias("tran_date"),
        F.concat(F.lit("B"), (uid % 10).cast("string")).alias("table_name"),
        F.concat(F.lit("E"), (uid % 7).cast("string")).alias("employee_name"),
        F.lit("SALE_CHANGE").alias("log_type"), F.lit("{}").alias("extra_data"), cd.alias("change_data"))
    staged = ev.select((uid % 5).alias("store"), F.floor(eid / 100).alias("page"), F.struct(eid.alias("o"), entry.alias("e")).alias("x"))
    pages = staged.groupBy("store", "page").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    arr = F.transform("xs", lambda x: x["e"])
    shape = F.col("page") % 3
    body = (F.when(shape == 0, F.to_json(arr))
            .when(shape == 1, F.to_json(F.struct(arr.alias("data"))))
            .otherwise(F.to_json(F.struct(F.struct(arr.alias("items")).alias("data")))))
    path = F.concat(F.lit("landed/report_date=2024-01-01/store=S"), F.col("store").cast("string"),
                    F.lit("/page="), F.col("page").cast("string"), F.lit(".json"))
    return pages.select(body.alias("body"), path.alias("path"))


@register("flatten_change_log", """
WITH b AS (
  SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         'S' || CAST(user_id % 5 AS VARCHAR) AS store_uid, CAST(event_id // 100 AS INTEGER) AS page_no,
         CAST(row_number() OVER (PARTITION BY user_id % 5, event_id // 100 ORDER BY event_id) - 1 AS INTEGER) AS entry_pos,
         'B' || CAST(user_id % 10 AS VARCHAR) AS tb, 'H' || CAST(user_id AS VARCHAR) AS th
  FROM events),
one AS (
  SELECT event_id, store_uid, page_no, entry_pos, CAST(NULL AS INTEGER) AS item_pos,
         CASE WHEN event_id % 9 = 0 THEN tb ELSE th END AS table_name,
         CAST(NULL AS VARCHAR) AS item_name, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS DOUBLE) AS price
  FROM b WHERE event_id % 9 = 0 OR event_id % 4 = 0),
two AS (
  SELECT event_id, store_uid, page_no, entry_pos, 0 AS item_pos, th AS table_name, event_type AS item_name,
         k AS quantity, CAST(NULL AS DOUBLE) AS price
  FROM b WHERE event_id % 9 <> 0 AND event_id % 4 <> 0 AND event_id % 3 = 0
  UNION ALL
  SELECT event_id, store_uid, page_no, entry_pos, 1, NULL, event_type || '-2', 1.0, NULL
  FROM b WHERE event_id % 9 <> 0 AND event_id % 4 <> 0 AND event_id % 3 = 0),
single AS (
  SELECT event_id, store_uid, page_no, entry_pos, 0 AS item_pos, tb AS table_name, event_type AS item_name,
         k AS quantity, 1000.0 AS price
  FROM b WHERE event_id % 9 <> 0 AND event_id % 4 <> 0 AND event_id % 3 <> 0)
SELECT 'N' || CAST(event_id AS VARCHAR) AS tran_no, store_uid, page_no, entry_pos, item_pos, table_name,
       item_name, quantity, price
FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM single)
""")
def q_flatten_change_log(spark, sf_dir):
    from tillwork.sources.pages import CHANGE_LOG_ENTRY, flatten_change_log, pages_to_entries

    entries = pages_to_entries(landed_log_pages(spark, sf_dir), "body", "path", CHANGE_LOG_ENTRY)
    flat = flatten_change_log(entries)
    return flat.select("tran_no", "store_uid", "page_no", "entry_pos", "item_pos", "table_name", "item_name",
                       "quantity", "price")


# Row-level plumbing ---------------------------------------------------------
@register("union_by_name", """
SELECT event_id AS id, user_id AS party, value AS amount, CAST(NULL AS VARCHAR) AS status FROM events
UNION ALL
SELECT o_orderkey AS id, o_custkey AS party, NULL AS amount, o_orderstatus AS status FROM orders
""")
def q_union_by_name(spark, sf_dir):
    from tillwork.operators.rows import union_by_name

    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("party"),
                                               F.col("value").alias("amount"))
    od = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("id"),
                                               F.col("o_custkey").alias("party"))
    return union_by_name(ev, od)


@register("partition_rows", f"""
WITH {LOG_CTE.strip()}
SELECT event_id, 'positive' AS part, qty FROM log WHERE qty > 0
UNION ALL
SELECT event_id, 'other' AS part, qty FROM log WHERE NOT coalesce(qty > 0, false)
""")
def q_partition_rows(spark, sf_dir):
    from tillwork.operators.rows import partition_rows, union_by_name

    lg = order_log(spark, sf_dir).select("event_id", "qty")
    pos, other = partition_rows(lg, F.col("qty") > 0)
    return union_by_name(pos.withColumn("part", F.lit("positive")), other.withColumn("part", F.lit("other")))


@register("first_rows", f"""
WITH {LOG_CTE.strip()}
SELECT event_id, sparse FROM log ORDER BY sparse ASC NULLS LAST, ts, event_id LIMIT 100
""")
def q_first_rows(spark, sf_dir):
    from tillwork.operators.rows import first_rows

    lg = order_log(spark, sf_dir).select("event_id", "sparse", "ts")
    keyed = lg.withColumn("ord", F.struct(F.col("sparse").isNull().alias("n"), "sparse", "ts", "event_id"))
    return first_rows(keyed, 100).select("event_id", "sparse")


@register("fixed_layout", """
SELECT event_id AS id, user_id AS party, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS DOUBLE) AS discount, value
FROM events
""")
def q_fixed_layout(spark, sf_dir):
    from tillwork.operators.rows import fixed_layout, rename, select_existing

    ev = table(spark, sf_dir, "events")
    picked = select_existing(ev, ["event_id", "no_such_column", "user_id", "value"])
    laid = fixed_layout(picked, {"event_id": "bigint", "user_id": "bigint", "note": "string", "discount": "double",
                                 "value": "double"})
    return rename(laid, {"event_id": "id", "user_id": "party", "absent": "never"})


# Report windows ----------------------------------------------------------------------------
@register("report_window", """
WITH b AS (SELECT epoch_us(ts) // 1000 AS ms, CAST(ts + INTERVAL 7 HOUR AS DATE) AS d FROM events)
SELECT strftime(d, '%d-%m-%Y') AS report_date,
       epoch_ms(CAST(d AS TIMESTAMP) - INTERVAL 7 HOUR) AS from_ms,
       epoch_ms(CAST(d AS TIMESTAMP) - INTERVAL 7 HOUR) + 86399000 AS to_ms,
       count(*) AS n_events,
       count(*) FILTER (WHERE ms BETWEEN epoch_ms(CAST(d AS TIMESTAMP) - INTERVAL 7 HOUR)
                                     AND epoch_ms(CAST(d AS TIMESTAMP) - INTERVAL 7 HOUR) + 86399000) AS n_in_window
FROM b GROUP BY d
""")
def q_report_window(spark, sf_dir):
    from tillwork.sources.invoices import window_columns

    ev = table(spark, sf_dir, "events")
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    w = window_columns(ms)
    staged = ev.select(ms.alias("ms"), *[c.alias(n) for n, c in w.items()])
    inside = (F.col("ms") >= F.col("from_ms")) & (F.col("ms") <= F.col("to_ms"))
    return staged.groupBy("report_date", "from_ms", "to_ms").agg(F.count(F.lit(1)).alias("n_events"),
                                                                 F.count_if(inside).alias("n_in_window"))


# Block sums, distinct keys --------------------------------------------------------------
@register("block_sum", f"""
WITH {LOG_CTE.strip()}
SELECT bill, CAST(ts AS DATE) AS day, item, CAST(abs(sum(qty)) AS BIGINT) AS qty FROM log GROUP BY bill, CAST(ts AS DATE), item
""")
def q_block_sum(spark, sf_dir):
    lg = order_log(spark, sf_dir).select("bill", "day", "item", "qty")
    return A.block_sum(lg, ["bill", "day", "item"], "qty")


@register("distinct_keys", """
SELECT DISTINCT user_id, event_type FROM events
""")
def q_distinct_keys(spark, sf_dir):
    return A.distinct_keys(table(spark, sf_dir, "events"), ["user_id", "event_type"])


# Scalar and row helpers on the order log ------------------------------
@register("row_helpers", f"""
WITH {LOG_CTE.strip()},
n AS (SELECT *, {NOTE_SQL.strip()} AS note,
             CASE WHEN event_id % 3 = 0 THEN '  ' || event_type || ' ' WHEN event_id % 3 = 1 THEN '' ELSE NULL END AS raw_item,
             CASE WHEN event_id % 4 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS qty_text,
             CASE WHEN event_id % 6 = 0 THEN 'HD' || CAST(event_id AS VARCHAR) END AS split_to,
             CASE WHEN event_id % 12 = 0 THEN NULL WHEN event_id % 6 = 0 THEN 'N' || CAST(event_id AS VARCHAR) END AS split_no
      FROM log)
SELECT event_id,
       trim(raw_item) AS item,
       nullif(raw_item, '') AS item_or_null,
       coalesce(CAST(raw_item AS VARCHAR), 'nan') AS item_text,
       right(coalesce(split_no, ''), 4) AS sort_tail,
       coalesce(TRY_CAST(qty_text AS DOUBLE), 0.0) AS qty_num,
       CAST(trunc(coalesce(TRY_CAST(qty_text AS DOUBLE), 0.0)) AS BIGINT) AS qty_int,
       coalesce(qty < 0, false) AS is_negative,
       CASE WHEN log_type = 'SALE_CHANGE' THEN 'edit' ELSE log_type END AS kind
FROM n
WHERE NOT coalesce(lower(note) LIKE '%hóa đơn được tạo mới%', false)
  AND NOT (split_to IS NOT NULL AND split_no IS NULL)
""")
def q_row_helpers(spark, sf_dir):
    from tillwork.operators.rows import assign_where, drop_columns, drop_notes, drop_orphan_splits

    lg = order_log(spark, sf_dir).withColumn("note", note_column())
    eid = F.col("event_id")
    lg = lg.select(
        "event_id", "qty", "log_type", "note", "value", "props",
        F.when(eid % 3 == 0, F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))).when(eid % 3 == 1, F.lit(""))
         .otherwise(F.lit(None).cast("string")).alias("raw_item"),
        F.when(eid % 4 == 0, F.lit("x")).otherwise(F.col("value").cast("string")).alias("qty_text"),
        F.when(eid % 6 == 0, F.concat(F.lit("HD"), eid.cast("string"))).alias("split_to"),
        F.when(eid % 12 == 0, F.lit(None).cast("string")).when(eid % 6 == 0, F.concat(F.lit("N"), eid.cast("string")))
         .alias("split_no"))
    lg = drop_notes(lg, "note", "hóa đơn được tạo mới")
    lg = drop_orphan_splits(lg, "split_to", "split_no")
    lg = assign_where(lg.withColumn("kind", F.col("log_type")), F.col("log_type") == "SALE_CHANGE", "kind", "edit")
    lg = drop_columns(lg, ["value", "props", "no_such_column"])
    return lg.select("event_id", S.strip("raw_item").alias("item"), S.blank_to_null("raw_item").alias("item_or_null"),
                     S.as_text("raw_item", "nan").alias("item_text"), S.last_chars("split_no", 4).alias("sort_tail"),
                     S.to_number("qty_text").alias("qty_num"), S.to_number("qty_text", truncate=True).alias("qty_int"),
                     P.is_negative("qty").alias("is_negative"), "kind")


# The composed daily job over pages that Spark builds from the driver tables ----------------
# Invoice headers: orders ⋈ customer, pages of ≤100 orders per (store, page);
# details: lineitem ⋈ part per order (its first line carries a topping);
# change log: lineitem ⋈ part ⋈ supplier, pages of ≤20 orders; every 6th
# line number also cancels one unit, every 7th is a print row.  Merged and split
# bills (X3) are tested end to end on hand fixtures (tests/test_pipeline*.py).
def _ms(ts_col):
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts_col)


def _pages(df, store, page, order, entry, shape: str):
    # ``order`` flat in the sorted struct (a struct inside one is compared many times slower); dealt
    # by number, as the pages are parsed in these tasks and few large ones leave cores idle
    staged = df.select(store.alias("store"), page.alias("page"), F.struct(*order, entry.alias("e")).alias("x"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = staged.repartition(n, "store", "page").groupBy("store", "page").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    arr = F.transform("xs", lambda x: x["e"])
    body = F.to_json(F.struct(arr.alias("data"))) if shape == "data" else F.to_json(arr)
    return grouped.select(F.concat(F.lit("S"), F.col("store").cast("string")).alias("store_uid"),
                          F.lit("2024-01-01").alias("report_date"), F.col("page").cast("int").alias("page_no"),
                          body.alias("body"))


def daily_job_inputs(spark, sf_dir):
    from tillwork.plans.standins import customer_fields
    from tillwork.sources.invoices import attach_details, details_from_bodies, invoices_from_pages, stores
    from tillwork.sources.pages import CHANGE_LOG_ENTRY, entries_from_pages, flatten_change_log

    dim = stores(spark, {f"S{i}": f"Cửa hàng {i}" for i in range(5)})  # fixed 5-store dimension
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cust = customer_fields(table(spark, sf_dir, "customer"))
    ok = F.col("o_orderkey")
    extra = F.concat(F.lit("{'peo_count': "), ((ok % 4) + 1).cast("string"),
                     F.lit(", 'Membership_Type_Name': '"), F.coalesce(F.col("membership"), F.lit("")),
                     F.lit("', 'customer_name': '"), F.coalesce(F.col("customer"), F.lit("")),
                     F.lit("', 'customer_phone': '"), F.coalesce(F.col("phone"), F.lit("")), F.lit("'}"))
    header = F.struct(
        F.concat(F.lit("T"), ok.cast("string")).alias("id"), F.concat(F.lit("T"), ok.cast("string")).alias("tran_id"),
        F.concat(F.lit("N"), ok.cast("string")).alias("tran_no"), _ms(F.col("o_orderdate")).alias("tran_date"),
        (ok % 24).cast("string").alias("start_hour"), (F.col("o_custkey") % 60).cast("string").alias("start_minute"),
        ((ok + 1) % 24).cast("string").alias("end_hour"), F.lit("0").alias("end_minute"),
        F.concat(F.lit("B"), (ok % 20).cast("string")).alias("table_name"), F.col("o_totalprice").alias("total_amount"),
        F.lit(0.0).alias("amount_discount_detail"), extra.alias("extra_data"))
    hdr = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    header_pages = _pages(hdr, ok % 5, F.floor(ok / 100), [ok.alias("o")], header, "data")
    headers = invoices_from_pages(header_pages, dim)

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                  "l_shipdate", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    lp = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    topping = F.when(F.col("l_linenumber") == 1,
                     F.lit("[{'item_name': 'Topping Hạt đác', 'price': 5000, 'quantity': 1}]")).otherwise(F.lit("[]"))
    line = F.struct(F.col("p_name").alias("item_name"), F.floor("l_quantity").cast("double").alias("quantity"),
                    F.col("p_retailprice").alias("price_org"), F.col("p_retailprice").alias("price"),
                    F.col("l_extendedprice").alias("amount"), topping.alias("toppings"))
    order_key = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")]
    det = (lp.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*order_key, line.alias("e")))).alias("xs"))
           .select(F.concat(F.lit("S"), (F.col("l_orderkey") % 5).cast("string")).alias("store_uid"),
                   F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("tran_id"),
                   F.to_json(F.struct(F.struct(F.transform("xs", lambda x: x["e"]).alias("sale_detail")).alias("data"))).alias("body")))
    lines = attach_details(headers, details_from_bodies(det))

    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lps = lp.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    ln, lk = F.col("l_linenumber"), F.col("l_orderkey")
    qty = F.floor("l_quantity").cast("bigint").cast("string")
    item = F.concat(F.lit("{'item_name': '"), F.col("p_name"), F.lit("', 'quantity': "), qty,
                    F.when(ln == 1, F.lit(", 'toppings': [{'item_name': 'Topping Hạt đác', 'quantity': 1}]")).otherwise(F.lit("")),
                    F.lit("}"))
    cancel = F.concat(F.lit(", {'item_name': '"), F.col("p_name"), F.lit("', 'quantity': -1}"))
    cd = F.concat(F.lit("{'sale_detail': ["), item, F.when(ln % 6 == 0, cancel).otherwise(F.lit("")), F.lit("]}"))
    entry = F.struct(
        F.concat(F.lit("T"), lk.cast("string")).alias("tran_id"), F.concat(F.lit("N"), lk.cast("string")).alias("tran_no"),
        (_ms(F.col("l_shipdate")) + ln * F.lit(60_000)).alias("tran_date"),
        F.concat(F.lit("B"), (lk % 20).cast("string")).alias("table_name"), F.col("s_name").alias("employee_name"),
        F.when(ln == 7, F.lit("PRINT")).otherwise(F.lit("SALE_CHANGE")).alias("log_type"),
        F.lit("{}").alias("extra_data"), cd.alias("change_data"))
    log_pages = _pages(lps, lk % 5, F.floor(lk / 20), order_key, entry, "list")
    flat = flatten_change_log(entries_from_pages(log_pages, CHANGE_LOG_ENTRY, dim))
    return flat, lines


# The change log under its display labels, written by date and read back ------------------
@register("labelled_output", f"""
WITH {BILL_LOG_CTE.strip()}
SELECT invoice_id AS "Mã hoá đơn", invoice_no AS "Số hoá đơn", ts AS "Thời gian", employee AS "Nhân viên", log_type AS "Loại log",
       note AS "Ghi chú", item AS "Món", qty AS "Số lượng order", coalesce(replace(substr(ts, 1, 10), '/', '-'), 'none') AS report_date
FROM log
""")
def q_labelled_output(spark, sf_dir):
    from tillwork.plans.pipeline import to_labels
    from tillwork.session import fresh_folder
    from tillwork.sources.sinks import read_dated, write_dated

    day = F.coalesce(F.regexp_replace(F.substring("ts", 1, 10), "/", "-"), F.lit("none"))
    log = bill_log(spark, sf_dir).select("invoice_id", "invoice_no", "ts", "employee", "log_type", "note", "item", "qty", day.alias("report_date"))
    path = fresh_folder(spark, "labelled")
    write_dated(to_labels(log), path)
    saved = read_dated(spark, path)
    return saved.withColumn("report_date", F.col("report_date").cast("string"))


# Headers of landed pages, their store, their details ---------------------------------
@register("attach_details", """
WITH l AS (
  SELECT l.*, row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS pos,
         p_name, p_retailprice FROM lineitem l JOIN part ON l_partkey = p_partkey)
SELECT 'N' || CAST(o_orderkey AS VARCHAR) AS tran_no, 'Cửa hàng ' || CAST(o_orderkey % 5 AS VARCHAR) AS store_name,
       CAST(o_orderkey % 5 AS INTEGER) AS store_ord, epoch_ms(o_orderdate) AS tran_date, o_totalprice AS total_amount,
       CAST(pos AS INTEGER) AS line_pos, p_name AS item_name, CAST(floor(l_quantity) AS DOUBLE) AS quantity,
       p_retailprice AS price_org, l_extendedprice AS amount, (l_linenumber = 1) AS has_topping
FROM orders JOIN customer ON o_custkey = c_custkey JOIN l ON l_orderkey = o_orderkey
""")
def q_attach_details(spark, sf_dir):
    _, lines = daily_job_inputs(spark, sf_dir)
    return lines.select("tran_no", "store_name", "store_ord", "tran_date", "total_amount", "line_pos", "item_name",
                        "quantity", "price_org", "amount", (F.col("toppings") != "[]").alias("has_topping"))


# A dated sink, written for all days, then again for the last one ------------------------------
@register("dated_sink", """
WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS report_date, event_id, user_id, value FROM events)
SELECT report_date, event_id, user_id,
       CASE WHEN report_date = (SELECT max(report_date) FROM d) THEN -value ELSE value END AS value
FROM d
""")
def q_dated_sink(spark, sf_dir):
    from tillwork.session import fresh_folder
    from tillwork.sources.sinks import read_dated, write_dated

    path = fresh_folder(spark, "dated")
    log = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("report_date"), "event_id",
                                                "user_id", "value")
    write_dated(log, path)
    last = log.agg(F.max("report_date").alias("d"))
    rerun = log.join(F.broadcast(last), F.col("report_date") == F.col("d")).drop("d")  # one row
    write_dated(rerun.withColumn("value", -F.col("value")), path)
    return read_dated(spark, path).select(F.col("report_date").cast("string").alias("report_date"), "event_id", "user_id",
                                          "value")


# Invoice lines and their add-ons, classified, filled and numbered -----------------------------
JOB_ITEMS_CTE = """
c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 17 = 0 THEN 'iPOS-O2O' WHEN c_custkey % 19 = 0 THEN ' ' ELSE c_name END AS customer,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ''
              ELSE '09' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS phone,
         CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'Thành viên mặc định'
              ELSE c_mktsegment END AS membership
  FROM customer),
k AS (SELECT *, CASE WHEN customer = 'iPOS-O2O' OR trim(customer) = '' OR coalesce(trim(phone), '') = '' THEN 'Khách lẻ'
                     WHEN coalesce(membership, '') IN ('', 'Thành viên mặc định') THEN 'Khách mới'
                     ELSE 'Khách quay lại' END AS customer_type FROM c),
l AS (
  SELECT o_orderkey, o_totalprice, o_orderdate, o_custkey, k.customer, k.phone, k.customer_type, l_linenumber, p_name,
         l_quantity, p_retailprice, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS pos
  FROM orders JOIN k ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
items AS (
  SELECT *, 0 AS child, p_name AS item, CAST(floor(l_quantity) AS DOUBLE) AS qty FROM l
  UNION ALL
  SELECT *, 1, '+ Topping Hạt đác', 1.0 FROM l WHERE l_linenumber = 1)"""


@register("invoice_items", f"""
WITH {JOB_ITEMS_CTE.strip()}
SELECT 'Cửa hàng ' || CAST(o_orderkey % 5 AS VARCHAR) AS store, 'T' || CAST(o_orderkey AS VARCHAR) AS invoice_id,
       'N' || CAST(o_orderkey AS VARCHAR) AS invoice_no, strftime(o_orderdate + INTERVAL 7 HOUR, '%Y/%m/%d') AS date,
       printf('%02d:%02d:00', o_orderkey % 24, o_custkey % 60) AS time_in,
       printf('%02d:00:00', (o_orderkey + 1) % 24) AS time_out, 'B' || CAST(o_orderkey % 20 AS VARCHAR) AS table_name,
       item, qty, p_retailprice AS unit_price, CAST((o_orderkey % 4) + 1 AS INTEGER) AS guests,
       o_totalprice AS bill_total, coalesce(customer, '') AS customer, coalesce(phone, '') AS phone, customer_type,
       CAST(row_number() OVER (PARTITION BY o_orderkey, item, qty ORDER BY pos, child) AS INTEGER) AS occurrence
FROM items
""")
def q_invoice_items(spark, sf_dir):
    from tillwork.plans.pipeline import JobConfig, invoice_items

    _, lines = daily_job_inputs(spark, sf_dir)
    return invoice_items(lines, JobConfig()).select(
        "store", "invoice_id", "invoice_no", "date", "time_in", "time_out", "table_name", "item", "qty", "unit_price",
        "guests", "bill_total", "customer", "phone", "customer_type", "occurrence")


# The change log, flattened, signed, filled and filtered ---------------------------------------
JOB_LOG_CTE = """
lp AS (
  SELECT *, l_orderkey // 20 AS page, l_shipdate + INTERVAL 7 HOUR + l_linenumber * INTERVAL 1 MINUTE AS moment
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey % 5, page
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS entry FROM lp),
logged AS (
  SELECT *, 0 AS place, p_name AS item, CAST(floor(l_quantity) AS DOUBLE) AS qty FROM placed
  UNION ALL SELECT *, 1, '+ Topping Hạt đác', 1.0 FROM placed WHERE l_linenumber = 1
  UNION ALL SELECT *, 2, p_name, -1.0 FROM placed WHERE l_linenumber % 6 = 0)"""


@register("order_log_items", f"""
WITH {JOB_LOG_CTE.strip()}
SELECT 'T' || CAST(l_orderkey AS VARCHAR) AS invoice_id, 'N' || CAST(l_orderkey AS VARCHAR) AS invoice_no,
       strftime(moment, '%Y/%m/%d %H:%M:%S') AS ts, 'B' || CAST(l_orderkey % 20 AS VARCHAR) AS table_name,
       s_name AS employee, CASE WHEN l_linenumber = 7 THEN 'PRINT' ELSE 'SALE_CHANGE' END AS log_type, item, qty
FROM logged WHERE l_linenumber <> 7
""")
def q_order_log_items(spark, sf_dir):
    from tillwork.plans.pipeline import JobConfig, order_log_items

    flat, _ = daily_job_inputs(spark, sf_dir)
    return order_log_items(flat, JobConfig()).select("invoice_id", "invoice_no", "ts", "table_name", "employee",
                                                     "log_type", "item", "qty")


# no bill of this log is merged or split, and the deduction compares numbers with ids, so it
# drops the cancelled rows and deducts nothing (the original's behaviour)
@register("daily_pipeline", f"""
WITH {JOB_ITEMS_CTE.strip()},
{JOB_LOG_CTE.strip()},
inv AS (SELECT o_orderkey AS bill, item, CAST(qty AS BIGINT) AS qty, p_retailprice AS unit_price, customer_type,
               coalesce(phone, '') AS phone, row_number() OVER (PARTITION BY o_orderkey, item, qty ORDER BY pos, child) AS occ
        FROM items),
ord AS (SELECT l_orderkey AS bill, item, CAST(qty AS BIGINT) AS qty, s_name AS employee, moment, entry, place,
               row_number() OVER (PARTITION BY l_orderkey, item, qty ORDER BY moment, entry, place) AS occ
        FROM logged WHERE l_linenumber <> 7 AND qty > 0),
strict AS (SELECT inv.*, ord.employee, ord.moment FROM inv JOIN ord USING (bill, item, qty, occ)),
first_left AS (SELECT *, row_number() OVER (PARTITION BY bill, item ORDER BY moment, entry, place) AS n
               FROM ord ANTI JOIN inv USING (bill, item, qty, occ)),
loose AS (SELECT u.bill, u.item, f.qty, u.unit_price, u.customer_type, u.phone, u.occ, f.employee, f.moment
          FROM (SELECT * FROM inv ANTI JOIN ord USING (bill, item, qty, occ)) u
          JOIN first_left f ON f.bill = u.bill AND f.item = u.item AND f.n = 1),
sales AS (SELECT bill, item, qty, unit_price, customer_type, phone, employee, moment FROM strict
          UNION ALL SELECT bill, item, qty, unit_price, customer_type, phone, employee, moment FROM loose)
SELECT strftime(moment, '%d/%m/%Y') AS date, strftime(moment, '%V-%G') AS week, strftime(moment, '%m-%Y') AS month,
       CAST(year(moment) AS INTEGER) AS year, 'Cửa hàng ' || CAST(bill % 5 AS VARCHAR) AS store,
       'N' || CAST(bill AS VARCHAR) AS invoice_no, CAST((bill % 4) + 1 AS INTEGER) AS guests, customer_type, employee, phone,
       round(sum(qty * CASE WHEN item = '+ Topping Hạt đác' THEN 15000.0 ELSE CAST(unit_price AS DOUBLE) END), 2) AS order_value
FROM sales GROUP BY ALL
""")
def q_daily_pipeline(spark, sf_dir):
    from tillwork.plans.pipeline import JobConfig, run_stages

    flat, lines = daily_job_inputs(spark, sf_dir)
    out = run_stages(flat, lines, JobConfig())
    return out["staff_kpi"].withColumn("order_value", F.round("order_value", 2))


# S2 E2 E3 E4 with an open schema --------------------------------------------------------------
def open_log_pages(spark, sf_dir) -> DataFrame:
    """Pages of entries whose three levels hold keys that no column knows: ``shift`` at each,
    ``area`` at two, ``unit`` and ``size`` in items; a later level may set one to null."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    eid, uid, item = F.col("event_id"), F.col("user_id").cast("string"), F.col("event_type")
    k = F.get_json_object("props", "$.k")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    change = (F.when(eid % 9 == 0, F.lit("bad{"))
              .when(eid % 4 == 0, text("{'area': 'A", uid, "'}"))
              .when(eid % 3 == 0, text("{'area': 'A", uid, "', 'shift': 'H', 'sale_detail': [{'item_name': '", item, "', 'quantity': ", k,
                                       ", 'unit': 'cup'}, {'item_name': '", item, "-2', 'shift': null, 'size': 2}]}"))
              .otherwise(text("{'sale_detail': [{'item_name': '", item, "', 'area': 'I'}]}")))
    entry = F.struct(text("T", uid).alias("tran_id"), text("N", eid.cast("string")).alias("tran_no"),
                     text("E", (F.col("user_id") % 3).cast("string")).alias("shift"), change.alias("change_data"))
    staged = ev.select(text("S", (F.col("user_id") % 5).cast("string")).alias("store_uid"), F.floor(eid / 100).cast("int").alias("page_no"),
                       F.struct(eid.alias("o"), entry.alias("e")).alias("x"))
    pages = staged.groupBy("store_uid", "page_no").agg(F.to_json(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["e"])).alias("body"))
    return pages.select("store_uid", F.lit("2024-01-01").alias("report_date"), "page_no", "body")


@register("open_change_log", """
WITH b AS (
  SELECT 'N' || CAST(event_id AS VARCHAR) AS tran_no, event_id, event_type AS item, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         'A' || CAST(user_id AS VARCHAR) AS a, 'E' || CAST(user_id % 3 AS VARCHAR) AS e,
         CASE WHEN event_id % 9 = 0 THEN 1 WHEN event_id % 4 = 0 THEN 2 WHEN event_id % 3 = 0 THEN 3 ELSE 4 END AS kind
  FROM events)
SELECT tran_no, CAST(NULL AS INTEGER) AS item_pos, CAST(NULL AS VARCHAR) AS item_name, CAST(NULL AS DOUBLE) AS quantity, e AS shift,
       CASE WHEN kind = 2 THEN a END AS area, CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS size,
       CASE WHEN kind = 1 THEN 'shift' ELSE 'area,shift' END AS names
FROM b WHERE kind <= 2
UNION ALL SELECT tran_no, 0, item, k, 'H', a, 'cup', NULL, 'area,shift,unit' FROM b WHERE kind = 3
UNION ALL SELECT tran_no, 1, item || '-2', NULL, NULL, a, NULL, '2', 'area,shift,size' FROM b WHERE kind = 3
UNION ALL SELECT tran_no, 0, item, NULL, e, 'I', NULL, NULL, 'area,shift' FROM b WHERE kind = 4
""")
def q_open_change_log(spark, sf_dir):
    from tillwork.operators.nested import with_extra_columns
    from tillwork.sources.pages import CHANGE_LOG_ENTRY, entries_from_pages, flatten_change_log

    entries = entries_from_pages(open_log_pages(spark, sf_dir), CHANGE_LOG_ENTRY, extras="extras")
    flat = flatten_change_log(entries, extras="extras")
    names = F.array_join(F.array_sort(F.map_keys("extras")), ",")
    return with_extra_columns(flat.withColumn("names", names), ["shift", "area", "unit", "size"]).select(
        "tran_no", "item_pos", "item_name", "quantity", "shift", "area", "unit", "size", "names")


@register("open_children", f"""
WITH {_KIDS_SQL.strip()}
SELECT event_id, 0 AS child_pos, event_type AS item_name, value AS quantity, CAST(NULL AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS ice,
       CAST(NULL AS VARCHAR) AS tags, '' AS names FROM b
UNION ALL
SELECT event_id, i, event_type || '#' || CAST(i AS VARCHAR), CAST(k + i AS DOUBLE), 'L', CAST(i AS VARCHAR),
       '["x",' || CAST(i AS VARCHAR) || ']', CASE WHEN i = 2 THEN 'gift,note.ice.level,note.size,tags' ELSE 'note.ice.level,note.size,tags' END FROM kid
""")
def q_open_children(spark, sf_dir):
    from tillwork.operators.nested import DISPLAY_FIELDS, explode_keep_parent, overlay_open

    ev = spread(table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props"))
    k = F.get_json_object("props", "$.k").cast("int")

    def child(i, gift):
        parts = ["{'item_name': '", F.col("event_type"), f"#{i}', 'quantity': ", (k + F.lit(i)).cast("string"), ", 'event_id': -1, 'note': {'size': 'L', 'ice': {'level': ",
                 f"{i}" + "}}, 'tags': ['x', " + f"{i}]{gift}" + "}"]
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    kids = F.slice(F.array(child(1, ""), child(2, ", 'gift': None")), F.lit(1), (F.col("event_id") % 3).cast("int"))
    # the text in its own projection: the parser refers to it in several branches
    base = ev.select("event_id", F.col("event_type").alias("item_name"), F.col("value").alias("quantity"),
                     F.concat(F.lit("["), F.array_join(kids, ", "), F.lit("]")).alias("text"))
    base = base.withColumn("children", N.parse_list("text", "map<string,variant>", style="python")).drop("text")
    out = overlay_open(explode_keep_parent(base, "children").drop("children"), overwrite=DISPLAY_FIELDS)
    e = F.col("extras")
    return out.select("event_id", "child_pos", "item_name", "quantity", e["note.size"].alias("size"), e["note.ice.level"].alias("ice"),
                      e["tags"].alias("tags"), F.array_join(F.array_sort(F.map_keys(e)), ",").alias("names"))


# F2 C9 by collation ---------------------------------------------------------------------------
_NOTE = "Hóa đơn gộp vào "
_NOTE_FORMS = [unicodedata.normalize("NFC", _NOTE), unicodedata.normalize("NFD", _NOTE), unicodedata.normalize("NFD", _NOTE.upper()), "ghi chú "]


@register("unicode_notes", f"""
WITH n AS (
  SELECT event_id, nfc_normalize(lower(CASE event_id % 4 WHEN 0 THEN '{_NOTE_FORMS[0]}' WHEN 1 THEN '{_NOTE_FORMS[1]}'
         WHEN 2 THEN '{_NOTE_FORMS[2]}' ELSE '{_NOTE_FORMS[3]}' END) || 'HD' || CAST(user_id AS VARCHAR) || ' - ' || event_type) AS note
  FROM events)
SELECT event_id, contains(note, '{unicodedata.normalize("NFC", "gộp vào")}') AS merged,
       CASE WHEN contains(note, '{unicodedata.normalize("NFC", "gộp vào")}')
            THEN trim(split_part(split_part(note, '{unicodedata.normalize("NFC", "gộp vào")}', 2), '-', 1)) END AS target
FROM n
""")
def q_unicode_notes(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    r = F.col("event_id") % 4
    form = F.when(r == 0, F.lit(_NOTE_FORMS[0])).when(r == 1, F.lit(_NOTE_FORMS[1])).when(r == 2, F.lit(_NOTE_FORMS[2])).otherwise(F.lit(_NOTE_FORMS[3]))
    note = F.concat(form, F.lit("HD"), F.col("user_id").cast("string"), F.lit(" - "), F.col("event_type"))
    merged = P.contains_text("note", "gộp vào", unicode=True)
    return ev.select("event_id", note.alias("note")).select(
        "event_id", merged.alias("merged"), F.when(merged, S.text_between("note", "gộp vào", "-", unicode=True)).alias("target"))


# A5 -------------------------------------------------------------------------------------------
@register("row_counts", """
SELECT 'log' AS name, count(*) AS "rows" FROM events
UNION ALL SELECT 'errors', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'bills', count(*) FROM orders
UNION ALL SELECT 'lines', count(*) FROM lineitem
UNION ALL SELECT 'none', 0
""")
def q_row_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return A.row_counts({"log": ev, "errors": ev.filter("event_type = 'error'"), "bills": table(spark, sf_dir, "orders"),
                         "lines": table(spark, sf_dir, "lineitem"), "none": ev.filter(F.lit(False))})


# W2 W6 W9 with one bill of a third of all rows ---------------------------------------------------
@register("hot_bill", """
WITH e AS (
  SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS bill, event_type AS item,
         CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 END * (CAST(trunc(value) AS BIGINT) + 1) AS qty,
         CASE WHEN event_id % 7 = 0 THEN event_type END AS sparse
  FROM events),
w AS (
  SELECT event_id, bill, item, qty, row_number() OVER (PARTITION BY bill, item ORDER BY ts, event_id) AS occurrence,
         coalesce(last_value(sparse IGNORE NULLS) OVER (PARTITION BY bill ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(sparse IGNORE NULLS) OVER (PARTITION BY bill ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS filled,
         sum(CASE WHEN qty < 0 THEN -qty ELSE 0 END) OVER (PARTITION BY bill, item) AS debt,
         sum(CASE WHEN qty > 0 THEN qty ELSE 0 END) OVER (PARTITION BY bill, item ORDER BY ts DESC, event_id DESC
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - qty AS newer
  FROM e)
SELECT event_id, bill, item, CAST(occurrence AS INTEGER) AS occurrence, filled,
       CAST(least(qty, qty - greatest(0, debt - newer)) AS BIGINT) AS qty
FROM w WHERE qty > 0 AND qty - greatest(0, debt - newer) > 0
""")
def q_hot_bill(spark, sf_dir):
    from tillwork.operators.scan import RANGE, ranged

    order, eid = ["ts", "event_id"], F.col("event_id")
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(eid % 3 == 0, 0).otherwise(F.col("user_id")).alias("bill"), F.col("event_type").alias("item"),
        (F.when(eid % 5 == 0, -1).otherwise(1) * (F.col("value").cast("long") + 1)).alias("qty"),
        F.when(eid % 7 == 0, F.col("event_type")).alias("filled"))
    rows = ranged(ev, "bill", order)  # cut along the order inside a bill, so of a bill's item too
    rows = keys.occurrence(rows, ["bill", "item"], order=order, bucket=RANGE)
    rows = fill.fill_group(rows, "bill", "filled", order=order, bucket=RANGE)
    rows = deduct.reverse_deduct(rows, "qty", ["bill", "item"], order=order, bucket=RANGE)
    return rows.select("event_id", "bill", "item", "occurrence", "filled", "qty")
