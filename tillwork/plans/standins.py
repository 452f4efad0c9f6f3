"""Stand-in derivations of reconciliation inputs from the driver tables.

The driver tables are TPC-H-like (``lineitem``, ``orders``, ``part``,
``customer``, ``supplier``, ``nation``) plus an ``events`` stream.  The
queries in :mod:`tillwork.plans.driver_queries` read them whole and derive
the shapes the reconciliation operators work on:

* order log (``events``): bill = ``user_id``, item = ``event_type``,
  signed whole quantity, order key = (``ts``, ``event_id``), a log type, a
  sparse column and a nullable group key;
* invoice lines (``lineitem`` ⋈ ``part`` ⋈ ``orders`` ⋈ ``customer`` ⋈
  ``supplier`` ⋈ ``nation``).

Modulus rules only *derive* values (nulls, signs, notes); no query drops
rows with them.  The same derivations are spelled out in each oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.scalars import classify_customer


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an order log (one row per event, nothing dropped)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    eid = F.col("event_id")
    whole = F.col("value").cast("bigint") + F.lit(1)
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.col("user_id").alias("bill"),
        F.when(eid % 13 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("grp"),
        F.col("event_type").alias("item"),
        F.when(eid % 5 == 0, -whole).otherwise(whole).alias("qty"),
        F.when(eid % 7 == 0, F.col("event_type")).alias("sparse"),
        F.when((F.col("event_type") == "click") & (eid % 97 == 0), F.lit("SALE_SPLIT_ORDER"))
         .when((F.col("event_type") == "signup") & (eid % 89 == 0), F.lit("SALE_MERGE_ORDER"))
         .when(F.col("event_type") == "error", F.lit("PRINT"))
         .otherwise(F.lit("SALE_CHANGE")).alias("log_type"),
        F.struct("ts", "event_id").alias("ord"),
        F.to_date("ts").alias("day"),
    )


def _customer_exprs():
    ck = F.col("c_custkey")
    name = (F.when(ck % 17 == 0, F.lit("iPOS-O2O")).when(ck % 19 == 0, F.lit(" ")).otherwise(F.col("c_name")))
    phone = (F.when(ck % 11 == 0, F.lit(None).cast("string")).when(ck % 7 == 0, F.lit(""))
             .otherwise(F.concat(F.lit("09"), F.lpad(ck.cast("string"), 8, "0"))))
    membership = (F.when(ck % 3 == 0, F.lit(None).cast("string")).when(ck % 3 == 1, F.lit("Thành viên mặc định"))
                  .otherwise(F.col("c_mktsegment")))
    return name, phone, membership


def customer_fields(cust: DataFrame) -> DataFrame:
    """Customer name / phone / membership with blanks, nulls and the kiosk account."""
    name, phone, membership = _customer_exprs()
    return cust.select("c_custkey", name.alias("customer"), phone.alias("phone"), membership.alias("membership"))


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines with store, employee and customer fields."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                  "l_quantity", "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # nation is a fixed 25-row dimension: its broadcast is bounded by construction.
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(cust, F.col("o_custkey") == cust.c_custkey)
         .join(part, F.col("l_partkey") == part.p_partkey)
         .join(supp, F.col("l_suppkey") == supp.s_suppkey)
         .join(nation, F.col("s_nationkey") == nation.n_nationkey))
    name, phone, membership = _customer_exprs()
    item = F.when(F.col("l_linenumber") > 1, F.concat(F.lit("+ "), F.col("p_name"))).otherwise(F.col("p_name"))
    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate", "c_custkey",
        F.col("n_name").alias("store"),
        F.col("o_orderkey").cast("string").alias("invoice_no"),
        ((F.col("o_orderkey") % 4) + 1).alias("guests"),
        F.col("s_name").alias("employee"),
        name.alias("customer"), phone.alias("phone"), membership.alias("membership"),
        classify_customer(name, phone, membership).alias("customer_type"),
        item.alias("item"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_shipdate").alias("ts"),
    )


# Stand-in price rules for the driver tables: the original rules name drink
# toppings that do not occur there; these follow the same shape (``+ `` prefix,
# a later rule overriding an earlier one).
STANDIN_PRICE_RULES = [("+ red", 15000.0), ("+ blue", 10000.0), ("+ red widget", 12000.0)]
