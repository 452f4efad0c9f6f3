"""The daily reconciliation job (X0–X8) composed from the operators.

Inputs are landed pages (see :mod:`tillwork.sources`); every stage is a
lazy DataFrame plan.  Row order, which the original job kept implicitly,
is an explicit order key at every stage:

* ingestion order ``ord`` = (store, page, entry, item, topping);
* after a sort the new order key is a struct of the sort columns (nulls
  last, as pandas) followed by the previous key, so ties keep the prior
  order exactly like a stable sort.

``semantics="reference"`` reproduces the original's observable behaviour
(quirk register in the README); ``"intended"`` applies the evident intent.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions import nested as N
from tillwork.functions import predicates as P
from tillwork.functions import scalars as S
from tillwork.operators import aggregates as A
from tillwork.operators import deduct, fill, joins, keys, links, nested, rows, splits
from tillwork.operators.scan import RANGE, large_cells, large_cells_of, ranged, ranged_if_large
from tillwork.session import written

TOPPING_JSON = "struct<item_name:string,price:double,quantity:double,amount:double,item_id:string,sku:string>"

# Display labels of the outputs (fixed values: the original's column names).
LABELS = {
    "store": "Cửa hàng", "invoice_id": "Mã hoá đơn", "invoice_no": "Số hoá đơn", "date": "Ngày",
    "time_in": "Giờ vào", "time_out": "Giờ ra", "table_name": "Bàn", "item": "Món", "qty": "Số lượng order",
    "unit_price": "Đơn giá", "guests": "Số khách", "bill_total": "Tổng hóa đơn", "discount": "Giảm giá",
    "membership": "Loại thành viên", "customer": "Tên", "phone": "SĐT", "customer_type": "Loại khách hàng",
    "occurrence": "Mark", "ts": "Thời gian", "employee": "Nhân viên", "log_type": "Loại log", "note": "Ghi chú",
    "week": "Tuần", "month": "Tháng", "year": "Năm", "order_value": "Giá trị order",
}

INVOICE_LABELS = {**LABELS, "item": "Tên hàng", "qty": "Số lượng"}

# The original's column orders and types.
INVOICE_ITEM_LAYOUT = {
    "store": "string", "invoice_id": "string", "invoice_no": "string", "date": "string", "time_in": "string",
    "time_out": "string", "table_name": "string", "item": "string", "qty": "double", "unit_price": "double",
    "guests": "int", "bill_total": "double", "discount": "double", "membership": "string", "customer": "string",
    "phone": "string", "customer_type": "string",
}

SALES_LAYOUT = {
    "date": "string", "week": "string", "month": "string", "year": "int", "store": "string", "invoice_id": "string",
    "invoice_no": "string", "customer_type": "string", "item": "string", "unit_price": "double", "employee": "string",
    "table_name": "string", "log_type": "string", "qty": "bigint", "guests": "int", "ts": "timestamp_ntz",
    "phone": "string",
}

KPI_KEYS = ["date", "week", "month", "year", "store", "invoice_no", "guests", "customer_type", "employee", "phone"]


@dataclass
class JobConfig:
    semantics: str = "reference"
    pages_per_bucket: int = 64
    price_rules: list = field(default_factory=lambda: list(S.TOPPING_PRICES))
    # Cut lineage after each stage: tables in the session's
    # spark.checkpoint.dir (shared storage on a cluster).
    checkpoint_stages: bool = True


def stage(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """Materialise a stage boundary as a Parquet table in the shared
    ``spark.checkpoint.dir``: the plan is cut (bounded analysis), lost
    executors recompute only from the last stage, and a later branch reads
    only its columns.  (A reliable checkpoint of these wide rows takes
    several times the disk: it is neither compressed nor columnar.)"""
    if not cfg.checkpoint_stages:
        return df
    return written(df)


def nulls_last_key(*cols) -> list[Column]:
    """Sort columns as a stable pandas sort sees them: nulls last."""
    out = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        out += [c.isNull(), c]
    return out


def ingest_bucket(cfg: JobConfig) -> list[Column]:
    """Order-monotone buckets of the ingestion key, from coarse to fine (date,
    store, page group), for the scans in ingestion order."""
    return [F.col("ord.report_date"), F.col("ord.store_ord"), F.floor(F.col("ord.page_no") / F.lit(cfg.pages_per_bucket))]


def numbered(df: DataFrame, by: list[str], order=("ord",), large: bool = True) -> DataFrame:
    """W6 in ``order`` (columns, not one wide struct of them: they are what is shuffled); where a
    key may be ``large``, over sampled ranges: one bill may hold any share of the rows."""
    dealt, bucket = ranged_if_large(written(df), by, order) if large else (df.withColumn(RANGE, F.lit(0)), None)
    return keys.occurrence(dealt, by, order=order, out="occurrence", bucket=bucket).drop(RANGE)


# X1 ----------------------------------------------------------------------------
def invoice_items(lines: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """Invoice lines (S4 output) → the 17-column item table with ``occurrence``."""
    df = N.with_dict_fields(lines, "extra_data", {"peo_count": ("int", 0), "Membership_Type_Name": ("string", ""),
                                               "customer_name": ("string", ""), "customer_phone": ("string", "")},
                            names={k: f"__x_{k}" for k in ("peo_count", "Membership_Type_Name", "customer_name",
                                                           "customer_phone")})
    df = df.withColumn("toppings_list", N.parse_list("toppings", TOPPING_JSON, style="json", strict_quotes=True))
    df = nested.explode_keep_parent(df, "toppings_list", "topping_pos", "topping").drop("toppings_list")
    df = df.withColumn("__is_child", F.col("topping").isNotNull())
    df = nested.overlay_children(df, "topping", overwrite=nested.DISPLAY_FIELDS)
    df = nested.mark_children(df, F.col("__is_child"), "item_name",
                              null_text="nan" if cfg.semantics == "reference" else None)
    df = df.withColumn("tran_id", F.coalesce("tran_id", "id"))
    df = df.select(
        F.struct(F.col("report_date"), F.col("store_ord"), F.col("page_no"), F.col("entry_pos"), F.col("line_pos"),
                 F.col("topping_pos")).alias("ord"),
        F.col("store_name").alias("store"),
        F.coalesce("origin_tran_id", "tran_id").alias("invoice_id"),
        F.col("tran_no").alias("invoice_no"),
        S.local_time_text("tran_date").alias("date"),
        S.time_of_day("start_hour", "start_minute").alias("time_in"),
        S.time_of_day("end_hour", "end_minute").alias("time_out"),
        "table_name", F.col("item_name").alias("item"), F.col("quantity").alias("qty"),
        F.col("price_org").alias("unit_price"), F.col("__x_peo_count").alias("guests"),
        F.col("total_amount").alias("bill_total"), F.col("amount_discount_detail").alias("discount"),
        F.col("__x_Membership_Type_Name").alias("membership"), F.col("__x_customer_name").alias("customer"),
        F.col("__x_customer_phone").alias("phone"),
    )
    df = df.withColumn("customer_type", S.classify_customer("customer", "phone", "membership"))
    df = stage(df, cfg)  # parsed once, though the scans read it in several branches
    large = bool(large_cells(df, ["invoice_no"]))  # if no bill is, none of its items is
    fill_cols = [c for c in INVOICE_ITEM_LAYOUT if c not in ("membership", "customer", "phone", "invoice_no")]
    df = fill.fill_group_then_global(df, "invoice_no", fill_cols, order=["ord"], bucket=ingest_bucket(cfg),
                                     semantics=cfg.semantics)
    # Sorted by (invoice_no, date, item), then numbered within (invoice_no, item, qty).
    df = stage(numbered(df, ["invoice_no", "item", "qty"], [*nulls_last_key("invoice_no", "date"), "ord"], large), cfg)
    return df.withColumn("ord", F.struct(*nulls_last_key("invoice_no", "date", "item"), F.col("ord")))


# X2 ----------------------------------------------------------------------------
def order_log_items(flat: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """Flattened change log (S2 output) → signed, filled, type-filtered log."""
    df = flat.withColumn("toppings_list", N.parse_list("toppings", TOPPING_JSON, style="python"))
    df = df.withColumn("note", N.extract_field("extra_data", "message_modify_table", ""))
    df = nested.explode_keep_parent(df, "toppings_list", "topping_pos", "topping").drop("toppings_list")
    df = df.withColumn("__is_child", F.col("topping").isNotNull())
    df = nested.overlay_children(df, "topping", overwrite="all")
    df = nested.mark_children(df, F.col("__is_child"), "item_name",
                              null_text="nan" if cfg.semantics == "reference" else None)
    df = df.withColumn("ord", F.struct(F.col("report_date"), F.col("store_ord"), F.col("page_no"), F.col("entry_pos"),
                                       F.coalesce(F.col("item_pos"), F.lit(0)).alias("item_pos"), F.col("topping_pos"),
                                       F.lit(0).cast("long").alias("part")))
    # The id inside change_data; S2 already parsed the dict form, the full
    # parse (list form, Python literals) runs only where that gave nothing.
    parsed_id = F.col("change_tran_id") if "change_tran_id" in df.columns else F.lit(None).cast("string")
    header_ok = F.col("change_parsed") if "change_parsed" in df.columns else F.lit(False)
    cd_id = F.when(header_ok, parsed_id).otherwise(N.extract_id("change_data", "tran_id"))
    df = df.withColumn("tran_id", F.coalesce(cd_id, F.col("tran_id")))
    df = stage(df.select("ord", F.col("tran_id").alias("invoice_id"), F.col("tran_no").alias("invoice_no"),
                         S.local_time_text("tran_date", fmt=S.DATETIME_TEXT).alias("ts"), "table_name",
                         F.col("employee_name").alias("employee"), "log_type", "note", F.col("item_name").alias("item"),
                         F.col("quantity").alias("qty")), cfg)
    df = stage(fill.carry_sign(df, "invoice_id", "qty", S.starts_with("item", "+"), order=["ord"],
                               bucket=ingest_bucket(cfg)), cfg)
    fill_cols = ["ts", "table_name", "employee", "log_type", "item", "qty"]
    filled = fill.fill_group_then_global(df, "invoice_id", fill_cols, order=["ord"], bucket=ingest_bucket(cfg),
                                         semantics=cfg.semantics)
    df = df if filled is df else stage(filled, cfg)  # a table as it was needs no second one
    filled = fill.fill_global(df, "log_type", order=["ord"], bucket=ingest_bucket(cfg))
    kept = filled.filter(P.is_one_of("log_type", A.LOG_TYPES))
    return kept if filled is df else stage(kept, cfg)


def log_statistics(log: DataFrame) -> DataFrame:
    """A2 over the filtered log."""
    return A.log_stats(log, "log_type")


# X3 ----------------------------------------------------------------------------
def apply_merges(g: DataFrame, cfg: JobConfig) -> DataFrame:
    """T2 – follow merge notes to the final invoice and rewrite ids/numbers."""
    uni = cfg.semantics != "reference"  # notes in any case, accents composed or not
    merge_to = F.when(P.contains_text("note", "gộp vào", unicode=uni), S.text_between("note", "gộp vào", "-", unicode=uni))
    g = g.withColumn("merge_to", S.blank_to_null(merge_to))
    g, bucket = ranged_if_large(g, "invoice_no")
    g = fill.fill_group(g, "invoice_no", "merge_to", order=["ord"], bucket=bucket).drop(RANGE)
    g = stage(g.filter(~P.contains_text("note", "[Gộp đơn]", ignore_case=False, unicode=uni)), cfg)
    edges = keys.last_value_map(g, "invoice_id", "merge_to", order=["ord"], out_key="src", out_value="dst")
    numbers = keys.keep_first(g.select("invoice_id", "invoice_no", "ord"), "invoice_id", order=["ord"])
    resolved = links.resolve_links(g.select(F.col("invoice_id").alias("id")), edges, cycle="stop")
    g = links.rewrite_ids(g, resolved, numbers.select(F.col("invoice_id").alias("id"), F.col("invoice_no").alias("no")),
                          "invoice_id", "invoice_no", when_missing="null" if cfg.semantics == "reference" else "keep")
    return stage(g.drop("merge_to"), cfg)


def apply_splits(g: DataFrame, cfg: JobConfig) -> DataFrame:
    """T3 – split notes → parent links → family → split inventory."""
    uni = cfg.semantics != "reference"
    split_hit = P.contains_text("note", "bỏ món", unicode=uni) & P.contains_text("note", "tạo thành hóa đơn", unicode=uni)
    t = g.withColumn("split_to", S.blank_to_null(F.when(split_hit, S.capture("note", r"([A-Z0-9]{10,})\s*-"))))
    t, bucket = ranged_if_large(t, "invoice_id")
    t = fill.fill_masked(t, "invoice_id", "split_to", F.col("log_type") == "SALE_SPLIT_ORDER",
                         order=["ord"], bucket=bucket)
    t = stage(t.drop(RANGE), cfg)
    # child → parent: distinct (parent, child) pairs in first-seen order, last pair per child wins.
    pairs = (t.filter(F.col("split_to").isNotNull()).groupBy("invoice_id", "split_to")
             .agg(F.min("ord").alias("ord")))
    parents = keys.last_value_map(pairs, "split_to", "invoice_id", order=["ord"], out_key="src", out_value="dst")
    no_map = keys.last_value_map(t, "invoice_id", "invoice_no", order=["ord"], out_key="id", out_value="no")
    roots = links.resolve_links(t.select(F.col("invoice_id").alias("id")), parents, cycle="reenter",
                                out="family")
    t = joins.left_join_spread(t, roots.select(F.col("id").alias("__rid"), "family"), "invoice_id", "__rid").drop("__rid")
    t = joins.lookup(t, "split_to", no_map, "id", "no", out="split_no")
    t = rows.drop_notes(t, "note", "hóa đơn được tạo mới", unicode=uni)
    t = t.withColumn("__gord", F.col("ord"))
    t = t.withColumn("ord", F.struct(*nulls_last_key("ts", S.last_chars("split_no", 4)), F.col("ord")))
    t = rows.drop_orphan_splits(t, "split_to", "split_no")
    t = t.withColumn("qty", S.to_number("qty", 0.0))
    item = S.strip(S.as_text("item", "nan" if cfg.semantics == "reference" else None))
    t = t.withColumn("item", item)
    t = t.withColumns({c: S.blank_to_null(c) for c in ("invoice_id", "invoice_no", "table_name", "employee",
                                                        "log_type", "note", "item", "split_to", "split_no")})
    t = stage(t, cfg)
    out = splits.split_inventory(t, "family", "ts", "item", "qty", "log_type", "split_to", "split_no",
                                 "invoice_id", "invoice_no", ord_col="ord", bucket=lambda c: F.substring(c, 1, 10),
                                 part_col="__part")
    # the portions of one edit keep its place, each with a key of its own
    out = out.withColumn("ord", F.col("__gord").withField("part", F.col("__part")))
    return stage(out.drop("split_to", "split_no", "family", "__gord", "__part"), cfg)


def restructured(log: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """X3 – bills with a merge or split: their full history, merges followed,
    splits tracked; group 1."""
    flagged = joins.keep_flagged(log, "invoice_id", P.contains_any("log_type", "SALE_SPLIT_ORDER|SALE_MERGE_ORDER"))
    g = stage(flagged.withColumn("ord", F.struct(*nulls_last_key("invoice_id", "ts"), F.col("ord"))), cfg)
    g = apply_merges(g, cfg)
    is_split = P.contains_text("log_type", "SALE_SPLIT_ORDER")
    rest = g.filter(~is_split)
    moved = apply_splits(g, cfg)
    if cfg.semantics != "reference":
        # Edits consumed by the split inventory are not counted again, and merge
        # transfer rows are not netted: the merge is already carried by the id
        # rewrite (with id-on-id deduction their negatives would cancel real stock).
        consumed = P.is_one_of("log_type", splits.ADD_TYPES) & (S.to_number("qty", 0.0) > 0)
        rest = rest.filter(~consumed & ~P.contains_text("log_type", "SALE_MERGE_ORDER"))
    rest = rest.withColumn("qty", S.to_number("qty", 0.0))
    # concat order: the untouched rows, then the rows T1 emitted
    rest = rest.withColumn("ord", F.struct(F.lit(0).alias("src"), F.col("ord").alias("o")))
    moved = moved.withColumn("ord", F.struct(F.lit(1).alias("src"), F.col("ord").alias("o")))
    return rows.union_by_name(rest, moved.select(*rest.columns))


# X4 ----------------------------------------------------------------------------
def edit_only(log: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """X4 – bills whose history holds nothing but edits; group 2.

    ``reference`` compares the listed invoice *numbers* with invoice *ids*
    (so normally nothing is excluded), ``intended`` compares ids."""
    ok = P.contains_text("log_type", "SALE_CHANGE")
    listed_key = "invoice_no" if cfg.semantics == "reference" else "invoice_id"
    listed = log.filter(~ok).select(listed_key)
    g2 = joins.exclude_listed(log, "invoice_id", listed, listed_key)
    g2 = g2.withColumn("qty", S.to_number("qty", 0.0))
    return g2.withColumn("ord", F.struct(*nulls_last_key("invoice_id", "ts"), F.col("ord")))


# X5 ----------------------------------------------------------------------------
def net_orders(g1: DataFrame, g2: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """X5 – union, calendar parts, reverse deduction, occurrence."""
    t1, t2 = g1.schema["ord"].dataType, g2.schema["ord"].dataType
    columns = [c for c in g1.columns if c != "ord"]

    def side(df, src, o1, o2):
        return df.select(*columns, F.lit(src).alias("__src"), o1.alias("__o1"), o2.alias("__o2"), F.col("ts").alias("__text"))

    u = rows.union_by_name(side(g1, 0, F.col("ord"), F.lit(None).cast(t2)), side(g2, 1, F.lit(None).cast(t1), F.col("ord")))
    # The scans are given the parts of the order key: the whole, which repeats the columns it
    # sorts by, would be shuffled with each row.
    at = [*nulls_last_key("__text"), "__src", "__o1", "__o2"]
    t = F.try_to_timestamp(F.col("ts"), F.lit("yyyy/MM/dd HH:mm:ss")).cast("timestamp_ntz")
    u = u.withColumn("ts", t)
    u = u.withColumn("qty", S.to_number("qty", 0.0))
    neg_keys = ["invoice_id", "item"]
    pos_keys = ["invoice_no", "item"] if cfg.semantics == "reference" else ["invoice_id", "item"]
    order = [*(nulls_last_key("invoice_no") if "invoice_no" not in pos_keys else []), *at]
    large_pos, large_id = large_cells_of(u, pos_keys, neg_keys)
    if large_pos:
        u, bucket = ranged(u, pos_keys, order), RANGE
    else:
        u, bucket = u.withColumn(RANGE, F.lit(0)), None
    u = deduct.reverse_deduct(u, "qty", pos_keys, neg_keys, order=order, bucket=bucket).drop(RANGE)
    u = numbered(u, ["invoice_id", "item", "qty"], [*nulls_last_key("invoice_no", "ts"), *at], bool(large_id))
    u = u.withColumns({k: v for k, v in S.calendar_parts("ts").items()})
    u = stage(u, cfg)
    prev = F.struct(F.col("__src").alias("src"), F.col("__o1").alias("o1"), F.col("__o2").alias("o2"))
    prev = F.struct(*nulls_last_key("invoice_no", F.col("__text").alias("ts")), prev.alias("ord"))
    u = u.withColumn("ord", F.struct(*nulls_last_key("invoice_no", "item", "ts"), prev.alias("ord")))
    parts = [c for c in S.calendar_parts("ts") if c not in g1.columns]
    return u.select(*g1.columns, *parts, "occurrence")


# X6 ----------------------------------------------------------------------------
LOG_SIDE = ["invoice_id", "ts", "item", "occurrence", "employee", "log_type", "qty", "date", "week", "month", "year"]
INV_SIDE = ["store", "item", "qty", "occurrence", "unit_price", "invoice_id", "invoice_no", "table_name", "guests",
            "customer_type", "phone"]


def reconcile(orders: DataFrame, items: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """X6 – match log rows to invoice lines: strict on (id, item, qty,
    occurrence), then the leftovers loosely on (id, item)."""
    inv = items.withColumn("qty", S.to_number("qty", 0.0, truncate=True))
    log = orders.withColumn("occurrence", F.coalesce(F.col("occurrence"), F.lit(0)))
    L = log.select(*[F.col(c).alias(f"l_{c}") for c in LOG_SIDE], F.col("invoice_no").alias("l_invoice_no"),
                   F.col("ord").alias("l_ord"))
    V = inv.select(*[F.col(c).alias(f"v_{c}") for c in INV_SIDE])
    strict = joins.match_strict(L.drop("l_ord", "l_invoice_no"), V,
                                [("l_invoice_id", "v_invoice_id"), ("l_item", "v_item"), ("l_qty", "v_qty"),
                                 ("l_occurrence", "v_occurrence")], how="right")
    strict = stage(strict.drop("l_invoice_id", "l_occurrence"), cfg)  # read three times
    matched, unmatched_inv = joins.split_matched(strict, "l_item")
    left_log = joins.unmatched(L, matched.select("v_invoice_no", "l_item", "l_qty", "v_occurrence"),
                               [("l_invoice_no", "v_invoice_no"), ("l_item", "l_item"), ("l_qty", "l_qty"),
                                ("l_occurrence", "v_occurrence")])
    loose = joins.match_loose(left_log, unmatched_inv.select(*[f"v_{c}" for c in INV_SIDE]),
                              [("l_invoice_id", "v_invoice_id"), ("l_item", "v_item")],
                              dedupe_keys=["l_invoice_id", "l_item"], order=["l_ord"])
    loose = loose.filter(F.col("v_store").isNotNull() & F.col("l_item").isNotNull())
    both = rows.union_by_name(matched.select(*_sales_cols()), loose.select(*_sales_cols()))
    return both.withColumn("qty", F.col("qty").cast("double").try_cast("bigint"))


def _sales_cols() -> list[Column]:
    return [F.col("l_date").alias("date"), F.col("l_week").alias("week"), F.col("l_month").alias("month"),
            F.col("l_year").alias("year"), F.col("v_store").alias("store"), F.col("v_invoice_id").alias("invoice_id"),
            F.col("v_invoice_no").alias("invoice_no"), F.col("v_customer_type").alias("customer_type"),
            F.col("l_item").alias("item"), F.col("v_unit_price").alias("unit_price"),
            F.col("l_employee").alias("employee"), F.col("v_table_name").alias("table_name"),
            F.col("l_log_type").alias("log_type"), F.col("l_qty").alias("qty"), F.col("v_guests").alias("guests"),
            F.col("l_ts").alias("ts"), F.col("v_phone").alias("phone")]


# X7 / X8 -------------------------------------------------------------------------
def priced_sales(sales: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """X7 – price overrides, then order value = qty × unit price."""
    s = sales.withColumn("unit_price", S.override_price("item", "unit_price", cfg.price_rules))
    return s.withColumn("order_value", S.order_value("qty", "unit_price"))


def staff_kpi(sales: DataFrame) -> DataFrame:
    """X8 – order value per employee, bill and period; null keys dropped."""
    return A.kpi_sum(sales, KPI_KEYS, "order_value")


def to_labels(df: DataFrame, labels: dict[str, str] = LABELS) -> DataFrame:
    """P2 at the sink: internal snake_case → the display labels (``INVOICE_LABELS``
    for the invoice items, whose item and quantity are called otherwise)."""
    return rows.rename(df, labels)


def write_outputs(result: dict[str, DataFrame], root: str) -> None:
    """S7 for X7 and X8: priced sales and staff KPI under their display labels, by business
    date under ``root``; a re-run replaces only the dates it has rows of."""
    from tillwork.sources.sinks import write_dated

    for name in ("sales", "staff_kpi"):
        write_dated(to_labels(result[name].withColumn("report_date", F.regexp_replace("date", "/", "-"))), f"{root}/{name}")


# X0 + whole job -------------------------------------------------------------------
@dataclass
class LandedPaths:
    """Roots of the landed responses: one file per page or invoice, or (``compact``)
    JSON lines with many of them a file."""

    change_log: str
    invoices: str
    details: str
    compact: bool = False


def save_and_reload(df: DataFrame, path: str) -> DataFrame:
    """Write raw rows by report date under ``path`` and read those dates back.  An empty
    source writes nothing, so it replaces nothing saved before, and stays empty."""
    from tillwork.sources.sinks import read_dated, write_dated

    spark = df.sparkSession
    dates = [r[0] for r in df.select("report_date").distinct().collect()]  # one value per landed day
    if not dates:
        return spark.createDataFrame([], df.schema)
    write_dated(df, path)
    saved = read_dated(spark, path, dates=dates)
    return saved.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in df.schema.fields])


def acquire(spark: SparkSession, paths: LandedPaths, store_map, window=None,
            raw_root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """X0 – (flattened change log, invoice lines) of the landed pages.

    ``window`` (S5 bounds) keeps the entries and invoices of the report period;
    ``raw_root`` saves both sources by report date and goes on from what was saved."""
    from tillwork.sources import invoices as I
    from tillwork.sources import pages

    dim = I.stores(spark, store_map)
    read_log = pages.read_page_lines if paths.compact else pages.read_pages
    read_headers = I.read_invoice_lines if paths.compact else I.read_invoices
    read_details = I.read_detail_lines if paths.compact else I.read_details
    entries = read_log(spark, paths.change_log, stores=dim)
    headers = read_headers(spark, paths.invoices, dim)
    if window is not None:
        entries, headers = I.in_window(entries, "tran_date", window), I.in_window(headers, "tran_date", window)
    flat = pages.flatten_change_log(entries)
    lines = I.attach_details(headers, read_details(spark, paths.details))
    if raw_root is None:
        return flat, lines
    return save_and_reload(flat, f"{raw_root}/change_log"), save_and_reload(lines, f"{raw_root}/invoices")


def daily_job(spark: SparkSession, paths: LandedPaths, store_map, cfg: JobConfig = JobConfig(), window=None,
              raw_root: str | None = None, out_root: str | None = None) -> dict[str, DataFrame]:
    """Acquire (X0), run X1–X8 and return every stage's DataFrame; with ``out_root``
    the priced sales and the staff KPI are written by date."""
    flat, lines = acquire(spark, paths, store_map, window, raw_root)
    out = run_stages(flat, lines, cfg)
    if out_root is not None:
        write_outputs(out, out_root)
    return out


def run_stages(flat: DataFrame, lines: DataFrame, cfg: JobConfig = JobConfig()) -> dict[str, DataFrame]:
    """X1–X8 from a flattened change log (S2) and invoice lines."""
    items = invoice_items(lines, cfg)
    log = order_log_items(flat, cfg)
    g1 = restructured(log, cfg)
    g2 = edit_only(log, cfg)
    orders = net_orders(g1, g2, cfg)
    sales = priced_sales(reconcile(orders, items, cfg), cfg)
    kpi = rows.sort_nulls_last(staff_kpi(sales), ["date", "invoice_no", "employee"], None)
    return {"invoice_items": items, "order_log": log, "group1": g1, "group2": g2, "net_orders": orders,
            "sales": sales, "staff_kpi": kpi, "log_stats": log_statistics(log)}
