"""Work per row, tasks and shuffles of the queries that were to fail on larger tables."""

import json

import pytest
from pyspark.sql import functions as F

from tillwork.functions import nested as N
from tillwork.functions.scalars import strip
from tillwork.plans.driver_queries import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def events(spark, tmp_path):
    rows = [(i, i % 4, f"kind{i % 3}", float(i), json.dumps({"k": i % 100})) for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string")
    df = df.withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(event_id AS int))"))
    df.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("parse, most", [
    (lambda c: N.parse_dict(c), 5),
    (lambda c: N.extract_id(c, "tran_id"), 9),
    (lambda c: N.parse_list(c, "struct<item_name:string>", style="python"), 5),
])
def test_a_text_is_rewritten_once(spark, parse, most):
    df = spark.createDataFrame([("{'tran_id': None}",)], "t string")
    assert plan_of(df.select(parse("t").alias("x"))).count("regexp_replace(") <= most


def test_strip_takes_unicode_space_off_both_ends(spark):
    texts = ["", " ", "a", " a", "a ", " a b \n", "a\n", "　", "a\u0085", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(strip("t").alias("t")).collect()
    assert [r.t for r in got] == ["", "", "a", "a", "a", "a b", "a", "", "a", None]


def test_extract_fields_of_a_compact_file_runs_in_many_tasks(spark, events):
    out = QUERIES["extract_fields"](spark, events)
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {r.event_id: (r.k, r.peo_count, r.tran_id) for r in out.collect()}
    assert got == {i: (i % 100, i % 100 if i % 5 < 2 else 0, {0: f"D{i}", 4: f"T{i}"}.get(i % 5, f"E{i}")) for i in range(120)}


def test_a_detail_or_page_body_is_stripped_once(spark):
    from tillwork.sources.invoices import details_from_bodies
    from tillwork.sources.pages import CHANGE_LOG_ENTRY, entries_from_pages

    bodies = spark.createDataFrame([("S1", "T1", ' {"data": {"sale_detail": [{"item_name": "a"}]}} '), ("S1", "T2", "oops")], "store_uid string, tran_id string, body string")
    details = details_from_bodies(bodies)
    assert plan_of(details).count("regexp_replace(") == 1
    assert [r.sale_detail and [x.item_name for x in r.sale_detail] for r in details.orderBy("tran_id").collect()] == [["a"], None]
    pages = spark.createDataFrame([("S1", "2024-01-01", i, b) for i, b in enumerate([' [{"tran_id": "a"}]', '{"data": [{"tran_id": "b"}]}\n', '{"data": {"items": [{"tran_id": "c"}]}}', "", "x"])],
                                  "store_uid string, report_date string, page_no int, body string")
    entries = entries_from_pages(pages, CHANGE_LOG_ENTRY)
    assert plan_of(entries).count("regexp_replace(") == 1
    assert sorted((r.page_no, r.tran_id) for r in entries.collect()) == [(0, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("large", [0, 3, 10])
@pytest.mark.parametrize("descending", [False, True])
def test_large_and_small_keys_scan_alike(spark, monkeypatch, large, descending):
    from tillwork.operators import scan as module

    rows = [(None if i % 5 == 0 else i % 7 if i % 3 else 1, i // 40, i // 7, i, i if i % 6 == 1 else None, i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, b1 int, b2 int, o int, v int, q int")
    specs = [("f", "last", "v"), ("n", "count", None), ("t", "sum", "q"), ("m", "max", "v"), ("p", "max_before", "q")]
    for null_keys in ("group", "null"):
        want = module.scan(df, specs, ["k"], ["o"], None, descending, null_keys).orderBy("o").collect()
        monkeypatch.setattr(module, "LARGE", large)
        assert module.scan(df, specs, ["k"], ["o"], ["b1", "b2"], descending, null_keys).select(*want[0].__fields__).orderBy("o").collect() == want


def test_small_keys_are_scanned_in_one_pass(spark):
    from tillwork.operators.keys import occurrence

    df = spark.range(100).select(F.col("id").alias("ord"), (F.col("id") % 9).alias("k"), F.floor(F.col("id") / 10).alias("b"))
    plan = plan_of(occurrence(df, "k", bucket="b"))
    assert plan.count("Window [") == 1 and "Join" not in plan and "Aggregate" not in plan


def test_a_gram_of_many_items_is_dealt_over_parts(spark, monkeypatch):
    from tillwork.operators import prices

    df = spark.createDataFrame([(i, f"red {i:03d}" if i % 4 else None, 1.0) for i in range(200)], "i int, item string, price double")
    rules = spark.createDataFrame([(1, "red", 2.0), (2, "d 0", 3.0), (3, "red 19", None), (4, "", 9.0), (0, "blue", 5.0), (5, "5", 7.0)], "rule_no int, pattern string, price double")
    rules = rules.where("rule_no <> 4")
    want = prices.override_price_table(df, "item", "price", rules).orderBy("i").collect()
    monkeypatch.setattr(prices, "HELD", 7)
    out = prices.override_price_table(df, "item", "price", rules)
    assert out.orderBy("i").collect() == want
    assert "__part" in plan_of(out)
    text = {r.i: r.price for r in want}
    assert (text[1], text[5], text[150], text[191], text[4]) == (3.0, 7.0, 7.0, None, 1.0)


def test_a_stage_is_a_table_of_which_branches_read_their_columns(spark):
    from tillwork.plans.pipeline import JobConfig, stage

    df = spark.range(20).select(F.struct(F.col("id").alias("a"), F.lit(None).cast("string").alias("b")).alias("ord"), F.lit(" x").alias("note"))
    kept = stage(df, JobConfig())
    assert kept.inputFiles() and kept.schema.simpleString() == df.schema.simpleString()
    assert sorted(kept.collect()) == sorted(df.collect())
    assert stage(df.where("note = ''"), JobConfig()).count() == 0


@pytest.mark.parametrize("large", [1000, 5])
def test_bills_are_dealt_into_ranges_only_if_one_is_large(spark, monkeypatch, large):
    from tillwork.operators import scan as module
    from tillwork.plans.pipeline import numbered

    monkeypatch.setattr(module, "LARGE", large)
    df = spark.createDataFrame([(i, "hot" if i % 2 else f"b{i % 6}" if i % 10 else None) for i in range(120)], "ord int, bill string").repartition(3)
    bucket = module.ranged_if_large(df, "bill")[1]
    assert (bucket is None) == (large == 1000)
    seen, want = {}, {}
    for i in range(120):
        key = "hot" if i % 2 else f"b{i % 6}" if i % 10 else None
        want[i] = seen[key] = 0 if key is None else seen.get(key, 0) + 1
    assert {r.ord: r.occurrence for r in numbered(df, ["bill"]).collect()} == want


def test_rows_without_a_key_are_dealt_out_by_a_lookup(spark):
    from tillwork.operators.joins import lookup

    df = spark.range(1000).select("id", F.when(F.col("id") % 100 == 7, F.concat(F.lit("k"), "id")).alias("to"), F.create_map(F.lit("a"), "id").alias("m"))
    dim = spark.createDataFrame([("k7", "seven"), ("k107", None), (None, "none"), ("k1", "one")], "id string, no string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = lookup(df, "to", dim, "id", "no")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 1000 and max(sizes) < 500
        assert {(r.id, r.no) for r in out.where("no IS NOT NULL").collect()} == {(7, "seven")}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
