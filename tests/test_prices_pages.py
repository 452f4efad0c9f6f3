"""Price rules from a table against a plain scan of all rules; missing pages by hand; odd nested texts."""

import random

from pyspark.sql import functions as F

from tillwork.functions import nested as N
from tillwork.operators.prices import override_price_table
from tillwork.sources.pages import missing_pages


def test_price_rules_against_a_plain_scan(spark):
    rnd = random.Random(6)
    word = lambda n: "".join(rnd.choice("ab é+.") for _ in range(n))
    items = [None, "", "a", "ab"] + [word(rnd.randint(0, 14)) for _ in range(120)]
    rules = [(k, word(rnd.choice([0, 1, 2, 3, 3, 4, 5])) if k % 9 else None, float(k) if k % 7 else None) for k in range(80) if k != 27]
    rows = [(i, rnd.choice(items), 0.5) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, item string, price double")
    table = spark.createDataFrame(rules, "rule_no int, pattern string, price double")
    for use in (rules, [r for r in rules if r[1]], []):
        table = spark.createDataFrame(use, "rule_no int, pattern string, price double")
        got = {r.id: r.price for r in override_price_table(df, "item", "price", table).collect()}
        for i, item, price in rows:
            hits = [r for r in use if item is not None and r[1] is not None and r[1] in item]
            assert got[i] == (max(hits)[2] if hits else price), (item, hits)


def test_ten_thousand_rules(spark):
    rules = spark.range(10_000).select(F.col("id").alias("rule_no"), F.concat(F.lit("x"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("pattern"), F.col("id").cast("double").alias("price"))
    df = spark.range(2000).select(F.concat(F.lit("item x"), F.lpad((F.col("id") * 5).cast("string"), 5, "0"), F.lit(" end")).alias("item"), F.lit(-1.0).alias("price"), (F.col("id") * 5.0).alias("want"))
    assert override_price_table(df, "item", "price", rules).where("price <> want").count() == 0


def test_missing_pages_by_hand(spark):
    pages = [("a", "d1", 1, 100), ("a", "d1", 2, 100), ("a", "d1", 2, 7), ("a", "d1", 5, 30), ("a", "d2", 3, 100), ("b", "d1", 1, 0)]
    df = spark.createDataFrame(pages, "store_uid string, report_date string, page_no int, entries int")
    got = sorted(tuple(r) for r in missing_pages(df, 100).collect())
    assert got == [("a", "d1", 3, 4), ("a", "d2", 1, 2), ("a", "d2", 4, None)]
    assert missing_pages(df.limit(0), 100).collect() == []


def test_long_quoted_texts_are_read(spark):
    """No stack runs over on long quotes, many words or many items."""
    texts = ["[{'item_name': '" + "x, None, " * 30_000 + "'}]", "[" + "{'item_name': None}, " * 5_000 + "{'item_name': 'z'}]", "[{'item_name': '" + "\\'" * 50_000 + "'}]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = df.select("id", N.parse_list("t", "struct<item_name:string>", style="python").alias("l")).orderBy("id").select(
        F.size("l").alias("n"), F.length(F.element_at("l", -1)["item_name"]).alias("len")).collect()
    assert [tuple(r) for r in got] == [(1, 270_000), (5_001, 1), (1, 50_000)]
