"""Price overrides from a table of rules (C12 for many rules).

A rule names a text; an item that holds it takes the rule's price, the rule with the greatest
number winning.  Items are matched once per distinct text: each rule looks up the rarest of its
trigrams among the items' trigrams and is verified there, so neither rows nor items meet all
rules, and the price joins back on the item.  A trigram that many items hold is dealt out: its
items over parts of ``HELD`` on average, its rules to each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
#: items of one gram that one part takes
HELD = 50_000


def grams(text: Column, size: Column) -> Column:
    """Distinct substrings of ``size`` characters; none if the text is shorter."""
    last = F.char_length(text) - size + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, size)))).otherwise(F.array().cast("array<string>"))


def override_price_table(df: DataFrame, item: str, price: str, rules: DataFrame, pattern_col: str = "pattern",
                         price_col: str = "price", number_col: str = "rule_no") -> DataFrame:
    """C12 – ``df`` with ``price`` set by the last rule whose pattern occurs in ``item``.

    Patterns are plain text; of equal patterns the last rule counts; an empty one is in every
    item.  Null patterns and null items match nothing; a rule without a price sets null.
    """
    rule = F.struct(F.col(number_col).alias("no"), F.col(price_col).cast("double").alias("price"))
    last = (rules.where(F.col(pattern_col).isNotNull()).groupBy(F.col(pattern_col).cast("string").alias("__pattern")).agg(F.max_by(rule, number_col).alias("__rule")))
    items = df.select(F.col(item).cast("string").alias("__item")).where("__item IS NOT NULL").distinct()
    sizes = {r[0] for r in last.select(F.least(F.lit(GRAM), F.char_length("__pattern"))).distinct().collect()}  # of 0 to GRAM
    of_sizes = [F.array(F.lit("")) if n == 0 else grams(F.col("__item"), F.lit(n)) for n in sorted(sizes)]
    postings = items.select("__item", F.explode(F.flatten(F.array(F.array().cast("array<string>"), *of_sizes))).alias("__gram"))
    counts = postings.groupBy(F.col("__gram").alias("__of")).agg(F.count("*").alias("__n"))
    wanted = last.select("*", F.explode(F.when(F.col("__pattern") == "", F.array(F.lit(""))).otherwise(
        grams(F.col("__pattern"), F.least(F.lit(GRAM), F.char_length("__pattern"))))).alias("__gram"))
    # a pattern with a gram that no item has is in no item; of the others the rarest counts
    rarest = (wanted.join(counts, F.col("__gram") == F.col("__of"), "left").groupBy("__pattern", "__rule")
              .agg(F.min_by("__gram", F.struct(F.coalesce("__n", F.lit(0)), "__gram")).alias("__gram")))
    # few: one gram for every HELD postings at most
    parts = F.broadcast(counts.where(F.col("__n") > HELD).select("__of", F.ceil(F.col("__n") / HELD).cast("int").alias("__parts")))
    held = postings.join(parts, F.col("__gram") == F.col("__of"), "left")
    held = held.select("__gram", F.pmod(F.xxhash64("__item"), F.coalesce("__parts", F.lit(1))).cast("int").alias("__part"), "__item")
    sought = rarest.join(parts, F.col("__gram") == F.col("__of"), "left")
    sought = sought.select("__gram", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)).alias("__part"), "__pattern", F.col("__rule.no").alias("__no"))
    # the greatest number alone is a hash aggregate, which holds no row of a match; its price joins on it
    best = (held.join(sought, ["__gram", "__part"]).where(F.contains("__item", F.col("__pattern")))
            .groupBy("__item").agg(F.max("__no").alias("__no")))
    prices = last.groupBy(F.col("__rule.no").alias("__of")).agg(F.max("__rule.price").alias("__price"))
    best = best.join(prices, F.col("__no") == F.col("__of")).select("__item", F.lit(True).alias("__found"), "__price")
    out = df.join(best, F.col(item).cast("string") == F.col("__item"), "left")
    new = F.when(F.col("__found"), F.col("__price")).otherwise(F.col(price).cast("double"))
    return out.withColumn(price, new).drop("__item", "__found", "__price")
