"""Pairs of items within baskets, without ever gathering a basket of unbounded size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isolake.operators.skew import salted_join


def meeting_pairs(rows: DataFrame, basket: Sequence[str], item: str, keep: Sequence[str] = (), block: int = 512, rows_per_task: int = 2_000_000, wanted: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(x, y) structs of (item, keep...) for every two different items of a basket, the smaller item as x; rows must be distinct by basket and item.

    A basket with more than `block` items is cut into k blocks by item hash, of which each two (and each with itself) are a unit of work; the others are
    one block. `wanted` is a condition on two cells, true whichever comes first; pairs without it are not made. Pairs are meant to be summed next, which Spark begins before the shuffle.
    """
    cell, keys = F.struct(item, *keep), list(basket)
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(*keys, F.ceil(F.col("n") / block).cast("int").alias("__k"))
    cut = salted_join(rows, large, keys, "left", rows_per_task).withColumn("__k", F.coalesce("__k", F.lit(1))).withColumn("__c", F.pmod(F.xxhash64(item), F.col("__k")).cast("int"))
    blocks = cut.groupBy(*keys, "__k", "__c").agg(F.sort_array(F.collect_list(cell)).alias("ys"))
    one = blocks.where("__k = 1").select(F.lit(False).alias("two"), F.col("ys").alias("xs"), "ys")
    meet = blocks.where("__k > 1").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("__k") - 1))).withColumn("c1", F.least("__c", "o")).withColumn("c2", F.greatest("__c", "o"))
    both = meet.groupBy(*keys, "c1", "c2").agg(F.max(F.when(F.col("__c") == F.col("c1"), F.col("ys"))).alias("xs"), F.max(F.when(F.col("__c") == F.col("c2"), F.col("ys"))).alias("ys"))
    pairs = one.unionByName(both.where("xs IS NOT NULL AND ys IS NOT NULL").select((F.col("c1") < F.col("c2")).alias("two"), "xs", "ys"))
    x = pairs.select("two", "ys", F.posexplode("xs").alias("i", "x"))
    rest = F.when(F.col("two"), F.col("ys")).otherwise(F.slice("ys", F.col("i") + 2, F.size("ys")))  # a block with itself: the items after x
    p = x.select("x", F.explode(rest if wanted is None else F.filter(rest, lambda y: wanted(F.col("x"), y))).alias("y"))
    first = F.col(f"x.{item}") < F.col(f"y.{item}")
    return p.select(F.when(first, F.col("x")).otherwise(F.col("y")).alias("x"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("y"))
