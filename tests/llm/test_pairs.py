import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from isolake.llm import pairs as P
from isolake.session import new_dir
from tests.conftest import rows


def brute(baskets, min_both, min_lift):
    """(a, b) -> (n_both, n_a, n_b, n) of the pairs that meet the bounds."""
    held = {b: set(xs) for b, xs in baskets.items() if xs}
    n, single, both = len(held), Counter(), Counter()
    for xs in held.values():
        single.update(xs)
        both.update(itertools.combinations(sorted(xs), 2))
    return {p: (c, single[p[0]], single[p[1]], n) for p, c in both.items() if c >= min_both and c * n >= min_lift * single[p[0]] * single[p[1]]}


def table_of(t):
    return {(r.a, r.b): (r.n_both, r.n_a, r.n_b, r.n) for r in P.associated(t).collect()}


def change(spark, contents):
    data = [(b, x) for b, xs in contents.items() for x in (xs or [None])]
    return spark.createDataFrame(data, "basket string, item string").withColumn("n", F.lit(5))


@pytest.mark.parametrize("block", [512, 4])
def test_increments_equal_a_fresh_count(spark, block):
    rnd = random.Random(block)
    items = [f"i{k:02}" for k in range(18)]
    weights = [1 / (k + 1) for k in range(18)]
    baskets = {f"b{k}": set(rnd.choices(items, weights, k=rnd.randrange(1, 9))) for k in range(60)}
    t = P.PairTable(spark, new_dir(spark, "t"), min_both=3, min_lift=2, buckets=8, block=block)
    t.apply(change(spark, baskets))
    assert table_of(t) == brute(baskets, 3, 2)
    for step in range(3):
        touched = {}
        for b in rnd.sample(sorted(baskets), 8):
            touched[b] = set() if rnd.random() < 0.3 else set(rnd.choices(items, k=rnd.randrange(1, 9)))
        for k in range(4):
            touched[f"new{step}{k}"] = set(rnd.choices(items, weights, k=6))
        baskets |= touched
        t.apply(change(spark, touched))
        assert table_of(t) == brute(baskets, 3, 2)
    again = P.PairTable(spark, t.path, min_both=3, min_lift=2, buckets=8, block=block)
    assert (again.version, again.n) == (4, t.n) and table_of(again) == table_of(t)


def test_unadmitted_items_are_pruned_exactly(spark):
    baskets = {f"b{k}": {"everywhere", f"rare{k}", "x", "y"} if k < 6 else {"everywhere", "z"} for k in range(30)}
    t = P.pair_table(spark, change(spark, baskets), min_both=6, min_lift=3)
    assert table_of(t) == brute(baskets, 6, 3) == {("x", "y"): (6, 6, 6, 30)}
    assert {r.item for r in t.marginals().where("admitted").collect()} == {"x", "y"}


def test_a_hot_basket_is_cut_into_blocks(spark):
    baskets = {"hot": {f"i{k:03}" for k in range(120)}, "a": {"i001", "i002"}, "b": {"i001", "i002", "i119"}}
    t = P.pair_table(spark, change(spark, baskets), min_both=1, min_lift=0, block=16, rows_per_task=50)
    assert table_of(t) == brute(baskets, 1, 0)
    assert t.pairs().count() == 120 * 119 // 2


def test_nulls_repeats_blanks_and_empty_tables(spark):
    p = spark.createDataFrame([(" g1 ", "s1", 1), ("g1", "s1 ", 0), ("g1", "s1", 1), (None, "s1", 1), ("g2", None, 1), ("g2", "s1", None), ("g3", "s1", 1), ("G3", "s1", 1)], "gene string, sample_id string, present int")
    assert rows(P.presence_baskets(p).distinct()) == [("s1", "G3"), ("s1", "g1"), ("s1", "g3")]
    t = P.pair_table(spark, P.presence_baskets(p), min_both=1, min_lift=0)
    assert set(table_of(t)) == {("G3", "g1"), ("G3", "g3"), ("g1", "g3")}
    empty = P.pair_table(spark, P.presence_baskets(p.limit(0)))
    assert table_of(empty) == {} and empty.n == 0
    empty.apply(change(spark, {"b": {"x", "y"}}))
    assert empty.n == 1
    long = "x" * 100_000
    assert set(table_of(P.pair_table(spark, change(spark, {"b": {long, "y"}}), min_both=1, min_lift=0))) == {(long, "y")}


def test_scores(spark):
    t = P.pair_table(spark, change(spark, {"1": {"a", "b"}, "2": {"a", "b"}, "3": {"c"}, "4": {"a"}}), min_both=1, min_lift=0)
    r = t.pairs().where("a = 'a' AND b = 'b'").first()
    assert r.lift == pytest.approx(2 * 4 / (3 * 2))
    assert r.g2 == pytest.approx(2 * (2 * math.log(4 / 3) + 1 * math.log((1 * 4) / (3 * 2)) + 1 * math.log(4 / (1 * 2))))


def files(t):
    return {r.f: r.n for r in t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(t.path).select(F.col("path").alias("f"), F.col("length").alias("n")).collect()}


def test_untouched_buckets_keep_their_files_when_baskets_are_added(spark):
    t = P.PairTable(spark, new_dir(spark, "t"), min_both=1, min_lift=0, buckets=16)
    t.apply(change(spark, {f"b{k}": {f"x{k}", f"y{k}"} for k in range(40)}))
    before, held = files(t), dict(t.at["pairs"])
    t.apply(change(spark, {"new": {"x0", "y0"}}))
    assert t.n == 41 and sum(held[b] != v for b, v in t.at["pairs"].items()) == 1
    kept = [f for f in before if "/pairs/" in f or "/memberships/" in f]
    assert kept and all(files(t).get(f) == before[f] for f in kept)
    assert t.pairs().where("a = 'x0'").first().n == 41 and t.pairs().where("a = 'x1'").first().n == 41  # scores follow n without a rewrite
    t.vacuum()
    left = files(t)
    assert len(left) < len(before) + 4 and table_of(t)[("x0", "y0")] == (2, 2, 2, 41) and t.pairs().count() == 40


def test_a_table_that_grows_gets_more_buckets(spark):
    t = P.PairTable(spark, new_dir(spark, "t"), min_both=1, min_lift=0, buckets=2, rows_per_bucket=10)
    t.apply(change(spark, {"b": {"x", "y"}}))
    assert t.buckets == {"memberships": 2, "pairs": 2}
    baskets = {f"b{k}": {f"i{j}" for j in range(k % 7)} for k in range(30)} | {"b": {"x", "y"}}
    t.apply(change(spark, {k: v for k, v in baskets.items() if k != "b"}))
    assert t.buckets["memberships"] >= 8 and len(t.at["memberships"]) > 4 and t.buckets["pairs"] >= 2
    assert table_of(t) == brute(baskets, 1, 0)
    again = P.PairTable(spark, t.path, min_both=1, min_lift=0)
    assert again.buckets == t.buckets and again.rows == t.rows and table_of(again) == table_of(t)


def test_changes_share_out_all_rows(spark):
    df = change(spark, {f"b{k}": {"x", f"y{k}"} for k in range(20)})
    parts = P.in_changes(df, 3)
    assert sum(p.count() for p in parts) == 40
    t, u = P.pair_table(spark, *parts, min_both=1, min_lift=0), P.pair_table(spark, df, min_both=1, min_lift=0)
    assert t.version == 3 and table_of(t) == table_of(u)


def test_collections_share_a_table_but_no_counts(spark):
    one = {f"b{k}": {"x", "y"} if k < 4 else {"z"} for k in range(9)}
    two = {f"b{k}": {"x", "y", "z"} if k < 3 else {f"w{k}"} for k in range(12)}
    df = change(spark, one).withColumn("space", F.lit("one")).unionByName(change(spark, two).withColumn("space", F.lit("two")))
    t = P.pair_table(spark, *P.in_changes(df, 2), min_both=2, min_lift=2)
    got = {}
    for r in P.associated(t).collect():
        got.setdefault(r.space, {})[r.a, r.b] = (r.n_both, r.n_a, r.n_b, r.n)
    assert got == {"one": brute(one, 2, 2), "two": brute(two, 2, 2)} and t.sizes == {"one": 9, "two": 12}
