"""Ordered operators: false-discovery adjustment, best hits, gap calling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isolake.operators.skew import salted_join
from isolake.session import materialise


def benjamini_hochberg(df: DataFrame, p: str = "p_value", by: Sequence[str] = (), name: str = "adjusted_p_value", buckets: int = 64) -> DataFrame:
    """`df` with the adjusted p value: the least of p*n/rank over the p values at least as great, capped at 1; ties share it.

    Null p values are not counted and stay null. `df` is written once, as it is read several times. Ranks are found over distinct p values cut into `buckets` ranges, so no task orders all of
    them: totals and least values of the ranges are combined over one row a range.
    """
    df = materialise(df, "adjusted")
    d = df.where(F.col(p).isNotNull()).groupBy(*by, F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    edges = sorted(set(d.select("__p").distinct().approxQuantile("__p", [i / buckets for i in range(1, buckets)], 0.01))) if buckets > 1 else []
    bucket = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < F.col("__p"))) if edges else F.lit(0)
    d = d.withColumn("__b", bucket)
    keys, group = [*by, "__b"], list(by) or [F.lit(0)]
    per = d.groupBy(*keys).agg(F.sum("__c").alias("__t"))
    per = per.withColumn("__before", F.sum("__t").over(Window.partitionBy(*group).orderBy("__b")) - F.col("__t")).withColumn("__n", F.sum("__t").over(Window.partitionBy(*group))).drop("__t")
    d = _attach(d, per, keys)
    d = d.withColumn("__raw", F.col("__p") * F.col("__n") / (F.col("__before") + F.sum("__c").over(Window.partitionBy(*keys).orderBy("__p"))))
    d = d.withColumn("__least", F.min("__raw").over(Window.partitionBy(*keys).orderBy(F.desc("__p"))))
    after = Window.partitionBy(*group).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    low = d.groupBy(*keys).agg(F.min("__raw").alias("__m")).withColumn("__later", F.min("__m").over(after)).drop("__m")
    adjusted = F.least(F.lit(1.0), F.col("__least"), F.coalesce("__later", F.lit(1.0)))
    # a p value such as 1 may be that of a large share of the rows: the join back is salted
    key = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"k{i}") for i, c in enumerate(by)], *[F.col(c).isNull().alias(f"n{i}") for i, c in enumerate(by)])
    adj = _attach(d, low, keys).select(F.struct(key.alias("by"), F.col("__p").alias("p")).alias("__key"), adjusted.alias(name))
    return salted_join(df.withColumn("__key", F.struct(key.alias("by"), F.col(p).alias("p"))), adj, ["__key"], "left").drop("__key")


def _attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys of which nulls are equal."""
    r = right.select(*[F.col(k).alias(f"__right_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(r[f"__right_{i}"]) for i, k in enumerate(keys)]
    return left.join(r, on, "left").drop(*[f"__right_{i}" for i in range(len(keys))])


def best_hit(hits: DataFrame, keys: Sequence[str], scores: Sequence[str], tie: Sequence[str], minimum: dict[str, float] | None = None) -> DataFrame:
    """The hit of each key with the greatest scores, in their order; thresholds apply first, ties go to the least `tie`."""
    for c, least in (minimum or {}).items():
        hits = hits.where(F.col(c) >= least)
    w = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(s) for s in scores], *tie)
    return hits.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def call_gaps(blocks: DataFrame, group: Sequence[str], q_start: str, q_end: str, r_start: str, r_end: str, minimum: float, ratio: float = 4.0, identity: str | None = None, min_identity: float = 0.0, tie: Sequence[str] = ()) -> DataFrame:
    """Gaps between consecutive blocks of a group: an insertion where the query gap is at least `minimum` and more than `ratio` times the reference gap, a deletion the other way round.

    Overlapping blocks (negative gaps) give nothing; both flanks must reach the identity.
    """
    w = Window.partitionBy(*group).orderBy(q_start, *tie)
    nxt = lambda c: F.lead(c).over(w)
    b = blocks.withColumn("q_gap", nxt(q_start) - F.col(q_end)).withColumn("r_gap", nxt(r_start) - F.col(r_end))
    if identity:
        b = b.withColumn("__id", F.least(F.col(identity), nxt(identity))).where(F.col("__id") >= min_identity).drop("__id")
    kind = F.when((F.col("q_gap") >= minimum) & (F.col("q_gap") > ratio * F.col("r_gap")), "insertion").when((F.col("r_gap") >= minimum) & (F.col("r_gap") > ratio * F.col("q_gap")), "deletion")
    return b.where("q_gap >= 0 AND r_gap >= 0").withColumn("kind", kind).where("kind IS NOT NULL")


def unassessable_ends(contigs: DataFrame, blocks: DataFrame, key: str, length: str, start: str, end: str, minimum: int) -> DataFrame:
    """(key, part, from_pos, to_pos): contigs without blocks as a whole, and heads and tails of at least `minimum` outside all blocks."""
    span = blocks.groupBy(key).agg(F.min(start).alias("s"), F.max(end).alias("e"))
    j = contigs.select(key, length).join(span, key, "left")
    n = F.col(length)
    part = lambda name, a, b: F.struct(F.lit(name).alias("part"), a.cast("long").alias("from_pos"), b.cast("long").alias("to_pos"))
    parts = F.array_compact(F.array(
        F.when(F.col("s").isNull(), part("whole", F.lit(1), n)),
        F.when(F.col("s") - 1 >= minimum, part("head", F.lit(1), F.col("s") - 1)),
        F.when(n - F.col("e") >= minimum, part("tail", F.col("e") + 1, n)),
    ))
    return j.select(key, F.explode(parts).alias("x")).select(key, "x.*")


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "rn", ranges: int | None = None) -> DataFrame:
    """`df` with the number of each row, from 1, in an order over all rows.

    Rows are cut into ranges of the order and numbered within each; the sizes of the ranges before are added, over one row a range, so no
    task orders all rows. Rows that tie in all of `order` are numbered arbitrarily.
    """
    cut = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    cut = materialise(cut.withColumn("__range", F.spark_partition_id()), "numbered")
    sizes = cut.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.select("__range", (F.sum("__size").over(Window.orderBy("__range")) - F.col("__size")).alias("__before"))
    local = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return cut.withColumn(name, local.cast("long")).join(F.broadcast(before), "__range").withColumn(name, F.col(name) + F.col("__before")).drop("__range", "__before")


def threshold_sweep(df: DataFrame, value: str, floors: Sequence[float], group: Sequence[str]) -> DataFrame:
    """(group..., floor, passed, total): how many rows reach each floor; one pass, no row repeated in a shuffle."""
    counts = [F.sum((F.col(value) >= f).cast("long")).alias(f"f{i}") for i, f in enumerate(floors)]
    g = df.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *counts)
    rows = F.array(*[F.struct(F.lit(float(f)).alias("floor"), F.coalesce(F.col(f"f{i}"), F.lit(0)).alias("passed")) for i, f in enumerate(floors)])
    return g.select(*group, "total", F.explode(rows).alias("x")).select(*group, "x.floor", "x.passed", "total")
