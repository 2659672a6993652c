"""Aggregations over cohort tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isolake.errors import ContractError
from isolake.operators.joins import product


def base_counts(sequences: DataFrame, group: Sequence[str], seq: str = "seq") -> DataFrame:
    """Per group: sequences, total size, largest, GC percent of called bases (4 digits), bases other than ACGT."""
    s = F.upper(seq)
    n = lambda letters: F.length(s) - F.length(F.translate(s, letters, ""))
    g = sequences.groupBy(*group).agg(
        F.count(F.lit(1)).alias("contigs"), F.sum(F.length(s)).alias("size"), F.max(F.length(s)).alias("largest"), F.sum(n("GC")).alias("gc"), F.sum(n("ACGT")).alias("called"),
    )
    return g.select(*group, "contigs", "size", "largest", F.round(F.try_divide(100.0 * F.col("gc"), F.col("called")), 4).alias("gc_percent"), (F.col("size") - F.col("called")).alias("ambiguous"))


def nxx(lengths: DataFrame, group: Sequence[str], length: str, fraction: float, name: str) -> DataFrame:
    """Per group the greatest length such that pieces at least as long hold the fraction of the total (N50 for 0.5).

    Lengths are counted first, so the window runs over distinct lengths only.
    """
    d = lengths.where(F.col(length).isNotNull()).groupBy(*group, length).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group).orderBy(F.desc(length))
    total = F.sum(F.col(length) * F.col("__n")).over(Window.partitionBy(*group))
    run = F.sum(F.col(length) * F.col("__n")).over(w)
    return d.withColumn("__ok", run >= total * fraction).where("__ok").groupBy(*group).agg(F.max(length).alias(name))


def variant_merge(alleles: DataFrame, site: Sequence[str], n_samples: int, max_maf: float = 1.0, min_ac: int = 2) -> DataFrame:
    """Alleles of all samples merged: ac samples carry it, an is the cohort; kept with ac >= min_ac and af <= min(max_maf, 1 - 2/N)."""
    ceiling = min(max_maf, 1 - 2.0 / n_samples) if n_samples else 0.0
    m = alleles.select(*site, "sample_id").distinct().groupBy(*site).agg(F.count(F.lit(1)).alias("ac"))
    return m.withColumn("an", F.lit(n_samples)).withColumn("af", F.col("ac") / float(max(n_samples, 1))).where((F.col("ac") >= min_ac) & (F.col("af") <= ceiling))


def crosstab(features: DataFrame, categories: DataFrame, key: str = "sample_id", feature: str = "feature", category: str = "category", max_cells: int = 1_000_000_000) -> DataFrame:
    """(feature, category, carriers, total) for all features and categories, zero cells kept; totals are samples of a category.

    The grid of all features and categories is the result; its size is checked.
    """
    c = categories.select(key, category).where(F.col(category).isNotNull()).distinct()
    totals = c.groupBy(category).agg(F.countDistinct(key).alias("total"))
    pairs = features.select(feature, key).distinct()
    names = pairs.select(feature).distinct()
    counts = pairs.join(c, key).groupBy(feature, category).agg(F.count(F.lit(1)).alias("carriers"))
    every = product(names, totals.select(category), max_cells)
    return every.join(counts, [feature, category], "left").join(totals, category).select(feature, category, F.coalesce("carriers", F.lit(0)).alias("carriers"), "total")


def combinations(sets: DataFrame, key: str, name: str, max_names: int = 16) -> DataFrame:
    """(combination, samples) for every non-empty subset of each sample's names. Refused beyond `max_names` distinct names."""
    if (n := sets.select(name).distinct().count()) > max_names:
        raise ContractError(f"{n} names have too many combinations (limit {max_names})")
    s = sets.where(F.col(name).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(name)).alias("__s"))
    masks = F.explode(F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("__s")) - 1))
    picked = s.withColumn("__m", masks).select(F.filter("__s", lambda x, i: F.call_function("getbit", F.col("__m").cast("long"), i) == 1).alias("__p"))
    return picked.groupBy(F.array_join("__p", "+").alias("combination")).agg(F.count(F.lit(1)).alias("samples"))


def distribution_map(df: DataFrame, key: Sequence[str], value: str, name: str, unknown: str = "unknown") -> DataFrame:
    """Per key a map value -> count; nulls are counted under a word."""
    v = F.coalesce(F.col(value), F.lit(unknown))
    c = df.groupBy(*key, v.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return c.groupBy(*key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__v", "__n")))).alias(name))


def max_by_rank(df: DataFrame, keys: Sequence[str], status: str, order: Sequence[str], name: str) -> DataFrame:
    """Per key the status that ranks highest in `order` (highest first); unknown words rank last."""
    words = F.array(*[F.lit(x) for x in order])
    rank = F.coalesce(F.nullif(F.array_position(words, F.col(status)), F.lit(0)), F.lit(len(order) + 1))
    return df.groupBy(*keys).agg(F.min(rank).alias("__r")).select(*keys, F.get(words, (F.col("__r") - 1).cast("int")).alias(name))


def clade_means(edges: DataFrame, node: str = "node", parent: str = "parent", length: str = "length") -> DataFrame:
    """Per node the mean length of all edges in its clade, its own included, over the ancestor closure of the tree."""
    up = ancestors(edges, node, parent)
    return up.join(edges.select(F.col(node).alias("below"), F.col(length)), "below").where(F.col(length).isNotNull()).groupBy(F.col("above").alias(node)).agg(F.avg(length).alias("mean_length"), F.count(F.lit(1)).alias("edges"))


def ancestors(edges: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(below, above, steps): each node with itself and all nodes above it, by doubling: log2(depth) joins, whatever the depth.

    No path is longer than there are nodes; if one goes on beyond that, the edges hold a cycle and are refused.
    """
    from isolake.session import materialise

    hop = edges.select(F.col(node).alias("below"), F.col(parent).alias("above"), F.lit(1).alias("steps")).where("above IS NOT NULL")
    closure = edges.select(F.col(node).alias("below"), F.col(node).alias("above"), F.lit(0).alias("steps")).unionByName(hop)
    reach, jump, nodes = 1, hop, edges.count()
    while True:
        longer = jump.alias("a").join(jump.alias("b"), F.col("a.above") == F.col("b.below")).select("a.below", "b.above", (F.col("a.steps") + F.col("b.steps")).alias("steps"))
        jump = materialise(longer, "tree")
        if jump.isEmpty():
            return closure
        if reach > nodes:
            raise ContractError("the tree has a cycle")
        more = closure.alias("a").join(jump.alias("b"), F.col("a.above") == F.col("b.below")).select("a.below", "b.above", (F.col("a.steps") + F.col("b.steps")).alias("steps"))
        closure = materialise(closure.unionByName(more).distinct(), "tree")
        reach *= 2


def segregating_columns(alignment: DataFrame, key: str = "header", seq: str = "seq", floor: float = 0.0, n: int | None = None) -> DataFrame:
    """(pos, bases, covered): alignment columns with more than one observed base, gaps and N ignored, covered by at least a share of the sequences."""
    sites = alignment.select(key, F.posexplode(F.split(F.upper(seq), "")).alias("i", "base")).where("base IN ('A','C','G','T')")
    total = F.lit(n) if n is not None else alignment.agg(F.count(F.lit(1))).scalar()
    g = sites.groupBy((F.col("i") + 1).alias("pos")).agg(F.array_join(F.array_sort(F.collect_set("base")), "").alias("bases"), F.count(F.lit(1)).alias("covered"))
    return g.where((F.length("bases") > 1) & (F.col("covered") >= F.round(total * floor)))


def throughput(runs: DataFrame, group: Sequence[str], start: str, end: str, min_finished: int = 3) -> DataFrame:
    """Per group: finished runs, span in seconds from first start to last end, runs per hour (null below `min_finished`), median duration."""
    seconds = lambda a, b: (F.unix_micros(b) - F.unix_micros(a)) / 1e6
    g = runs.groupBy(*group).agg(
        F.count(end).alias("finished"), seconds(F.min(start), F.max(end)).alias("span_s"), F.percentile(F.when(F.col(end).isNotNull(), seconds(F.col(start), F.col(end))), F.lit(0.5)).alias("median_s")
    )
    return g.withColumn("per_hour", F.when(F.col("finished") >= min_finished, F.try_divide(3600.0 * F.col("finished"), F.col("span_s"))))


def pattern_count(presence: DataFrame, feature: str, key: str) -> DataFrame:
    """One row: how many distinct sets of carriers the features have. Sets are compared by a 128-bit sum of hashes of their members.

    The sum is order-free and partial sums add up, so no carrier list is ever gathered.
    """
    p = presence.select(feature, key).distinct()
    h1, h2 = F.xxhash64(key, F.lit(1)).cast("decimal(38,0)"), F.xxhash64(key, F.lit(2)).cast("decimal(38,0)")
    sig = p.groupBy(feature).agg(F.sum(h1).alias("h1"), F.sum(h2).alias("h2"), F.count(F.lit(1)).alias("n"))
    return sig.agg(F.countDistinct("h1", "h2", "n").alias("patterns"), F.count(F.lit(1)).alias("features"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n) without nulls and blanks; with `top` the most frequent (ties by value) and a last row (null, rest) of what is left out."""
    v = F.btrim(F.col(column).cast("string"), F.lit(" \t\r\n"))
    c = df.select(v.alias("value")).where("value <> ''").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    if top is None:
        return c
    head = c.orderBy(F.desc("n"), "value").limit(top)
    rest = c.join(head.select("value"), "value", "left_anti").agg(F.lit(None).cast("string").alias("value"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return head.unionByName(rest)


