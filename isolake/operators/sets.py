"""Set operations, sampling and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isolake.errors import MismatchError
from isolake.operators.guards import require_subset, require_unique


def union_namespaces(*frames: DataFrame) -> DataFrame:
    """Per sample the union of several (sample_id, name) sets."""
    out = frames[0].select("sample_id", "name")
    for f in frames[1:]:
        out = out.unionByName(f.select("sample_id", "name"))
    return out.where("sample_id IS NOT NULL AND name IS NOT NULL").distinct()


def overlap_report(selected: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """One row: sizes of both sets, their overlap and what only one has."""
    s = selected.select(key).distinct().withColumn("a", F.lit(1))
    r = reference.select(key).distinct().withColumn("b", F.lit(1))
    return s.join(r, key, "full_outer").agg(
        F.count("a").alias("selected"), F.count("b").alias("reference"), F.sum(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1).otherwise(0)).alias("both"),
        F.sum(F.when(F.col("b").isNull(), 1).otherwise(0)).alias("only_selected"), F.sum(F.when(F.col("a").isNull(), 1).otherwise(0)).alias("only_reference"),
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in a stated order (nulls first); rows are compared before the shuffle, so a hot key is no burden."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    best = df.groupBy(*keys).agg(F.min_by(whole, F.struct(*[F.col(o).isNotNull().alias(f"n{i}") if j == 0 else F.col(o).alias(f"v{i}") for i, o in enumerate(order) for j in (0, 1)])).alias("__row"))
    return best.select("__row.*").select(*df.columns)


def core_partition(presence: DataFrame, n_samples: int, threshold: float = 1.0) -> DataFrame:
    """(gene, n_samples, compartment): core if the share of samples that carry a gene is at least the threshold, else accessory."""
    return presence.groupBy("gene").agg(F.countDistinct("sample_id").alias("n_samples")).withColumn(
        "compartment", F.when(F.col("n_samples") >= F.lit(float(threshold)) * n_samples, "core").otherwise("accessory")
    )


def round_robin(df: DataFrame, stratum: str, key: str, n: int) -> DataFrame:
    """`n` rows taken in turn from the strata, the largest stratum first, keys in order within a stratum; null strata are one stratum."""
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("__size"))
    w = Window.partitionBy(stratum).orderBy(key)
    r = df.join(sizes, df[stratum].eqNullSafe(sizes[stratum])).drop(sizes[stratum]).withColumn("__turn", F.row_number().over(w))
    return r.orderBy("__turn", F.desc("__size"), F.col(stratum).asc_nulls_last(), key).limit(n).drop("__turn", "__size")


def head_natural(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first `n` rows in natural order; fewer than `n` are refused."""
    out = df.orderBy(*order).limit(n)
    if (there := out.count()) < n:
        raise MismatchError(f"{n} rows asked for, {there} there")
    return out


def listed(df: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing) for a list (position, key): found rows keep their position, repeated ids are refused, missing ones are reported."""
    require_unique(ids, [key], "list")
    return ids.join(df, key).orderBy("position"), ids.join(df, key, "left_anti")


def subset(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is listed; ids that are not there are refused."""
    require_subset(ids.select(key), df, key, "subset")
    return df.join(ids.select(key).distinct(), key, "left_semi")


def without_features(values: DataFrame, manifest: DataFrame, known: DataFrame) -> DataFrame:
    """Samples of the manifest in which all known features are 0 or absent."""
    carriers = values.where("value = 1").join(known.select("feature").distinct(), "feature", "left_semi").select("sample_id").distinct()
    return manifest.select("sample_id").join(carriers, "sample_id", "left_anti")


def farthest_points(vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(ord, key): a greedy max-min sample of `k` points from the medoid, the point of least summed squared distance to all; ties go to the least key.

    That sum is, but for what is the same for all points, the squared distance to their mean times their number, so the medoid is found without
    any pair of points. Each step sends one chosen vector to the workers and reduces to one row, so no distance matrix is built.
    """
    v = vectors.select(key, F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")
    mean_row = v.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()
    center = [r.m for r in mean_row]

    def sq(to: list[float]):
        return F.aggregate(F.zip_with("v", F.array(*[F.lit(float(x)) for x in to]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)

    first = v.orderBy(F.round(sq(center), 9), key).limit(1).collect()
    chosen, near = [first[0]] if first else [], None
    while len(chosen) < k and chosen:
        d = sq(list(chosen[-1]["v"]))
        near = d if near is None else F.least(near, d)
        nxt = v.where(~F.col(key).isin(*[c[key] for c in chosen])).orderBy(F.round(near, 9).desc(), key).limit(1).collect()
        if not nxt:
            break
        chosen.append(nxt[0])
    return vectors.sparkSession.createDataFrame([(i, c[key]) for i, c in enumerate(chosen)], f"ord int, {key} {vectors.schema[key].dataType.simpleString()}")
