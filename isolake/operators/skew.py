"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: Sequence[str], rows_per_task: int) -> DataFrame:
    """Keys with more rows than one task should take, with the number of salts each needs.

    Counts are pre-aggregated; there are at most rows / rows_per_task hot keys.
    """
    return (
        df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > rows_per_task)
        .select(*key, F.ceil(F.col("__n") / rows_per_task).cast("int").alias("__salts"))
    )


def salted_join(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner", rows_per_task: int = 2_000_000, spread: Column | None = None, counts: DataFrame | None = None) -> DataFrame:
    """`left` joined to `right` on equal `key` columns, with hot keys of `left` spread over several tasks.

    The rows of a hot key on the left get a salt; the matching rows on the right are repeated once per salt. Other keys
    have the single salt 0. `counts` (key, n), with n at least the rows a key has on the left, saves counting them. What is broadcast is the list of hot keys, at most one per `rows_per_task` rows of `left`. `spread` decides the salt within a key (default: a hash of the whole row); `how` is inner,
    left, left_semi or left_anti. Null keys match nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if counts is None:
        hot = hot_keys(left, key, rows_per_task)
    else:
        hot = counts.where(F.col("n") > rows_per_task).select(*key, F.ceil(F.col("n") / rows_per_task).cast("int").alias("__salts"))
    hot = F.broadcast(hot)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]) if spread is None else spread
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    a = left.join(hot, list(key), "left").withColumn("__salt", F.pmod(spread, salts).cast("int")).drop("__salts")
    b = right.join(hot, list(key), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return a.join(b, [*key, "__salt"], how).drop("__salt")
