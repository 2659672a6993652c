"""Guards: checks that must hold before a plan goes on. Each takes one small action and raises with up to ten offenders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isolake.errors import ContractError, DuplicateKeyError, LimitError, MismatchError


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "rows") -> DataFrame:
    """The frame, if no key occurs twice and no composite key is null in part."""
    require_columns(df, keys)
    if len(keys) > 1:
        some = [F.col(k).isNull().cast("int") for k in keys]
        nulls = sum(some[1:], some[0])
        if not df.where((nulls > 0) & (nulls < len(keys))).isEmpty():
            raise DuplicateKeyError(f"{what}: a key of {', '.join(keys)} is null in part")
    twice = df.where(" OR ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).count().where("count > 1").orderBy(*keys).limit(10).collect()
    if twice:
        raise DuplicateKeyError(f"{what}: repeated keys {[tuple(r[k] for k in keys) for r in twice]}")
    return df


def limited_names(df: DataFrame, column: str, most: int = 10_000) -> list[str]:
    """The distinct values of a column in order, for a wide table that has a column each; more than `most` are refused."""
    names = [r[0] for r in df.select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(names) > most:
        raise LimitError(f"more than {most} values of {column} are too many columns")
    return names


def require_vocabulary(df: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*words)).select(column).distinct().orderBy(column).limit(10).collect()
    if bad:
        raise ContractError(f"{column}: unknown values {[r[0] for r in bad]}")
    return df


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys on one side only; null keys are left out."""
    a, b = left.select(key).where(F.col(key).isNotNull()).distinct(), right.select(key).where(F.col(key).isNotNull()).distinct()
    return a.join(b, key, "left_anti").select(key, F.lit("left").alias("side")).unionByName(b.join(a, key, "left_anti").select(key, F.lit("right").alias("side")))


def require_same_keys(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str] = ("left", "right")) -> None:
    """Refuse unless both sides hold the same keys, none of them twice."""
    require_unique(left, [key], names[0])
    require_unique(right, [key], names[1])
    off = set_difference(left, right, key).orderBy("side", key).limit(10).collect()
    if off:
        raise MismatchError("; ".join(f"{r[0]} only in {names[0] if r['side'] == 'left' else names[1]}" for r in off))


def require_subset(child: DataFrame, parent: DataFrame, key: str, what: str = "keys") -> DataFrame:
    unknown = child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti").select(key).distinct().orderBy(key).limit(10).collect()
    if unknown:
        raise MismatchError(f"{what}: unknown {[r[0] for r in unknown]}")
    return child


def require_sum(df: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """The frame, with each row checked while it is read: the parts must sum to the total."""
    ok = sum((F.col(p) for p in parts[1:]), F.col(parts[0])) == F.col(total)
    return df.withColumn(total, F.when(ok, F.col(total)).otherwise(F.raise_error(F.concat(F.lit(f"parts do not sum to {total}: "), F.coalesce(F.col(total).cast("string"), F.lit("null"))))))
