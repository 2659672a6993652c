"""Declared contracts of tables: all checks of a table run as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isolake.errors import ContractError
from isolake.functions.scalars import TSV_NULLS


@dataclass(frozen=True)
class Contract:
    columns: Sequence[str]
    min_rows: int = 1
    filled: Sequence[str] = ()
    key: str | None = None
    samples: int | None = None
    numeric: Sequence[str] = ()
    varied: Sequence[str] = ()


def verdicts(df: DataFrame, contract: Contract) -> DataFrame:
    """(check, subject, ok, found): header, rows, real values, sample count, numbers and varied columns, from one pass."""
    spark = df.sparkSession
    out = [("columns", ",".join(contract.columns), list(df.columns) == list(contract.columns), ",".join(df.columns))]
    text = lambda c: F.lower(F.btrim(F.col(f"`{c}`").cast("string")))
    real = lambda c: F.coalesce(~text(c).isin(*TSV_NULLS), F.lit(False))
    there = set(df.columns)
    aggs = {"rows": F.count(F.lit(1))}
    aggs |= {f"filled:{c}": F.count_if(real(c)) for c in contract.filled if c in there}
    aggs |= {f"numeric:{c}": F.count_if(real(c) & text(c).try_cast("double").isNull()) for c in contract.numeric if c in there}
    aggs |= {f"varied:{c}": F.countDistinct(f"`{c}`") for c in contract.varied if c in there}
    if contract.key and contract.key in there:
        aggs["samples"] = F.countDistinct(f"`{contract.key}`")
    row = df.agg(*[v.alias(k) for k, v in aggs.items()]).first().asDict()
    out.append(("min_rows", str(contract.min_rows), row["rows"] >= contract.min_rows, str(row["rows"])))
    for k, n in row.items():
        kind, _, c = k.partition(":")
        if kind == "filled":
            out.append((kind, c, n > 0, str(n)))
        elif kind == "numeric":
            out.append((kind, c, n == 0, str(n)))
        elif kind == "varied":
            out.append((kind, c, n > 1, str(n)))
        elif kind == "samples" and contract.samples is not None:
            out.append((kind, contract.key, n == contract.samples, str(n)))
    return spark.createDataFrame(out, "check string, subject string, ok boolean, found string")


def enforce(df: DataFrame, contract: Contract, name: str = "table") -> DataFrame:
    bad = verdicts(df, contract).where("NOT ok").collect()
    if bad:
        raise ContractError(f"{name}: " + "; ".join(f"{r['check']} {r['subject']}: found {r['found']}" for r in bad))
    return df


def distinct_siblings(spark, path: str, least: int) -> DataFrame:
    """One row: files under a path, distinct contents (by SHA-256), and whether there are at least `least` of those. Empty files are not counted."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select(F.sha2("content", 256).alias("h")).agg(F.count(F.lit(1)).alias("files"), F.countDistinct("h").alias("contents")).withColumn("ok", F.col("contents") >= least)
