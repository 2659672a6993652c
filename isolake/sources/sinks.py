"""Sinks of several files at once, matrices, provenance and reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isolake.operators.guards import require_same_keys
from isolake.operators.sets import core_partition
from isolake.sources.tsv import write_tsv


def write_pangenome(presence: DataFrame, path: str, threshold: float = 1.0) -> None:
    """Long presence, core, accessory and summary tables from one pass over the presence (gene, sample_id)."""
    n = presence.select("sample_id").distinct().count()
    parts = core_partition(presence, n, threshold).cache()
    presence.withColumn("present", F.lit(1)).write.mode("overwrite").parquet(f"{path}/presence")
    for kind in ("core", "accessory"):
        parts.where(F.col("compartment") == kind).drop("compartment").write.mode("overwrite").parquet(f"{path}/{kind}")
    c = parts.groupBy(F.col("compartment").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    total = parts.agg(F.lit("total").alias("metric"), F.count(F.lit(1)).alias("value"))
    write_tsv(c.unionByName(total), f"{path}/summary", order=["metric"])
    parts.unpersist()


def write_feature_rows(features: DataFrame, manifest: DataFrame, path: str, max_samples: int = 5000) -> None:
    """Features x samples 0/1 for tools that want it: columns in manifest order, one row a feature."""
    ids = [r[0] for r in manifest.select("sample_id").distinct().orderBy("sample_id").limit(max_samples + 1).collect()]
    if len(ids) > max_samples:
        raise ValueError(f"more than {max_samples} samples")
    wide = features.where("value = 1").groupBy("feature").pivot("sample_id", ids).agg(F.max("value")).na.fill(0, ids)
    write_tsv(wide, path, ["feature", *ids], order=["feature"])


def write_layers(layers: dict[str, DataFrame], manifest: DataFrame, path: str, banner: Sequence[str] = ()) -> None:
    """One table a layer; every layer must hold exactly the samples of the manifest."""
    for name, df in layers.items():
        require_same_keys(df, manifest, "sample_id", (name, "manifest"))
    for name, df in layers.items():
        write_tsv(df, f"{path}/{name}", banner=[f"layer {name}", *banner], order=["sample_id"])


def provenance(tables: dict[str, DataFrame], **facts: str) -> str:
    """JSON of stated facts and of each table's rows, columns and an order-free content hash."""
    out = dict(facts)
    for name, df in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("hash")).first()
        out[name] = {"rows": r["rows"], "columns": df.columns, "content": None if r["hash"] is None else format(int(r["hash"]) % (1 << 64), "016x")}
    return json.dumps(out, indent=1, sort_keys=True)


def markdown(df: DataFrame, order: Sequence, top: int = 20) -> str:
    """The first rows as a table, with how many were left out."""
    total = df.count()
    rows = df.orderBy(*order).limit(top).collect()
    cell = lambda x: "." if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in rows)]
    return "\n".join(lines + ([f"{total - len(rows)} more rows"] if total > len(rows) else []))
