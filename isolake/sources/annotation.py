"""Annotation tables, summaries and tables that may be absent or empty."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.errors import ContractError
from isolake.functions.scalars import clean_cell
from isolake.session import exists

STANDARD = (
    ("sample_id", "string"), ("contig_id", "string"), ("gene_id", "string"), ("gene_name", "string"), ("product", "string"),
    ("gene_type", "string"), ("start", "long"), ("end", "long"), ("strand", "string"), ("annotation_source", "string"),
)


def read_commented_table(spark: SparkSession, path: str) -> DataFrame:
    """A table whose header may be the last comment line before the rows; tabs or commas, whichever the header has more of."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    at = lines.select("value", F.monotonically_increasing_id().alias("n"), F.col("value").startswith("#").alias("comment"))
    first = at.where("NOT comment").agg(F.min("n").alias("n"), F.min_by("value", "n").alias("value")).first()
    if first.n is None:
        raise ContractError(f"{path}: no rows")
    head = at.where(F.col("comment") & (F.col("n") < first.n)).agg(F.max_by("value", "n").alias("value")).first().value  # however long the banner
    rows = lines.where(~F.col("value").startswith("#"))
    sep = "\t" if first.value.count("\t") >= first.value.count(",") else ","
    inside = head is not None and head.count(sep) == first.value.count(sep)
    header = [h.strip() for h in (head.lstrip("# ") if inside else first.value).split(sep)]
    if not inside:
        rows = rows.where(F.col("value") != first.value)
    cells = F.split("value", "\\t" if sep == "\t" else sep)
    return rows.select(*[clean_cell(F.get(cells, F.lit(i))).alias(h) for i, h in enumerate(header)])


def standardise(annotation: DataFrame, names: dict[str, str], source: str) -> DataFrame:
    """The ten standard columns; columns that are not there are null and so are numbers that cannot be read."""
    def column(name: str, kind: str):
        there = names.get(name, name)
        c = F.col(f"`{there}`") if there in annotation.columns else F.lit(None).cast("string")
        return (F.lit(source) if name == "annotation_source" else c.try_cast(kind)).alias(name)

    return annotation.select(*[column(n, k) for n, k in STANDARD])


def checked_summary(summary: DataFrame, metric: str, value: str, total: str) -> DataFrame:
    """A (metric, value) table whose parts must sum to its total; refused otherwise."""
    r = summary.agg(F.sum(F.when(F.col(metric) != total, F.col(value).cast("long"))).alias("parts"), F.max(F.when(F.col(metric) == total, F.col(value).cast("long"))).alias("total")).first()
    if r.total is None or r.parts != r.total:
        raise ContractError(f"parts sum to {r.parts}, the total is {r.total}")
    return summary


@dataclass(frozen=True)
class TableRead:
    """A table, or the reason why there is none."""

    df: DataFrame | None
    reason: str | None


def read_with_reason(spark: SparkSession, path: str, sep: str = "\t") -> TableRead:
    """Never raises: absent, empty, header_only and unreadable are told apart."""
    try:
        if not exists(spark, path):
            return TableRead(None, "absent")
        lines = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
        first = lines.take(2)
        if not first:
            return TableRead(None, "empty")
        if len(first) == 1:
            return TableRead(None, "header_only")
        header = [h.strip() for h in first[0][0].split(sep)]
        cells = F.split("value", "\\t" if sep == "\t" else sep)
        return TableRead(lines.where(F.col("value") != first[0][0]).select(*[clean_cell(F.get(cells, F.lit(i))).alias(h) for i, h in enumerate(header)]), None)
    except Exception as e:  # noqa: BLE001
        return TableRead(None, f"unreadable: {type(e).__name__}")


def association_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Hits of an association run: a header without rows means no hits, an empty file is refused."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    first = lines.take(1)
    if not first:
        raise ContractError(f"{path}: empty, not even a header")
    header = first[0][0].split("\t")
    if lost := [c for c in columns if c not in header]:
        raise ContractError(f"{path}: missing columns {lost}")
    cells = F.split("value", "\\t")
    return lines.where(F.col("value") != first[0][0]).select(*[clean_cell(F.get(cells, F.lit(header.index(c)))).alias(c) for c in columns])


def long_matrix(wide: DataFrame, key: str = "sample_id") -> DataFrame:
    """(sample_id, feature, value) of a wide 0/1 matrix with unique samples; text that is not binary counts as 0 and is flagged."""
    from isolake.operators.guards import require_unique

    require_unique(wide, [key], "matrix")
    cols = [c for c in wide.columns if c != key]
    long = wide.select(key, *[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot([key], cols, "feature", "cell")
    return long.select(key, "feature", F.when(F.trim("cell") == "1", 1).otherwise(0).alias("value"), (~F.coalesce(F.trim("cell").isin("0", "1"), F.lit(False))).alias("not_binary"))
