"""Pages of an ordered table, and ordered probes for where the tables lie."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.operators.windows import numbered
from isolake.session import exists


def write_pages(df: DataFrame, order: Sequence[Column | str], path: str) -> None:
    """Write a table in an order with the number of each row (from 1), so that a page is found by number.

    Rows lie in files by ranges of their number; a page read skips the files and row groups whose numbers lie elsewhere.
    """
    rows = numbered(df, order, "page_row")
    rows.repartitionByRange("page_row").sortWithinPartitions("page_row").write.mode("overwrite").parquet(path)


def read_page(spark: SparkSession, path: str, offset: int, limit: int) -> DataFrame:
    """`limit` rows after `offset`, in order; the filter is pushed to the scan. Beyond the end there are fewer or none."""
    return spark.read.parquet(path).where((F.col("page_row") > offset) & (F.col("page_row") <= offset + limit)).orderBy("page_row")


@dataclass(frozen=True)
class Probe:
    """A place where tables may lie, and how looking there ended: matched, not given, absent or incomplete."""

    order: int
    name: str
    path: str | None
    outcome: str


def detect(spark: SparkSession, places: Sequence[tuple[str, str | None]], required: Sequence[str]) -> tuple[str | None, list[Probe]]:
    """(path of the first place that holds all required tables, every probe in order with its outcome)."""
    probes, found = [], None
    for i, (name, path) in enumerate(places, 1):
        if not path:
            outcome = "not given"
        elif not exists(spark, path):
            outcome = "absent"
        elif lost := [t for t in required if not exists(spark, f"{path}/{t}")]:
            outcome = f"incomplete: no {', '.join(lost)}"
        else:
            outcome = "matched"
            found = found or path
        probes.append(Probe(i, name, path, outcome))
    return found, probes
