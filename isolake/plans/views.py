"""The test tables as cohort tables: a manifest of samples, calls, presence and phenotypes, in DataFrames and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.functions.scalars import null_if_in, trim_blanks

MISSING = ("", ".", "NA", "MISSING")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sample_metadata").select("sample_id", "lineage", "data_class", "registered_at", "withdrawn_at").where("sample_id IS NOT NULL").distinct()


def presence(spark: SparkSession, sf: str) -> DataFrame:
    """(gene, sample_id) of genes present."""
    p = table(spark, sf, "gene_presence_absence").where("present = 1")
    return p.select(trim_blanks("gene").alias("gene"), trim_blanks("sample_id").alias("sample_id")).where("gene IS NOT NULL AND sample_id IS NOT NULL").distinct()


def calls(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Calls with their id, whole-row copies once. Only the named columns (all if none is) are read: rows are told apart by call_id."""
    t = table(spark, sf, "amr_determinants")
    c = t.select(*[x for x in ("call_id", *columns) if x in t.columns]).distinct() if columns else t.distinct()
    return c.withColumns({x: trim_blanks(x) for x in ("sample_id", "gene") if x in c.columns})


def phenotypes(spark: SparkSession, sf: str) -> DataFrame:
    """(sample_id, antibiotic, phenotype), one call a sample."""
    m = table(spark, sf, "pilot100_manifest").select("Isolate", "Antibiotic", "AST_phenotype").distinct()
    return m.select(F.col("Isolate").alias("sample_id"), null_if_in(F.col("Antibiotic"), MISSING).alias("antibiotic"), null_if_in(F.col("AST_phenotype"), MISSING).alias("phenotype"))


B = r"e' \t\r\n'"
VIEWS = f"""
WITH samples AS (SELECT DISTINCT sample_id, lineage, data_class, registered_at, withdrawn_at FROM sample_metadata WHERE sample_id IS NOT NULL),
presence AS (SELECT DISTINCT trim(gene, {B}) AS gene, trim(sample_id, {B}) AS sample_id FROM gene_presence_absence
    WHERE present = 1 AND gene IS NOT NULL AND sample_id IS NOT NULL),
calls AS (SELECT DISTINCT * REPLACE (trim(sample_id, {B}) AS sample_id, trim(gene, {B}) AS gene) FROM amr_determinants),
phenotypes AS (SELECT DISTINCT Isolate AS sample_id, CASE WHEN Antibiotic NOT IN ('', '.', 'NA', 'MISSING') THEN Antibiotic END AS antibiotic,
    CASE WHEN AST_phenotype NOT IN ('', '.', 'NA', 'MISSING') THEN AST_phenotype END AS phenotype FROM pilot100_manifest)
"""


class Catalogue:
    """Collects queries with their SQL. SQL that begins with a comma or SELECT is put behind the views."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracle: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable:
        def register(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.oracle[f.__name__] = VIEWS + sql if sql.lstrip()[:1] == "," or sql.lstrip()[:6].upper() == "SELECT" else sql
            return f

        return register
