"""Sequence files: FASTA in and out, and a probe of file integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.errors import ContractError


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, seq) of every record; sequences are joined over lines and upper case.

    Records are split at a `>` that begins a line, so large files are read in parallel and headers may hold that sign. Refused: no record, an empty
    header, a sequence before the first header, bytes that are no UTF-8.
    """
    chunks = spark.read.option("lineSep", "\n>").text(path).select(F.input_file_name().alias("file"), F.regexp_replace("value", "\r", "").alias("value"), F.is_valid_utf8("value").alias("utf8"))
    chunks = chunks.withColumn("value", F.regexp_replace("value", "^\\s*>", ""))
    parts = chunks.where(~F.col("utf8") | (F.trim(F.regexp_replace("value", "\n", " ")) != "")).select("file", F.split("value", "\n", 2).alias("p"), "utf8")
    recs = parts.select("file", F.trim(F.col("p")[0]).alias("header"), F.upper(F.regexp_replace(F.coalesce(F.get("p", F.lit(1)), F.lit("")), r"\s", "")).alias("seq"), "utf8")
    files = spark.read.option("lineSep", "\n").text(path).select(F.input_file_name().alias("file"), "value", F.monotonically_increasing_id().alias("n")).where(F.trim("value") != "")
    starts = files.groupBy("file").agg(F.min_by("value", "n").alias("first"))
    bad = starts.where(~F.col("first").startswith(">")).limit(3).collect()
    if bad:
        raise ContractError(f"sequence before the first header in {[r.file for r in bad]}")
    state = recs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("header") == "").alias("blank"), F.count_if(~F.col("utf8")).alias("broken")).first()
    if state.n == 0:
        raise ContractError(f"{path}: no records")
    if state.broken:
        raise ContractError(f"{path}: {state.broken} records are not UTF-8")
    if state.blank:
        raise ContractError(f"{path}: {state.blank} empty headers")
    return recs.drop("utf8")


def write_fasta(df: DataFrame, path: str, header: str = "header", seq: str = "seq", width: int = 80) -> None:
    """Write (header, seq) with sequences wrapped at `width`."""
    wrapped = F.rtrim(F.regexp_replace(F.col(seq), f"(.{{{width}}})", "$1\n"))
    df.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), wrapped).alias("value")).write.mode("overwrite").text(path)


def file_integrity(spark: SparkSession, path: str, min_bytes: int = 1) -> DataFrame:
    """(file, bytes, verdict) of every file under a path; the first failing rule wins: zero_byte_file, gzip, not_fasta, undersized, ok."""
    listed = spark.createDataFrame(list_files(spark, path), "file string, bytes long")
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), F.hex(F.substring("content", 1, 2)).alias("magic"))
    j = listed.join(f, "file", "left")
    verdict = F.when(F.col("bytes") == 0, "zero_byte_file").when(F.col("magic") == "1F8B", "gzip").when(~F.coalesce(F.col("magic").startswith("3E"), F.lit(False)), "not_fasta").when(F.col("bytes") < min_bytes, "undersized").otherwise("ok")
    return j.select("file", "bytes", verdict.alias("verdict"))


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, bytes) below a path, empty files included (a scan leaves those out). Names beginning with a dot or underscore are skipped."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    it = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while it.hasNext():
        s = it.next()
        if not s.getPath().getName().startswith((".", "_")):
            out.append((s.getPath().toString(), s.getLen()))
    return out


def discover(spark: SparkSession, path: str, pattern: str = r"(GC[A-Z]_[0-9]+\.[0-9]+)") -> DataFrame:
    """(accession, file) of files whose name holds an accession."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return f.select(F.regexp_extract(name, pattern, 1).alias("accession"), F.col("path").alias("file")).where("accession <> ''")
