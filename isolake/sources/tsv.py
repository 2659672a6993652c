"""Tab-separated tables: a strict reader, and a writer with a comment banner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.errors import ContractError
from isolake.functions.scalars import TSV_NULLS, clean_cell, format_cell
from isolake.operators.guards import require_columns, require_unique


def read_tsv(spark: SparkSession, path: str, required: Sequence[str] = (), unique: Sequence[str] = (), unique_together: Sequence[str] = (), comment: str = "#", sep: str = "\t", nulls: Sequence[str] = TSV_NULLS, allow_empty: bool = False) -> DataFrame:
    """All-string columns by the first line that is no comment; other files under `path` must have the same header.

    Cells are trimmed and null words become null. Blank and comment lines are skipped, short rows padded with null. Refused: no
    header, a repeated or missing column, a row longer than the header, a table without rows (unless allowed), repeated keys.
    """
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith(comment))
    first = lines.take(1)
    if not first:
        raise ContractError(f"{path}: empty")
    header = [h.strip() for h in first[0][0].split(sep)]
    twice = sorted({h for h in header if header.count(h) > 1})
    if twice:
        raise ContractError(f"{path}: repeated columns {twice}")
    rows = lines.where(F.col("value") != first[0][0]).select("value", F.split("value", sep).alias("cells"))
    state = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("cells")).alias("most"), F.max_by(F.substring("value", 1, 120), F.size("cells")).alias("longest")).first()
    if state.n == 0 and not allow_empty:
        raise ContractError(f"{path}: a header without rows")
    if (state.most or 0) > len(header):
        raise ContractError(f"{path}: a row has {state.most} cells, the header {len(header)}: {state.longest!r}")
    df = rows.select(*[clean_cell(F.get("cells", F.lit(i)), nulls).alias(h) for i, h in enumerate(header)])
    require_columns(df, required)
    for k in unique:
        require_unique(df, [k], path)
    return require_unique(df, unique_together, path) if unique_together else df


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None, banner: Sequence[str] = (), order: Sequence[str] = ()) -> None:
    """Write a small table as one text file: `# ` banner lines, header, then formatted rows in `order`."""
    spark = df.sparkSession
    cols = list(columns or df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    body = df.select(F.concat_ws("\t", *[format_cell(F.col(f"`{c}`"), kinds[c]) for c in cols]).alias("value"), *[F.col(f"`{o}`").alias(f"__{i}") for i, o in enumerate(order)])
    head = [*(f"# {b}" for b in banner), "\t".join(cols)]
    top = spark.createDataFrame([(i, h) for i, h in enumerate(head)], "n int, value string")
    keys = [f"__{i}" for i in range(len(order))]
    out = top.select(F.lit(0).alias("part"), "n", "value", *[F.lit(None).cast(body.schema[k].dataType).alias(k) for k in keys]).unionByName(body.select(F.lit(1).alias("part"), F.lit(0).alias("n"), "value", *keys))
    out.repartition(1).sortWithinPartitions("part", "n", *keys, "value").select("value").write.mode("overwrite").text(path)


def stream_tsv(spark: SparkSession, path: str, columns: Sequence[str], comment: str = "#", sep: str = "\t", nulls: Sequence[str] = TSV_NULLS, files_per_batch: int = 100) -> DataFrame:
    """Rows of the tab-separated files under a folder as they arrive. Every file begins with the header `columns`; comments, headers and blank lines are left out.

    Short rows are padded with null; a row with more cells than columns fails the batch that holds it.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    rows = lines.where((F.trim("value") != "") & ~F.col("value").startswith(comment) & (F.col("value") != sep.join(columns))).select("value", F.split("value", sep).alias("cells"))
    whole = F.when(F.size("cells") <= len(columns), F.col("cells")).otherwise(F.raise_error(F.concat(F.lit("more cells than columns: "), F.substring("value", 1, 120))).cast("array<string>"))
    return rows.select(whole.alias("cells")).select(*[clean_cell(F.get("cells", F.lit(i)), nulls).alias(c) for i, c in enumerate(columns)])
