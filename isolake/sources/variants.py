"""Line formats of annotation and variant calling: GFF3, VCF, alignment blocks and search tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.errors import ContractError

#: Feature kinds an annotation keeps.
GFF_KINDS = ("CDS", "tRNA", "rRNA", "ncRNA")


def key_values(text: Column, pair: str, kv: str = "=") -> Column:
    """Map of `k=v` parts; the last of repeated keys wins, parts without a sign map to an empty text."""
    parts = F.filter(F.split(text, pair), lambda p: F.trim(p) != "")
    entries = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, kv, 1)).alias("k"), F.when(F.instr(p, kv) > 0, F.substr(p, F.instr(p, kv) + len(kv))).otherwise("").alias("v")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["k"] == e["k"]))
    return F.map_from_entries(last)


def gff_decode(text: Column) -> Column:
    for code, sign in (("%2C", ","), ("%3B", ";"), ("%3D", "=")):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def parse_gff(lines: DataFrame, kinds: Sequence[str] = GFF_KINDS) -> DataFrame:
    """(contig, kind, start, end, strand, name, attributes) of GFF3 lines (column value); name is gene, locus_tag, ID or Name."""
    c = F.split("value", "\t")
    f = lines.where(~F.col("value").startswith("#")).select(c.alias("c")).where(F.size("c") >= 9)
    a = f.select(F.col("c")[0].alias("contig"), F.col("c")[2].alias("kind"), F.col("c")[3].try_cast("long").alias("start"), F.col("c")[4].try_cast("long").alias("end"), F.col("c")[6].alias("strand"), key_values(F.col("c")[8], ";").alias("attributes"))
    name = F.coalesce(*[gff_decode(F.try_element_at("attributes", F.lit(k))) for k in ("gene", "locus_tag", "ID", "Name")])
    return a.where(F.col("kind").isin(*kinds)).select("contig", "kind", "start", "end", "strand", name.alias("name"), "attributes")


def gene_intervals(lines: DataFrame, locus_tags: Sequence[str] | DataFrame) -> DataFrame:
    """(locus_tag, contig, start, end, strand) of wanted genes; a tag that is not there is refused.

    The tags are a list or, where there may be many, a frame with the column locus_tag.
    """
    tags = locus_tags if isinstance(locus_tags, DataFrame) else lines.sparkSession.createDataFrame([(t,) for t in locus_tags], "locus_tag string")
    tags = tags.select("locus_tag").distinct()
    g = parse_gff(lines, ("gene",)).withColumn("locus_tag", F.try_element_at("attributes", F.lit("locus_tag"))).join(tags, "locus_tag", "left_semi")
    lost = tags.join(g, "locus_tag", "left_anti").orderBy("locus_tag").limit(10).collect()
    if lost:
        raise ContractError(f"locus tags not found: {[r[0] for r in lost]}")
    return g.select("locus_tag", "contig", "start", "end", "strand")


def parse_vcf(lines: DataFrame) -> DataFrame:
    """One row an alternate allele of VCF lines (column value, others kept): chrom, pos, ref, alt, qual, filter, GT, AC, AN, DP4, MQ, MQ0F.

    Records without alternate (`.`) give none; a position that is no number is refused when its row is read.
    """
    keep = [c for c in lines.columns if c != "value"]
    f = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(*keep, F.split("value", "\t").alias("c"))
    pos = F.coalesce(F.get("c", F.lit(1)).try_cast("long"), F.raise_error(F.concat(F.lit("no position: "), F.array_join("c", " "))).cast("long"))
    dot = lambda i: F.nullif(F.get("c", F.lit(i)), F.lit("."))
    g = f.select(*keep, F.col("c")[0].alias("chrom"), pos.alias("pos"), F.get("c", F.lit(3)).alias("ref"), F.get("c", F.lit(4)).alias("alts"), dot(5).try_cast("double").alias("qual"), dot(6).alias("filter"), key_values(F.coalesce(F.get("c", F.lit(7)), F.lit("")), ";").alias("info"), F.substring_index(F.get("c", F.lit(9)), ":", 1).alias("GT"))
    info = lambda k: F.try_element_at("info", F.lit(k)).alias(k)
    return g.select(*keep, "chrom", "pos", "ref", F.explode(F.split("alts", ",")).alias("alt"), "qual", "filter", "GT", *[info(k) for k in ("AC", "AN", "DP4", "MQ", "MQ0F")]).where("alt <> '.'")


def per_sample(spark: SparkSession, path: str, manifest: DataFrame, suffix: str) -> DataFrame:
    """Text lines of `<sample><suffix>` files with their sample; a manifest sample without a file is refused (an empty file is not)."""
    files = spark.read.format("binaryFile").load(f"{path}/*{suffix}").select(F.regexp_extract("path", r"([^/]+)" + suffix.replace(".", r"\.") + "$", 1).alias("sample_id"))
    lost = manifest.select("sample_id").join(files, "sample_id", "left_anti").orderBy("sample_id").limit(10).collect()
    if lost:
        raise ContractError(f"no file for {[r[0] for r in lost]}")
    lines = spark.read.text(f"{path}/*{suffix}").select(F.regexp_extract(F.input_file_name(), r"([^/]+)" + suffix.replace(".", r"\.") + "$", 1).alias("sample_id"), "value")
    return lines.join(manifest.select("sample_id"), "sample_id", "left_semi")


def parse_table(lines: DataFrame, columns: Sequence[tuple[str, str]], strict: bool = False, sep: str = "\t") -> DataFrame:
    """Headerless typed tables (alignment blocks, search hits): rows with too few cells or cells of the wrong type are skipped, or refused if `strict`."""
    c = F.split("value", sep)
    f = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(c.alias("c"))
    cells = [F.get("c", F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(columns)]
    good = (F.size("c") == len(columns)) if strict else (F.size("c") >= len(columns))
    for i, (_, t) in enumerate(columns):
        if t != "string":
            good = good & F.get("c", F.lit(i)).try_cast(t).isNotNull()
    if strict:
        good = F.coalesce(good, F.lit(False)) | F.coalesce(F.raise_error(F.concat(F.lit("bad row: "), F.array_join("c", " "))).cast("boolean"), F.lit(False))
    return f.where(good).select(*cells)


BLOCK_COLUMNS = (("r_start", "long"), ("r_end", "long"), ("q_start", "long"), ("q_end", "long"), ("r_len", "long"), ("q_len", "long"), ("identity", "double"), ("r_size", "long"), ("q_size", "long"), ("r_name", "string"), ("q_name", "string"))
HIT_COLUMNS = (("query", "string"), ("subject", "string"), ("identity", "double"), ("length", "long"), ("coverage", "double"), ("start", "long"), ("end", "long"))


def database_headers(lines: DataFrame) -> DataFrame:
    """(accession, factor, category) of header lines such as `>VFG01(gb|X) (lasB) elastase [LasB (VF01) - Exotoxin (VFC02)]`.

    The accession reaches to the first blank, without a source such as `(gb|X)` at its end; other brackets are part of it.
    """
    v = F.col("value")
    accession = F.regexp_replace(F.regexp_extract(v, r"^>(\S+)", 1), r"\([^()|]+\|[^()]*\)$", "")
    factor = F.nullif(F.regexp_extract(v, r"^>\S+\s.*?\(([A-Za-z0-9/_-]+)\) ", 1), F.lit(""))
    return lines.where(v.startswith(">")).select(accession.alias("accession"), factor.alias("factor"), F.nullif(F.trim(F.regexp_extract(v, r" - ([^\](]+)", 1)), F.lit("")).alias("category"))
