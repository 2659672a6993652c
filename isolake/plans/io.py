"""Queries of sources, sinks, contracts and streams (2.1, 2.2, 2.10 and 2.11 of the inventory).

Each writes the test tables in the format of the source, below the shared folder, and reads them back through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake import contracts
from isolake.functions import scalars as fn
from isolake.operators.guards import limited_names, require_same_keys
from isolake.plans.relational import _SEQS, _sequences
from isolake.plans.views import Catalogue, calls, presence, samples, table
from isolake.session import new_dir
from isolake.sources import reports, sequences, tsv, variants
from isolake.streaming import events as ev

q = Catalogue()


# 2.1 scans and parsers, 2.2 sinks


@q("SELECT call_id::VARCHAR AS call_id, sample_id, gene, CASE WHEN mechanism IS NULL THEN NULL ELSE mechanism END AS mechanism FROM calls")
def s001_strict_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "tsv")
    tsv.write_tsv(calls(spark, sf, "sample_id", "gene", "mechanism").select("call_id", "sample_id", "gene", "mechanism"), path, banner=["written by a test", "two banner lines"], order=["call_id"])
    return tsv.read_tsv(spark, path, required=["call_id", "gene"], unique=["call_id"])


@q(f", {_SEQS} SELECT 'doc' || doc_id AS header, seq FROM seqs")
def s003_fasta(spark, sf):
    path = new_dir(spark, "fasta")
    sequences.write_fasta(_sequences(spark, sf).select(F.concat(F.lit("doc"), "doc_id").alias("header"), "seq"), path)
    return sequences.read_fasta(spark, path).select("header", "seq")


@q("SELECT 'ok' AS verdict, true AS there")
def s004_file_integrity(spark, sf):
    path = new_dir(spark, "fasta")
    sequences.write_fasta(_sequences(spark, sf).select(F.concat(F.lit("doc"), "doc_id").alias("header"), "seq").coalesce(1), path)
    v = sequences.file_integrity(spark, path).where(F.endswith("file", F.lit(".txt")))
    return v.groupBy("verdict").agg((F.count(F.lit(1)) > 0).alias("there"))


_GFF = "SELECT p_brand AS contig, 'CDS' AS kind, p_partkey * 10 + 1 AS start, p_partkey * 10 + p_size AS \"end\", CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, CASE WHEN p_partkey % 3 = 0 THEN p_name || ', x' ELSE 'tag' || p_partkey END AS name FROM part"


def _gff(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    attrs = F.when(k % 3 == 0, F.concat(F.lit("ID=id"), k, F.lit(";gene="), "p_name", F.lit("%2C x"))).otherwise(F.concat(F.lit("ID=id"), k, F.lit(";locus_tag=tag"), k))
    return table(spark, sf, "part").select(F.concat_ws("\t", "p_brand", F.lit("src"), F.lit("CDS"), (k * 10 + 1).cast("string"), (k * 10 + F.col("p_size")).cast("string"), F.lit("."), F.when(k % 2 == 0, "+").otherwise("-"), F.lit("0"), attrs).alias("value"))


@q(_GFF)
def s005_gff(spark, sf):
    path = new_dir(spark, "gff")
    _gff(spark, sf).write.text(path)
    return variants.parse_gff(spark.read.text(path)).drop("attributes")


_VCF = """, v AS (SELECT p_brand AS chrom, p_partkey + 1 AS pos, 'A' AS ref, unnest(CASE WHEN p_partkey % 4 = 0 THEN ['T', 'G'] WHEN p_partkey % 7 = 0 THEN ['.'] ELSE ['C'] END) AS alt, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size::DOUBLE END AS qual, 'PASS' AS filter, '1/1' AS "GT", (p_size % 3)::VARCHAR AS "AC", '2' AS "AN", NULL::VARCHAR AS "DP4", p_size::VARCHAR AS "MQ" FROM part)"""


@q(_VCF + " SELECT * FROM v WHERE alt <> '.'")
def s009_vcf(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    alt = F.when(k % 4 == 0, "T,G").when(k % 7 == 0, ".").otherwise("C")
    info = F.concat(F.lit("AC=9;AC="), (s % 3).cast("string"), F.lit(";AN=2;INDEL;MQ="), s.cast("string"))
    lines = table(spark, sf, "part").select(F.concat_ws("\t", "p_brand", (k + 1).cast("string"), F.lit("."), F.lit("A"), alt, F.when(s % 5 == 0, ".").otherwise(s.cast("string")), F.lit("PASS"), info, F.lit("GT:DP"), F.lit("1/1:30")).alias("value"))
    path = new_dir(spark, "vcf")
    lines.write.text(path)
    return variants.parse_vcf(spark.read.text(path)).drop("MQ0F")


@q("SELECT antibiotic AS sample_id, count(*) AS n_calls FROM calls WHERE antibiotic IS NOT NULL GROUP BY 1")
def s010_per_group_files(spark, sf):
    """One folder a group, each group of the manifest must have one."""
    path = new_dir(spark, "per_group")
    c = calls(spark, sf, "sample_id", "antibiotic", "determinant").where("antibiotic IS NOT NULL").select("antibiotic", F.concat_ws("\t", "antibiotic", "determinant").alias("value"))
    c.repartition("antibiotic").write.partitionBy("antibiotic").text(path)
    lines = spark.read.text(path)
    require_same_keys(lines.select("antibiotic").distinct(), c.select("antibiotic").distinct(), "antibiotic", ("files", "manifest"))
    return lines.groupBy(F.col("antibiotic").alias("sample_id")).agg(F.count(F.lit(1)).alias("n_calls"))


@q("SELECT call_id, gene FROM calls WHERE determinant_type = 'point'")
def s011_report_rows(spark, sf):
    return reports.determinant_rows(calls(spark, sf, "gene", "determinant_type"), "point", "determinant_type").select("call_id", "gene")


@q("SELECT DISTINCT determinant, split_part(determinant, '~', 1) AS gene FROM calls WHERE determinant IS NOT NULL")
def s012_legacy_gene(spark, sf):
    return calls(spark, sf, "determinant", "gene").where("determinant IS NOT NULL").select("determinant", F.split_part("determinant", F.lit("~"), F.lit(1)).alias("gene")).distinct()


@q(r"""SELECT DISTINCT gene AS symbol, CASE WHEN regexp_matches(gene, '^(.+)_([A-Z*][0-9]+(?:[A-Z*]|fs|del|ins)?)$') THEN regexp_extract(gene, '^(.+)_([A-Z*][0-9]+(?:[A-Z*]|fs|del|ins)?)$', 1) ELSE gene END AS gene,
nullif(regexp_extract(gene, '^(.+)_([A-Z*][0-9]+(?:[A-Z*]|fs|del|ins)?)$', 2), '') AS variant FROM calls WHERE gene IS NOT NULL""")
def s013_point_split(spark, sf):
    g, v = fn.split_point_symbol(F.col("symbol"))
    return calls(spark, sf, "gene", "variant").where("gene IS NOT NULL").select(F.col("gene").alias("symbol")).distinct().select("symbol", g.alias("gene"), v.alias("variant"))


@q("SELECT call_id, CASE WHEN m IS NULL THEN 'unmapped' ELSE antibiotic END AS antibiotic, m AS mechanism FROM calls LEFT JOIN (SELECT gene AS g, min(mechanism) AS m FROM calls WHERE gene IS NOT NULL AND mechanism IS NOT NULL AND contains(gene, 'mex') GROUP BY 1) ON g = gene")
def s014_map_determinants(spark, sf):
    c = calls(spark, sf, "antibiotic", "gene", "mechanism")
    dim = c.where("gene IS NOT NULL AND mechanism IS NOT NULL").where(F.contains("gene", F.lit("mex"))).groupBy("gene").agg(F.min("mechanism").alias("mechanism"))
    return reports.map_determinants(c, dim, strict=True).select("call_id", "antibiotic", "mechanism")


@q("""SELECT c_custkey AS id, CASE WHEN known = 0 THEN 'no_call' WHEN known < 5 OR st IS NULL THEN 'partial' ELSE 'complete' END AS status, known AS known_loci, CASE WHEN known >= 5 THEN st END AS st_clean
FROM (SELECT c_custkey, (CASE WHEN c_nationkey = 0 THEN 0 ELSE c_nationkey % 7 + 1 END)::INT AS known, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey::VARCHAR END AS st FROM customer)""")
def s015_typing(spark, sf):
    k = F.when(F.col("c_nationkey") == 0, 0).otherwise(F.col("c_nationkey") % 7 + 1)
    loci = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.concat(F.lit("locus"), i.cast("string"), F.lit(":"), F.when(i <= k, i.cast("string")).otherwise("-")))
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.array_join(loci, ";").alias("alleles"), F.when(F.col("c_custkey") % 9 == 0, "-").otherwise(F.col("c_custkey").cast("string")).alias("ST"))
    return reports.typing_rows(t).select("id", "status", "known_loci", "st_clean")


@q("SELECT call_id, CASE WHEN claim_status IN ('DETECTED', 'PREDICTED') THEN lower(claim_status) ELSE 'candidate' END AS status FROM calls")
def s017_vocabulary_default(spark, sf):
    return calls(spark, sf, "claim_status").select("call_id", F.when(F.col("claim_status").isin("DETECTED", "PREDICTED"), F.lower("claim_status")).otherwise("candidate").alias("status"))


@q("SELECT identity_pct AS identity, gene AS name, call_id AS r_start FROM calls WHERE identity_pct IS NOT NULL AND gene IS NOT NULL")
def s018_block_scan(spark, sf):
    """Rows with a cell that is no number (here: a null identity) are skipped."""
    c = calls(spark, sf, "gene", "identity_pct").where("gene IS NOT NULL")
    lines = c.select(F.concat_ws("\t", F.col("call_id").cast("string"), F.coalesce(F.col("identity_pct").cast("string"), F.lit("NA")), "gene", F.lit("more")).alias("value"))
    return variants.parse_table(lines, (("r_start", "long"), ("identity", "double"), ("name", "string")))


@q("SELECT DISTINCT gene, lineage AS sample_id FROM presence JOIN samples USING (sample_id) WHERE lineage IS NOT NULL")
def s022_wide_presence(spark, sf):
    """Genes x lineages as a wide table, read back as a long one."""
    p = presence(spark, sf).join(samples(spark, sf).where("lineage IS NOT NULL").select("sample_id", "lineage").distinct(), "sample_id")
    names = limited_names(p, "lineage")
    wide = p.withColumn("cell", F.lit("x")).groupBy("gene").pivot("lineage", names).agg(F.max("cell"))
    path = new_dir(spark, "wide")
    wide.write.option("header", "true").csv(path)
    return reports.wide_presence(spark.read.option("header", "true").csv(path), "gene", names)


@q(r"SELECT trim(gene, e' \t\r\n') AS gene, count(DISTINCT CASE WHEN present = 1 THEN sample_id END) AS carriers FROM gene_presence_absence WHERE gene IS NOT NULL GROUP BY 1")
def s024_long_presence(spark, sf):
    g = table(spark, sf, "gene_presence_absence").where("gene IS NOT NULL")
    return g.groupBy(fn.trim_blanks("gene").alias("gene")).agg(F.countDistinct(F.when(F.col("present") == 1, F.col("sample_id"))).alias("carriers"))


@q("SELECT 't' || r_regionkey AS tree_id, n_name AS label, (n_nationkey + 1) / 2.0::DOUBLE AS length FROM nation JOIN region ON n_regionkey = r_regionkey")
def s026_newick(spark, sf):
    n = table(spark, sf, "nation").withColumn("tip", F.concat("n_name", F.lit(":"), ((F.col("n_nationkey") + 1) / 2).cast("string")))
    t = n.groupBy(F.concat(F.lit("t"), "n_regionkey").alias("tree_id")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("tip")), ","), F.lit(")root;")).alias("newick"))
    return reports.trees(t).where("is_tip").select("tree_id", "label", "length")


@q()
def s030_antibiogram(spark, sf):
    m = table(spark, sf, "pilot100_manifest").where("Antibiotic IS NOT NULL AND AST_phenotype IS NOT NULL").select("Pilot_ID", F.concat(F.lower("Antibiotic"), F.lit("="), "AST_phenotype", F.lit(","), F.col("Antibiotic"), F.lit("="), "AST_phenotype").alias("text")).distinct()
    return reports.antibiogram(m, "Pilot_ID", "text")


q.oracle["s030_antibiogram"] = "SELECT DISTINCT Pilot_ID, lower(Antibiotic) AS drug, CASE WHEN AST_phenotype IN ('R','I','S','SDD','ND') THEN AST_phenotype END AS category, CASE WHEN AST_phenotype IN ('R','I','S','SDD','ND') THEN 'called' ELSE 'invalid' END AS state FROM pilot100_manifest WHERE Antibiotic IS NOT NULL AND AST_phenotype IS NOT NULL"


@q()
def s031_genotypes(spark, sf):
    m = table(spark, sf, "pilot100_manifest").select("Pilot_ID", "AMR_genotypes").distinct().where(~F.coalesce(fn.trim_blanks("AMR_genotypes"), F.lit("")).isin("", ".", "NA", "MISSING"))
    return reports.genotypes(m, "Pilot_ID", "AMR_genotypes", ("COMPLETE", "PARTIAL", "POINT", "HMM", "MISTRANSLATION"))


q.oracle["s031_genotypes"] = r"""
WITH m AS (SELECT DISTINCT Pilot_ID, AMR_genotypes AS t FROM pilot100_manifest WHERE AMR_genotypes IS NOT NULL AND trim(AMR_genotypes, e' \t\r\n') NOT IN ('', '.', 'NA', 'MISSING')),
p AS (SELECT Pilot_ID, unnest(CASE WHEN starts_with(trim(t, e' \t\r\n'), '[') THEN from_json(trim(t, e' \t\r\n'), '["VARCHAR"]') ELSE list_transform(list_filter(list_transform(string_split(array_to_string(list_transform(string_split(t, '"'), lambda s, i: CASE WHEN i % 2 = 1 THEN translate(s, e',;|\r\n', repeat(chr(1), 5)) ELSE s END), '"'), chr(1)),
    lambda x: trim(x, e' \t\r\n')), lambda x: x <> ''), lambda x: CASE WHEN regexp_full_match(x, '"(?:[^"]|"")*"', 's') THEN replace(x[2:-2], '""', '"') ELSE x END) END) AS p FROM m),
s AS (SELECT Pilot_ID, trim(split_part(p, '=', 1)) AS symbol, CASE WHEN contains(p, '=') THEN trim(split_part(p, '=', -1)) END AS state FROM p)
SELECT Pilot_ID, CASE WHEN regexp_matches(symbol, '^(.+?)[_:]([A-Z][0-9]+[A-Z*])$') THEN regexp_extract(symbol, '^(.+?)[_:]([A-Z][0-9]+[A-Z*])$', 1) ELSE symbol END AS gene, nullif(regexp_extract(symbol, '^(.+?)[_:]([A-Z][0-9]+[A-Z*])$', 2), '') AS variant,
    state, state IS NULL OR state IN ('COMPLETE', 'PARTIAL', 'POINT', 'HMM', 'MISTRANSLATION') AS known FROM s"""


@q("SELECT sample_id, epoch_us(registered_at) AS registered_us, withdrawn_at IS NOT NULL AS withdrawn FROM samples")
def s032_index_load(spark, sf):
    from isolake.operators.guards import require_unique

    s = samples(spark, sf)
    return require_unique(s, ["sample_id"], "samples").select("sample_id", F.unix_micros("registered_at").alias("registered_us"), F.col("withdrawn_at").isNotNull().alias("withdrawn"))


@q("SELECT id, array_to_string(list_sort(map_keys(m)), ',') AS keys, m['k'] AS k FROM (SELECT event_id AS id, from_json(props, '\"MAP(VARCHAR,VARCHAR)\"') AS m FROM events)")
def s035_json_sidecar(spark, sf):
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"), F.try_element_at(m, F.lit("k")).alias("k"))


@q("SELECT subject, count(*) AS n FROM (SELECT DISTINCT * FROM execution) WHERE stage = 'amr' GROUP BY 1")
def s037_partition_pruning(spark, sf):
    """A table partitioned by a key: the filter reads one folder."""
    path = new_dir(spark, "pruned")
    table(spark, sf, "execution").distinct().select("id", "subject", "stage").repartition("stage").write.partitionBy("stage").parquet(path)
    return spark.read.parquet(path).where("stage = 'amr'").groupBy("subject").agg(F.count(F.lit(1)).alias("n"))


@q(r"SELECT DISTINCT Assembly AS accession FROM pilot100_manifest WHERE Assembly IS NOT NULL")
def s038_discovery(spark, sf):
    m = table(spark, sf, "pilot100_manifest").where("Assembly IS NOT NULL").select(F.concat("Genome_path", F.lit(" "), "Assembly").alias("p")).distinct()
    return m.select(F.regexp_extract("p", r"(GC[A-Z]_[0-9]+\.[0-9]+)", 1).alias("accession")).distinct()


@q("SELECT call_id::VARCHAR || '\t' || coalesce(gene, '.') || '\t' || coalesce((variant IS NOT NULL)::VARCHAR, '.') AS value FROM calls UNION ALL SELECT 'call_id\tgene\thas_variant' UNION ALL SELECT '# exported'")
def s040_tsv_sink(spark, sf):
    path = new_dir(spark, "tsv")
    tsv.write_tsv(calls(spark, sf, "gene", "variant").select("call_id", "gene", F.col("variant").isNotNull().alias("has_variant")), path, banner=["exported"], order=["call_id"])
    return spark.read.text(path)


@q(f", {_SEQS} SELECT length(seq) AS n, count(*) AS records FROM seqs GROUP BY 1")
def s041_fasta_sink(spark, sf):
    path = new_dir(spark, "fasta")
    sequences.write_fasta(_sequences(spark, sf).select(F.col("doc_id").cast("string").alias("header"), "seq"), path, width=60)
    return sequences.read_fasta(spark, path).groupBy(F.length("seq").alias("n")).agg(F.count(F.lit(1)).alias("records"))


@q("SELECT lineage, round(avg(CASE WHEN mechanism = 'efflux' THEN 1.0::DOUBLE ELSE 0 END), 6) AS efflux, round(avg(CASE WHEN mechanism = 'enzyme' THEN 1.0::DOUBLE ELSE 0 END), 6) AS enzyme FROM calls JOIN (SELECT DISTINCT sample_id, lineage FROM samples) USING (sample_id) WHERE lineage IS NOT NULL GROUP BY 1")
def s043_matrix_sink(spark, sf):
    j = calls(spark, sf, "sample_id", "mechanism").join(samples(spark, sf).select("sample_id", "lineage").distinct(), "sample_id").where("lineage IS NOT NULL")
    n = j.groupBy("lineage").agg(F.count(F.lit(1)).alias("n"))
    m = j.groupBy("lineage").pivot("mechanism", ["efflux", "enzyme"]).agg(F.count(F.lit(1))).na.fill(0)
    return m.join(n, "lineage").select("lineage", *[F.round(F.col(c) / F.col("n"), 6).alias(c) for c in ("efflux", "enzyme")])


@q("SELECT sample_id, 'no_genes' AS reason FROM (SELECT DISTINCT sample_id FROM samples) WHERE sample_id NOT IN (SELECT sample_id FROM presence) UNION ALL SELECT DISTINCT sample_id, 'withdrawn' FROM samples WHERE withdrawn_at IS NOT NULL AND sample_id IN (SELECT sample_id FROM presence)")
def s046_exclusions(spark, sf):
    s = samples(spark, sf).select("sample_id", "withdrawn_at").distinct()
    j = s.join(presence(spark, sf).select("sample_id").distinct().withColumn("p", F.lit(True)), "sample_id", "left")
    reason = F.when(F.col("p").isNull(), "no_genes").when(F.col("withdrawn_at").isNotNull(), "withdrawn")
    return j.select("sample_id", reason.alias("reason")).where("reason IS NOT NULL")


# 2.10 streams


def _event_lines(spark, sf) -> DataFrame:
    """The status feed as JSON lines, in order of arrival; a line whose time is missing or no time is cut off, so no JSON."""
    f = table(spark, sf, "status_feed").select("line_no", "t", "event", "stage", "sample")
    return f.select("line_no", F.when(~F.coalesce(F.col("t").rlike("^[0-9]"), F.lit(False)), F.concat(F.lit("{broken "), F.col("line_no").cast("string"))).otherwise(F.to_json(F.struct("t", "event", "stage", "sample"), {"ignoreNullFields": "false"})).alias("value"))


@q("SELECT CASE WHEN t IS NULL OR NOT regexp_matches(t, '^[0-9]') THEN 'not_json' WHEN event IS NULL OR event NOT IN ('start','done','fail') THEN 'unknown_event' ELSE 'valid' END AS verdict, count(*) AS n FROM status_feed GROUP BY 1")
def s196_event_contract(spark, sf):
    return ev.parse_events(_event_lines(spark, sf)).groupBy(F.coalesce("fault", F.lit("valid")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@q("SELECT CASE WHEN stage IN ('gwas', 'convergence', 'cooccurrence') THEN 'statistics' WHEN stage IN ('mlst', 'amr', 'virulence') THEN 'typing' ELSE 'unmapped' END AS rule, count(*) AS n FROM status_feed GROUP BY 1")
def s197_rule_map(spark, sf):
    rules = spark.createDataFrame([("gwas", "statistics"), ("convergence", "statistics"), ("cooccurrence", "statistics"), ("mlst", "typing"), ("amr", "typing"), ("virulence", "typing")], "stage string, rule string")
    return table(spark, sf, "status_feed").join(rules, "stage", "left").groupBy(F.coalesce("rule", F.lit("unmapped")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


_FOLD = "SELECT stage, count(*) FILTER (event = 'start') AS started, count(*) FILTER (event = 'done') AS done, count(*) FILTER (event = 'fail') AS failed, count(*) AS events FROM status_feed WHERE regexp_matches(t, '^[0-9]') AND event IN ('start','done','fail') AND stage IS NOT NULL GROUP BY 1"


def _streamed_fold(spark, sf) -> DataFrame:
    base = new_dir(spark, "events")
    _event_lines(spark, sf).select("value").repartition(4).write.text(f"{base}/log")
    ev.run_to_end(ev.stage_fold(ev.parse_events(ev.read_event_lines(spark, f"{base}/log", 2))), f"{base}/out", f"{base}/state")
    return ev.latest_batch(spark, f"{base}/out")


@q(_FOLD)
def s198_stage_fold(spark, sf):
    return _streamed_fold(spark, sf)


@q(f"SELECT stage, CASE WHEN failed > 0 THEN 'failed' WHEN started > done + failed THEN 'running' WHEN done > 0 THEN 'completed' ELSE 'pending' END AS badge FROM ({_FOLD})")
def s199_badges(spark, sf):
    return _streamed_fold(spark, sf).select("stage", ev.badge(F.col("started"), F.col("done"), F.col("failed")).alias("badge"))


@q("SELECT event_id AS seq, event_type, (greatest((SELECT max(event_id) FROM events) - 500 + 1, 0) - 101)::BIGINT AS gap FROM events WHERE event_id > 100 AND event_id > (SELECT max(event_id) FROM events) - 500")
def s200_since_cursor(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("seq"), "event_type")
    return ev.since(e, 100).select("seq", "event_type", F.col("gap").cast("long").alias("gap"))


@q("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def s202_windowed_counts(spark, sf):
    w = ev.windowed_counts(table(spark, sf, "events"), "ts", "1 day", "1 day", "event_type")
    return w.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@q(r"SELECT stage, arg_max(state, id) AS state, max(id) AS id FROM (SELECT DISTINCT regexp_extract(log_path, '^[^.]+\.([a-z_]+)\.log$', 1) AS stage, state, id FROM attempt_log WHERE log_path IS NOT NULL) WHERE stage <> '' GROUP BY 1")
def s203_log_state(spark, sf):
    a = table(spark, sf, "attempt_log").where("log_path IS NOT NULL").select(F.regexp_extract("log_path", r"^[^.]+\.([a-z_]+)\.log$", 1).alias("stage"), "state", "id").distinct().where("stage <> ''")
    return a.groupBy("stage").agg(F.max_by("state", "id").alias("state"), F.max("id").alias("id"))


# 2.11 declared checks


@q()
def s205_contract_checks(spark, sf):
    c = contracts.Contract(columns=("sample_id", "assembly_path", "lineage", "data_class", "registered_at", "withdrawn_at"), min_rows=10, filled=("sample_id", "lineage"), key="sample_id", varied=("lineage",))
    return contracts.verdicts(table(spark, sf, "sample_metadata"), c).select("check", "subject", "ok")


q.oracle["s205_contract_checks"] = """SELECT * FROM (VALUES ('columns', 'sample_id,assembly_path,lineage,data_class,registered_at,withdrawn_at', true)) v("check", subject, ok)
UNION ALL SELECT 'min_rows', '10', count(*) >= 10 FROM sample_metadata UNION ALL SELECT 'filled', 'sample_id', count(sample_id) > 0 FROM sample_metadata
UNION ALL SELECT 'filled', 'lineage', count(lineage) > 0 FROM sample_metadata UNION ALL SELECT 'varied', 'lineage', count(DISTINCT lineage) > 1 FROM sample_metadata"""


@q("SELECT 16 AS files, 16 AS contents, true AS ok")
def s206_sibling_degeneracy(spark, sf):
    path = new_dir(spark, "siblings")
    e = table(spark, sf, "execution").where("stage IS NOT NULL").select("stage").distinct()
    e.withColumn("value", F.col("stage")).repartition("stage").write.partitionBy("stage").text(path)
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    return f.select(F.sha2("content", 256).alias("h")).agg(F.count(F.lit(1)).alias("files"), F.countDistinct("h").alias("contents")).withColumn("ok", F.col("contents") >= 2)


@q("SELECT column_name, n AS filled FROM (SELECT count(CASE WHEN lower(trim(lineage)) NOT IN ('', '.', 'na', 'nan', 'none', 'null', '-') THEN 1 END) AS lineage, count(CASE WHEN lower(trim(data_class)) NOT IN ('', '.', 'na', 'nan', 'none', 'null', '-') THEN 1 END) AS data_class FROM sample_metadata) UNPIVOT (n FOR column_name IN (lineage, data_class))")
def s209_completeness(spark, sf):
    real = lambda c: F.count(fn.clean_cell(c))
    a = table(spark, sf, "sample_metadata").agg(real("lineage").alias("lineage"), real("data_class").alias("data_class"))
    return a.unpivot([], ["lineage", "data_class"], "column_name", "filled")


QUERIES, ORACLE = q.queries, q.oracle
