"""Queries of parsers, pages, locus measurement and mixed models (lines of the inventory that had none of their own)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.functions import scalars as fn
from isolake.operators import aggregates as agg
from isolake.operators import locus, mixed, stats, windows
from isolake.plans.analysis import _outcome
from isolake.plans.views import Catalogue, calls, presence, table
from isolake.session import new_dir
from isolake.sources import pages, reports, tsv, variants
from isolake.streaming import events as ev

q = Catalogue()


@q("SELECT call_id::VARCHAR AS call_id, sample_id, gene FROM calls")
def s002_stream_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """The calls as a folder of text files, each with a header, read as a stream two files a batch."""
    base, columns = new_dir(spark, "tsv_stream"), ["call_id", "sample_id", "gene"]
    rows = calls(spark, sf, "sample_id", "gene").select(F.concat_ws("\t", F.col("call_id").cast("string"), F.coalesce("sample_id", F.lit(".")), F.coalesce("gene", F.lit("."))).alias("value"), F.pmod("call_id", F.lit(5)).alias("part"))
    heads = spark.range(5).select(F.lit("\t".join(columns)).alias("value"), F.col("id").alias("part"))
    heads.unionByName(rows).repartition("part").select("value").write.text(f"{base}/in")
    ev.run_to_end(tsv.stream_tsv(spark, f"{base}/in", columns, files_per_batch=2), f"{base}/out", f"{base}/state", "append")
    return spark.read.parquet(f"{base}/out").drop("batch")


_ALLELES = "(SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN '-' ELSE c_nationkey::VARCHAR END AS a, CASE WHEN c_custkey % 4 = 0 THEN '?' ELSE (c_custkey % 7)::VARCHAR END AS b, CASE WHEN c_custkey % 5 = 0 THEN '-' ELSE c_custkey::VARCHAR END AS st FROM customer)"


@q(f"SELECT 'c' || c_custkey AS sample_id, true AS found, 'scheme1' AS scheme, nullif(st, '-') AS st, coalesce(nullif(a, '-'), '.') || '/' || b AS profile, (b = '?')::INT AS partial FROM {_ALLELES}")
def s016_legacy_typing(spark, sf):
    """Customers as samples of a legacy typing table: a header, then a row for each file."""
    k = F.col("c_custkey")
    a = F.when(F.col("c_nationkey") % 3 == 0, "-").otherwise(F.col("c_nationkey").cast("string"))
    b = F.when(k % 4 == 0, "?").otherwise((k % 7).cast("string"))
    st = F.when(k % 5 == 0, "-").otherwise(k.cast("string"))
    c = table(spark, sf, "customer")
    lines = c.select(F.concat_ws("\t", F.concat(F.lit("/data/c"), k, F.lit(".fna")), F.lit("scheme1"), st, a, b).alias("value"))
    head = spark.createDataFrame([("FILE\tSCHEME\tST\tacsA\taroE",)], "value string")
    out = reports.legacy_typing(lines.unionByName(head), c.select(F.concat(F.lit("c"), k).alias("sample_id")))
    allele = lambda x: F.coalesce(F.try_element_at("alleles", F.lit(x)), F.lit("."))
    return out.select("sample_id", "found", "scheme", "st", F.concat_ws("/", allele("acsA"), allele("aroE")).alias("profile"), F.size("partial").alias("partial"))


@q("SELECT gene AS query, sample_id AS subject, identity_pct AS identity, call_id AS length, coverage_pct AS coverage, 1 AS start, call_id AS \"end\" FROM calls WHERE gene IS NOT NULL AND sample_id IS NOT NULL AND identity_pct IS NOT NULL AND coverage_pct IS NOT NULL")
def s021_strict_hits(spark, sf):
    """A search table in which every row must have all columns, of the right types."""
    c = calls(spark, sf, "gene", "sample_id", "identity_pct", "coverage_pct").where("gene IS NOT NULL AND sample_id IS NOT NULL AND identity_pct IS NOT NULL AND coverage_pct IS NOT NULL")
    text = lambda x: F.col(x).cast("string")
    lines = c.select(F.concat_ws("\t", "gene", "sample_id", text("identity_pct"), text("call_id"), text("coverage_pct"), F.lit("1"), text("call_id")).alias("value"))
    return variants.parse_table(lines, variants.HIT_COLUMNS, strict=True)


def _newick(spark, sf) -> DataFrame:
    """A tree a region, its nations as tips in order of name."""
    n = table(spark, sf, "nation").withColumn("tip", F.concat("n_name", F.lit(":"), ((F.col("n_nationkey") + 1) / 2).cast("string")))
    return n.groupBy(F.concat(F.lit("t"), "n_regionkey").alias("tree_id")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("tip")), ","), F.lit(")root;")).alias("newick"))


@q("SELECT 't' || x.n_regionkey AS tree_id, x.n_name AS a, y.n_name AS b, CASE WHEN x.n_name = y.n_name THEN 0 ELSE (x.n_nationkey + y.n_nationkey + 2) / 2.0::DOUBLE END AS d FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND x.n_name <= y.n_name")
def s027_patristic_newick(spark, sf):
    """Path lengths between the tips of each tree, parsed from its text; node numbers become names within their tree."""
    t = reports.trees(_newick(spark, sf))
    node = lambda c: F.concat_ws(":", "tree_id", F.col(c).cast("string"))
    edges = t.select(node("node").alias("node"), F.when(F.col("parent").isNotNull(), node("parent")).alias("parent"), "length")
    tips = t.where("is_tip").select(node("node").alias("node"), "label", "tree_id")
    d = stats.patristic(edges, tips)
    named = lambda x: tips.select(F.col("node").alias(x), F.col("label").alias(f"name_{x}"), *(["tree_id"] if x == "a" else []))
    j = d.join(named("a"), "a").join(named("b"), "b")
    return j.select("tree_id", F.least("name_a", "name_b").alias("a"), F.greatest("name_a", "name_b").alias("b"), "d")


@q("""SELECT 't' || n_regionkey AS tree_id, (row_number() OVER w - 1) AS node_id, count(*) OVER (PARTITION BY n_regionkey) AS parent_id, 0 AS children, n_name AS label, true AS is_tip FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_name || ':')
UNION ALL SELECT 't' || n_regionkey, count(*), NULL, count(*)::INT, 'root', false FROM nation GROUP BY n_regionkey""")
def s028_tree_projection(spark, sf):
    return reports.tree_projection(_newick(spark, sf)).select("tree_id", "node_id", "parent_id", F.size("children").alias("children"), "label", "is_tip")


@q("SELECT call_id, gene, row_number() OVER (ORDER BY gene NULLS LAST, call_id) AS page_row FROM calls QUALIFY page_row > 100 AND page_row <= 150")
def s037_page_read(spark, sf):
    """One page of the calls in order of gene, found by row number."""
    path = new_dir(spark, "pages")
    pages.write_pages(calls(spark, sf, "gene"), [F.col("gene").asc_nulls_last(), "call_id"], path)
    return pages.read_page(spark, path, 100, 50)


@q("SELECT * FROM (VALUES (1, 'flag', 'not given', false), (2, 'empty', 'absent', false), (3, 'half', 'incomplete: no b', false), (4, 'whole', 'matched', true), (5, 'also', 'matched', false)) v(probe, name, outcome, chosen)")
def s039_source_detection(spark, sf):
    base, r = new_dir(spark, "places"), table(spark, sf, "region")
    for where, names in (("half", "a"), ("whole", "ab"), ("also", "ab")):
        for n in names:
            r.write.parquet(f"{base}/{where}/{n}")
    found, probes = pages.detect(spark, [("flag", None), *((n, f"{base}/{n}") for n in ("empty", "half", "whole", "also"))], ["a", "b"])
    return spark.createDataFrame([(p.order, p.name, p.outcome, p.path is not None and p.path == found) for p in probes], "probe int, name string, outcome string, chosen boolean")


@q("SELECT coalesce(event, 'none') AS event, count(*) AS n FROM status_feed GROUP BY 1")
def s050_event_append(spark, sf):
    """The status feed appended to a log in three parts, and read back."""
    path = new_dir(spark, "log")
    f = table(spark, sf, "status_feed").select("t", "event", "stage", "sample", F.pmod(F.xxhash64("line_no"), F.lit(3)).alias("part"))
    for k in range(3):
        ev.append_events(f.where(F.col("part") == k), path)
    return ev.parse_events(spark.read.text(path)).groupBy(F.coalesce("event", F.lit("none")).alias("event")).agg(F.count(F.lit(1)).alias("n"))


_LOCUS = """WITH g AS (SELECT c_custkey AS k, c_custkey % 6 AS kind FROM customer)"""


@q(_LOCUS + """ SELECT 'c' || k AS sample_id, CASE kind WHEN 1 THEN 'no_candidate_hit' WHEN 2 THEN 'ambiguous_locus' WHEN 4 THEN 'frame_not_anchorable' END AS refused, CASE WHEN kind IN (0, 3, 5) THEN CASE kind WHEN 0 THEN 4 WHEN 3 THEN 2 ELSE 4 END END AS protein_stop,
CASE WHEN kind IN (0, 5) THEN 'yes' WHEN kind = 3 THEN 'no' ELSE 'refused' END AS own_terminator, CASE WHEN kind IN (0, 3, 5) THEN CASE kind WHEN 5 THEN '-' ELSE '+' END WHEN kind = 4 THEN '+' END AS strand, CASE kind WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 WHEN 4 THEN 60.0 ELSE 100.0 END::DOUBLE AS coverage_pct FROM g""")
def s149_locus_measurement(spark, sf):
    """A gene of five codons (the last its stop) in six situations: whole, diverged, in two equal copies, with an early stop, without its start, and on the other strand."""
    k, kind = F.concat(F.lit("c"), F.col("c_custkey")), F.col("c_custkey") % 6
    c = table(spark, sf, "customer").select(k.alias("sample_id"), kind.alias("kind"))
    # ATG GCC AAA CTG TAA, and with a stop as its third codon
    seq = F.when(F.col("kind") == 3, "CCATGGCCTAACTGTAACC").when(F.col("kind") == 5, "GGTTACAGTTTGGCCATGG").otherwise("CCATGGCCAAACTGTAACC")
    contigs = c.select("sample_id", F.lit("k1").alias("contig"), seq.alias("seq")).unionByName(c.select("sample_id", F.lit("k2").alias("contig"), seq.alias("seq")))
    hit = lambda contig, lo, hi: F.struct(F.lit(contig).alias("contig"), F.when(F.col("kind") == 1, 40.0).otherwise(95.0).alias("identity"), F.lit(lo).alias("q_lo"), F.lit(hi).alias("q_hi"), F.when(F.col("kind") == 5, 17 - 3 * hi + 1).otherwise(3 * lo).alias("s_lo"), F.when(F.col("kind") == 5, 17 - 3 * lo + 3).otherwise(3 * hi + 2).alias("s_hi"), F.when(F.col("kind") == 5, -1).otherwise(1).alias("strand"))
    hits = F.when(F.col("kind") == 2, F.array(hit("k1", 1, 5), hit("k2", 1, 5))).when(F.col("kind") == 4, F.array(hit("k1", 3, 5))).otherwise(F.array(hit("k1", 1, 3), hit("k1", 2, 5), hit("k2", 4, 5)))
    h = c.select("sample_id", "kind", F.explode(hits).alias("h")).select("sample_id", "h.*")
    return locus.measure_locus(h, contigs, c, 5, 80.0).select("sample_id", "refused", "protein_stop", F.when(F.col("own_terminator"), "yes").when(~F.col("own_terminator"), "no").otherwise("refused").alias("own_terminator"), "strand", "coverage_pct")


@q("SELECT call_id, row_number() OVER (ORDER BY coalesce(list_position(['UNKNOWN','DETECTED','PREDICTED','ASSOCIATED','SUPPORTED'], claim_status), 1) DESC, gene NULLS LAST, call_id) AS rn FROM calls")
def s154_result_order(spark, sf):
    """All calls in the order of reports: strongest claim first, then gene, then id."""
    c = calls(spark, sf, "claim_status", "gene").withColumn("rank", fn.claim_rank(F.col("claim_status")))
    return windows.numbered(c, [F.col("rank").desc(), F.col("gene").asc_nulls_last(), "call_id"]).select("call_id", "rn")


_CARRIERS = """, o AS (SELECT DISTINCT sample_id, CASE phenotype WHEN 'R' THEN 1.0::DOUBLE WHEN 'S' THEN 0.0 END AS y FROM phenotypes WHERE phenotype IN ('R', 'S')), t AS (SELECT count(*) AS n, avg(y) AS ybar, sum(y * y) AS yy, sum(y) AS sy FROM o),
g AS (SELECT gene AS feature, count(*) AS k, sum(y) AS s1 FROM (SELECT DISTINCT gene, sample_id FROM presence) JOIN o USING (sample_id) GROUP BY 1), b AS (SELECT feature, k, n, s1 / k - (sy - s1) / (n - k) AS beta, yy - s1 * s1 / k - (sy - s1) * (sy - s1) / (n - k) AS rss FROM g, t WHERE k < n)"""


@q(_CARRIERS + " SELECT feature, k AS carriers, round(beta, 6) + 0.0 AS beta, round(sqrt(rss / (n - 2) * (1.0 / k + 1.0 / (n - k))), 6) AS se FROM b")
def s162_linear_model(spark, sf):
    """The mixed model with unrelated samples, where it is least squares and has a closed form."""
    m = mixed.mixed_model(presence(spark, sf).select(F.col("gene").alias("feature"), "sample_id"), _outcome(spark, sf), None)
    return m.where("beta IS NOT NULL").select("feature", "carriers", (F.round("beta", 6) + 0.0).alias("beta"), F.round("se", 6).alias("se"))


@q()
def s162_mixed_model(spark, sf):
    """Genes against phenotype with the kinship of the samples' determinants."""
    s = _outcome(spark, sf)
    v = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL").join(s, "sample_id", "left_semi").select("sample_id", F.col("gene").alias("feature")).distinct().withColumn("value", F.lit(1.0))
    m = mixed.factored_model(presence(spark, sf).select(F.col("gene").alias("feature"), "sample_id"), s, v)
    return m.select("feature", "carriers", F.round("beta", 5).alias("beta"), F.round("p_value", 5).alias("p_value"))


@q("WITH RECURSIVE e AS (SELECT DISTINCT stage AS node, subject AS need FROM (VALUES ('gwas', 'pangenome'), ('gwas', 'amr'), ('pangenome', 'annotation'), ('annotation', 'validation'), ('amr', 'validation'), ('reporting', 'gwas')) v(stage, subject)), up(node, need) AS (SELECT node, need FROM e UNION SELECT up.node, e.need FROM up JOIN e ON e.node = up.need), s AS (SELECT DISTINCT stage FROM execution WHERE stage IN ('gwas', 'amr', 'pangenome')) SELECT DISTINCT s.stage, need FROM s JOIN up ON up.node = s.stage")
def s208_prerequisites(spark, sf):
    """All that the stages in use need, directly or not: a closure over a graph of edges."""
    e = spark.createDataFrame([("gwas", "pangenome"), ("gwas", "amr"), ("pangenome", "annotation"), ("annotation", "validation"), ("amr", "validation"), ("reporting", "gwas")], "node string, parent string")
    up = agg.ancestors(e).where("below <> above").select(F.col("below").alias("stage"), F.col("above").alias("need")).distinct()
    used = table(spark, sf, "execution").select("stage").where("stage IN ('gwas', 'amr', 'pangenome')").distinct()
    return up.join(used, "stage", "left_semi")


QUERIES, ORACLE = q.queries, q.oracle
