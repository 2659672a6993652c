"""Further queries of the inventory: annotation tables, multi-file sinks, spans, downstream statistics and feature layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.operators import downstream, spans, stats, windows
from isolake.operators import features as feat
from isolake.plans.analysis import _ADJUSTED, _design, _features_with_known, _kinds, _outcome, _scan
from isolake.plans.views import Catalogue, calls, phenotypes, presence, samples, table
from isolake.session import new_dir
from isolake.sources import annotation, sinks, tsv, variants

q = Catalogue()


@q("SELECT 'g' || p_partkey AS locus_tag, p_brand AS contig, p_partkey * 10 + 1 AS start, p_partkey * 10 + p_size AS \"end\", '+' AS strand FROM part WHERE p_type = 'PROMO'")
def s006_gene_intervals(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    p = table(spark, sf, "part").where("p_type = 'PROMO'")
    lines = p.select(F.concat_ws("\t", "p_brand", F.lit("s"), F.lit("gene"), (k * 10 + 1).cast("string"), (k * 10 + F.col("p_size")).cast("string"), F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit("ID=x;locus_tag=g"), k)).alias("value"))
    return variants.gene_intervals(lines, p.select(F.concat(F.lit("g"), k).alias("locus_tag")))


@q("SELECT call_id::VARCHAR AS call_id, gene, determinant_type AS kind FROM calls")
def s007_annotation_table(spark, sf):
    path = new_dir(spark, "annotation")
    body = calls(spark, sf, "gene", "determinant_type").select(F.lit(1).alias("n"), "call_id", F.concat_ws("\t", F.col("call_id").cast("string"), F.coalesce("gene", F.lit("-")), "determinant_type").alias("value"))
    head = spark.createDataFrame([(0, 0, "# tool 1.0"), (0, 1, "#call_id\tgene\tkind")], "n int, call_id long, value string")
    head.unionByName(body).repartition(1).sortWithinPartitions("n", "call_id").select("value").write.text(path)
    return annotation.read_commented_table(spark, path)


@q("SELECT sample_id, gene AS gene_name, determinant_type AS gene_type, call_id AS start, 'demo' AS annotation_source FROM calls")
def s008_standardise(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "determinant_type").select("sample_id", "gene", "determinant_type", F.col("call_id").cast("string").alias("from"))
    s = annotation.standardise(c, {"gene_name": "gene", "gene_type": "determinant_type", "start": "from"}, "demo")
    return s.select("sample_id", "gene_name", "gene_type", "start", "annotation_source")


@q("SELECT gene AS query, sample_id AS subject, identity_pct AS identity, call_id AS length, coverage_pct AS coverage, 1 AS start, call_id AS \"end\" FROM calls WHERE gene IS NOT NULL AND sample_id IS NOT NULL AND identity_pct IS NOT NULL AND coverage_pct IS NOT NULL")
def s019_search_hits(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "identity_pct", "coverage_pct").where("gene IS NOT NULL AND sample_id IS NOT NULL")
    cell = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("-"))
    return variants.parse_table(c.select(F.concat_ws("\t", "gene", "sample_id", cell("identity_pct"), cell("call_id"), cell("coverage_pct"), F.lit("1"), cell("call_id")).alias("value")), variants.HIT_COLUMNS)


@q("SELECT DISTINCT gene AS accession, 'f1' AS factor, mechanism AS category FROM calls WHERE gene IS NOT NULL AND mechanism IS NOT NULL")
def s020_database_headers(spark, sf):
    c = calls(spark, sf, "gene", "mechanism").where("gene IS NOT NULL AND mechanism IS NOT NULL")
    lines = c.select(F.concat(F.lit(">"), "gene", F.lit(" (f1) product [X (V1) - "), "mechanism", F.lit(" (V2)]")).alias("value")).distinct()
    return variants.database_headers(lines)


_BUCKETS = """, g AS (SELECT CASE WHEN count(*) >= 0.95 * (SELECT count(DISTINCT sample_id) FROM presence) THEN 'core' ELSE 'accessory' END AS metric FROM presence GROUP BY gene), s AS (SELECT metric, count(*) AS value FROM g GROUP BY 1)"""


@q(_BUCKETS + " SELECT * FROM s UNION ALL SELECT 'total', sum(value)::BIGINT FROM s")
def s023_checked_summary(spark, sf):
    path = new_dir(spark, "pangenome")
    sinks.write_pangenome(presence(spark, sf), path, 0.95)
    t = tsv.read_tsv(spark, f"{path}/summary", required=["metric", "value"], unique=["metric"])
    return annotation.checked_summary(t, "metric", "value", "total").select("metric", F.col("value").cast("long").alias("value"))


@q("SELECT stage AS node, count(*) AS snps, (count(*) FILTER (state = 'FAILED') > 0)::INT AS flag FROM (SELECT DISTINCT * FROM execution) GROUP BY 1")
def s025_branch_flags(spark, sf):
    e = table(spark, sf, "execution").distinct()
    g = e.groupBy(F.col("stage").alias("node")).agg(F.count(F.lit(1)).alias("snps"), F.count_if(F.col("state") == "FAILED").alias("blocks"))
    return g.select("node", "snps", (F.col("blocks") > 0).cast("int").alias("flag"))


@q("SELECT sample_id, phenotype FROM phenotypes WHERE antibiotic = 'meropenem' AND phenotype IN ('R', 'S', 'I', 'SDD', 'ND')")
def s029_phenotype_load(spark, sf):
    from isolake.operators.guards import require_unique, require_vocabulary

    p = require_unique(phenotypes(spark, sf).where("antibiotic = 'meropenem'"), ["sample_id", "antibiotic"], "phenotypes")
    return require_vocabulary(p, "phenotype", ("R", "S", "I", "SDD", "ND")).where("phenotype IS NOT NULL").select("sample_id", "phenotype")


@q(f", {_ADJUSTED} SELECT feature FROM adj")
def s033_association_table(spark, sf):
    path = new_dir(spark, "assoc")
    tsv.write_tsv(_scan(spark, sf).select("feature", "p_value"), path, order=["feature"])
    return annotation.association_table(spark, path, ["feature", "p_value"]).select("feature")


_WIDE = ("efflux", "enzyme", "porin_loss", "target_change")


@q("SELECT sample_id, mechanism AS feature, 1 AS value FROM (SELECT DISTINCT sample_id, mechanism FROM calls WHERE sample_id IS NOT NULL AND mechanism IS NOT NULL)")
def s034_long_matrix(spark, sf):
    c = calls(spark, sf, "sample_id", "mechanism").where("sample_id IS NOT NULL AND mechanism IS NOT NULL").select("sample_id", "mechanism").distinct().withColumn("one", F.lit(1))
    wide = c.groupBy("sample_id").pivot("mechanism", list(_WIDE)).agg(F.max("one")).na.fill(0)
    return annotation.long_matrix(wide).where("value = 1").select("sample_id", "feature", "value")


@q("SELECT * FROM (VALUES ('absent', 'absent'), ('empty', 'empty'), ('header', 'header_only'), ('rows', 'read')) v(name, reason)")
def s036_read_with_reason(spark, sf):
    base = new_dir(spark, "reads")
    r = table(spark, sf, "region").select(F.concat_ws("\t", F.col("r_regionkey").cast("string"), "r_name").alias("value"))
    head = spark.createDataFrame([("key\tname",)], "value string")
    spark.createDataFrame([("# only a banner",)], "value string").coalesce(1).write.text(f"{base}/empty")
    head.coalesce(1).write.text(f"{base}/header")
    head.unionByName(r).repartition(1).write.text(f"{base}/rows")
    out = [(n, annotation.read_with_reason(spark, f"{base}/{n}").reason or "read") for n in ("absent", "empty", "header", "rows")]
    return spark.createDataFrame(out, "name string, reason string")


@q("SELECT gene, count(*) AS n_samples FROM presence GROUP BY 1 HAVING count(*) < 0.95 * (SELECT count(DISTINCT sample_id) FROM presence)")
def s042_pangenome_sink(spark, sf):
    path = new_dir(spark, "pangenome")
    sinks.write_pangenome(presence(spark, sf), path, 0.95)
    return spark.read.parquet(f"{path}/accessory")


@q("SELECT mechanism AS feature, count(DISTINCT lineage) AS lineages FROM calls JOIN samples USING (sample_id) WHERE mechanism IS NOT NULL AND lineage IS NOT NULL GROUP BY 1")
def s044_feature_rows(spark, sf):
    f = calls(spark, sf, "sample_id", "mechanism").join(samples(spark, sf).select("sample_id", "lineage").distinct(), "sample_id").where("mechanism IS NOT NULL AND lineage IS NOT NULL").select(F.col("mechanism").alias("feature"), F.col("lineage").alias("sample_id")).distinct().withColumn("value", F.lit(1))
    path = new_dir(spark, "rtab")
    sinks.write_feature_rows(f, f.select("sample_id").distinct(), path)
    t = tsv.read_tsv(spark, path, required=["feature"])
    cells = [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in t.columns if c != "feature"]
    return t.select("feature", sum(cells[1:], cells[0]).cast("long").alias("lineages"))


@q("SELECT DISTINCT sample_id, coalesce(lineage, NULL) AS lineage FROM samples")
def s045_layer_sinks(spark, sf):
    s = samples(spark, sf).select("sample_id", "lineage").distinct()
    p = s.select("sample_id").join(phenotypes(spark, sf).select("sample_id", "phenotype"), "sample_id", "left")
    path = new_dir(spark, "layers")
    sinks.write_layers({"lineage": s, "phenotype": p}, s, path, ["isolates as in the manifest"])
    return tsv.read_tsv(spark, f"{path}/lineage", unique=["sample_id"])


@q("SELECT count(*) AS rows, 3 AS columns FROM (SELECT DISTINCT sample_id, lineage, data_class FROM samples)")
def s047_provenance(spark, sf):
    import json

    p = json.loads(sinks.provenance({"samples": samples(spark, sf).select("sample_id", "lineage", "data_class").distinct()}, tool="isolake"))
    return spark.createDataFrame([(p["samples"]["rows"], len(p["samples"]["columns"]))], "rows long, columns int")


@q("SELECT count(DISTINCT gene) - 5 AS left_out FROM calls WHERE gene IS NOT NULL")
def s048_report_table(spark, sf):
    c = calls(spark, sf, "gene").where("gene IS NOT NULL").groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
    text = sinks.markdown(c, [F.desc("n"), "gene"], 5)
    return spark.createDataFrame([(int(text.splitlines()[-1].split()[0]),)], "left_out long")


# spans of ordered hits


_HITS = "h AS (SELECT o_custkey AS g, o_orderkey AS k, epoch(o_orderdate)::BIGINT // 86400 AS qs, epoch(o_orderdate)::BIGINT // 86400 + 3 AS qe, (epoch(o_orderdate)::BIGINT // 86400) * 2 + o_orderkey % 5 AS rs, (epoch(o_orderdate)::BIGINT // 86400) * 2 + o_orderkey % 5 + 3 AS re FROM orders)"


def _hits(spark, sf) -> DataFrame:
    day = F.floor(F.unix_timestamp("o_orderdate") / 86400)
    r = day * 2 + F.col("o_orderkey") % 5
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("g"), day.alias("qs"), (day + 3).alias("qe"), r.alias("rs"), (r + 3).alias("re"))


_NET = f", {_HITS}, n AS (SELECT g, qs AS pos, (qs - lag(qe) OVER w) - (rs - lag(re) OVER w) AS net FROM h WINDOW w AS (PARTITION BY g ORDER BY qs, qe, rs)), c AS (SELECT * FROM n WHERE net IS NOT NULL AND net <> 0)"


@q(_NET + " SELECT g, count(*) AS changes, sum(net)::BIGINT AS net FROM c GROUP BY 1")
def s146_indel_scan(spark, sf):
    return spans.indels(_hits(spark, sf), ["g"], "qs", "qe", "rs", "re").groupBy("g").agg(F.count(F.lit(1)).alias("changes"), F.sum("net").alias("net"))


@q(_NET + """, f AS (SELECT g, pos, sum(net)::BIGINT AS net FROM c GROUP BY ALL HAVING sum(net) % 3 <> 0), r AS (SELECT a.g, a.pos AS first_pos, b.pos AS last_pos, count(*) AS n, sum(x.net) AS s FROM f a JOIN f b ON a.g = b.g AND b.pos > a.pos AND b.pos - a.pos <= 400 JOIN f x ON x.g = a.g AND x.pos BETWEEN a.pos AND b.pos GROUP BY ALL)
SELECT g, first_pos, min(last_pos) AS last_pos FROM r WHERE s % 3 = 0 AND (g, first_pos) IN (SELECT g, min(first_pos) FROM r WHERE s % 3 = 0 GROUP BY 1) GROUP BY ALL""")
def s147_compensating_group(spark, sf):
    c = spans.indels(_hits(spark, sf), ["g"], "qs", "qe", "rs", "re")
    return spans.compensating(c, ["g"], 400).select("g", "first_pos", "last_pos")


@q("""WITH s AS (SELECT DISTINCT l_suppkey AS k, l_returnflag AS strand, d FROM (SELECT l_suppkey, l_returnflag, unnest(generate_series(l_partkey % 400, l_partkey % 400 + 20)) AS d FROM lineitem)), p AS (SELECT k, strand, count(*) AS n FROM s GROUP BY ALL)
SELECT k, count(*) AS clusters, count(*) FILTER (n >= 0.9 * 420) AS "full", CASE count(*) FILTER (n >= 0.9 * 420) WHEN 1 THEN 'intact' WHEN 0 THEN 'fragment' ELSE 'duplicated' END AS verdict FROM p GROUP BY 1""")
def s148_cluster_verdict(spark, sf):
    h = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_returnflag").alias("strand"), (F.col("l_partkey") % 400).alias("s"), (F.col("l_partkey") % 400 + 20).alias("e"))
    return spans.cluster_verdict(h, ["strand"], "k", "s", "e", 420, 0.9)


@q("SELECT * FROM (VALUES ('validation', 0), ('annotation', 1), ('amr', 1), ('pangenome', 2), ('gwas', 3), ('reporting', 4)) v(stage, depth)")
def s155_graph_depth(spark, sf):
    e = [("validation", "annotation"), ("validation", "amr"), ("annotation", "pangenome"), ("pangenome", "gwas"), ("amr", "gwas"), ("gwas", "reporting"), ("amr", "reporting")]
    return spark.createDataFrame(sorted(spans.depths(e).items()), "stage string, depth int")


# downstream statistics


@q(f", {_ADJUSTED}, k(control, member) AS (SELECT 'first', min(gene) FROM presence UNION ALL SELECT 'last', max(gene) FROM presence UNION ALL SELECT 'none', 'not there') SELECT control, count(adjusted) AS members, round(min(adjusted), 6) AS adjusted_p_value, coalesce(min(adjusted) <= 1.0, false) AS recovered FROM k LEFT JOIN adj ON feature = member GROUP BY 1")
def s176_control_outcomes(spark, sf):
    p = presence(spark, sf)
    k = p.agg(F.min("gene").alias("a"), F.max("gene").alias("b")).select(F.explode(F.array(F.struct(F.lit("first").alias("control"), F.col("a").alias("member")), F.struct(F.lit("last").alias("control"), F.col("b").alias("member")), F.struct(F.lit("none").alias("control"), F.lit("not there").alias("member")))).alias("x")).select("x.*")
    return downstream.control_outcomes(windows.benjamini_hochberg(_scan(spark, sf)), k, 1.0).withColumn("adjusted_p_value", F.round("adjusted_p_value", 6))


@q()
def s178_anchored_scan(spark, sf):
    """Product terms of every kind of determinant, all of them known, with every testable gene. A gene of the same name as a kind stays a gene."""
    kinds = _kinds(spark, sf).withColumn("feature", F.concat(F.lit("kind__"), "feature"))
    genes = presence(spark, sf).select(F.concat(F.lit("gene__"), "gene").alias("feature"), "sample_id")
    x = downstream.anchored_scan(kinds.unionByName(genes), kinds.select("feature").distinct(), _outcome(spark, sf), None)
    return x.withColumns({c: F.substr(c, F.lit(7)) for c in ("feature_a", "feature_b")})


@q()
def s181_evidence(spark, sf):
    """Gate, scan, conditional and stratified tests, lineages, pooled effect and tier of each gene."""
    f, known = _features_with_known(spark, sf)
    gate = known.agg(F.min("feature").alias("member")).select(F.lit("known").alias("control"), "member")
    gate = gate.join(stats.testable(f, _outcome(spark, sf)).select(F.col("feature").alias("m")), F.col("member") == F.col("m"), "left_semi")
    gate = gate.select("control", F.substr("member", F.lit(8)).alias("member"))
    return downstream.evidence(f, _design(spark, sf), samples(spark, sf).select("sample_id", "lineage"), ["l01", "clinical"], gate, known, gate_alpha=1.0)


# feature layers


@q("""SELECT sample_id, CASE WHEN bool_or(coalesce(mechanism = 'porin_loss' AND variant IS NULL, false)) THEN 'absent' WHEN bool_or(coalesce(mechanism = 'porin_loss' AND contains(variant, '*'), false)) THEN 'tier1' WHEN bool_or(coalesce(mechanism = 'porin_loss', false)) THEN 'tier2' ELSE 'on' END AS state FROM calls WHERE sample_id IS NOT NULL GROUP BY 1""")
def s188_locus_tiers(spark, sf):
    porin = F.coalesce(F.col("mechanism") == "porin_loss", F.lit(False))
    rank = F.when(porin & F.col("variant").isNull(), "absent").when(porin & F.contains("variant", F.lit("*")), "tier1").when(porin, "tier2").otherwise("on")
    from isolake.operators.aggregates import max_by_rank

    return max_by_rank(calls(spark, sf, "sample_id", "variant", "mechanism").where("sample_id IS NOT NULL").withColumn("s", rank), ["sample_id"], "s", ["absent", "tier1", "tier2", "on"], "state")


@q(r"""SELECT DISTINCT sample_id, 'pump__' || regexp_extract(gene, '^(mex[A-Z])', 1) AS feature, 1 AS value FROM calls WHERE sample_id IS NOT NULL AND regexp_matches(gene, '^mex[A-Z]') AND variant IS NOT NULL""")
def s189_pump_groups(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "variant").where(F.col("gene").rlike("^mex[A-Z]") & F.col("variant").isNotNull() & F.col("sample_id").isNotNull())
    return c.select("sample_id", F.concat(F.lit("pump__"), F.regexp_extract("gene", "^(mex[A-Z])", 1)).alias("feature")).distinct().withColumn("value", F.lit(1))


@q("""SELECT feature, count(DISTINCT sample_id) AS carriers FROM (SELECT sample_id, 'gene__' || gene AS feature FROM presence UNION SELECT sample_id, 'amr__' || gene || CASE WHEN variant IS NULL THEN '' ELSE '_' || variant END FROM calls WHERE gene IS NOT NULL AND sample_id IS NOT NULL UNION SELECT sample_id, 'mechanism__' || mechanism FROM calls WHERE mechanism IS NOT NULL AND sample_id IS NOT NULL)
GROUP BY feature HAVING count(DISTINCT sample_id) >= 5 AND count(DISTINCT sample_id) <= 0.98 * (SELECT count(DISTINCT sample_id) FROM samples)""")
def s194_encode_layers(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "variant", "mechanism").where("sample_id IS NOT NULL")
    layers = feat.gene_features(presence(spark, sf)).unionByName(feat.determinant_features(c.where("gene IS NOT NULL")))
    layers = layers.unionByName(c.where("mechanism IS NOT NULL").select("sample_id", F.concat(F.lit("mechanism__"), "mechanism").alias("feature")).distinct().withColumn("value", F.lit(1)))
    n = samples(spark, sf).select("sample_id").distinct().count()
    return feat.drop_rule(layers, n).where("dropped IS NULL").select("feature", "carriers")


QUERIES, ORACLE = q.queries, q.oracle
