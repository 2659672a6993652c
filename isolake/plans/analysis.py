"""Queries of aggregations, windows, statistics and feature engineering (2.6 to 2.9 of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.functions import scalars as fn
from isolake.operators import aggregates as agg
from isolake.operators import features as feat
from isolake.operators import stats, windows
from isolake.plans.relational import _SEQS, _sequences
from isolake.plans.views import Catalogue, calls, phenotypes, presence, samples, table

q = Catalogue()


# 2.6 aggregations


@q(f""", {_SEQS} SELECT source, count(*) AS contigs, sum(length(seq)) AS size, max(length(seq)) AS largest, round(100.0 * sum(length(seq) - length(translate(seq, 'GC', ''))) / sum(length(seq)), 4) AS gc_percent, 0 AS ambiguous FROM seqs GROUP BY source""")
def s112_assembly_stats(spark: SparkSession, sf: str) -> DataFrame:
    return agg.base_counts(_sequences(spark, sf), ["source"])


@q("""SELECT source, min(n50) AS n50, min(n90) AS n90 FROM (SELECT source, CASE WHEN run >= 0.5 * total THEN n_chars END AS a, CASE WHEN run >= 0.9 * total THEN n_chars END AS b, max(CASE WHEN run >= 0.5 * total THEN n_chars END) OVER (PARTITION BY source) AS n50, max(CASE WHEN run >= 0.9 * total THEN n_chars END) OVER (PARTITION BY source) AS n90
FROM (SELECT source, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC) AS run, sum(n_chars) OVER (PARTITION BY source) AS total FROM documents WHERE source IS NOT NULL AND n_chars IS NOT NULL)) GROUP BY source""")
def s113_nxx(spark, sf):
    d = table(spark, sf, "documents").where("source IS NOT NULL")
    a, b = agg.nxx(d, ["source"], "n_chars", 0.5, "n50"), agg.nxx(d, ["source"], "n_chars", 0.9, "n90")
    return a.join(b, "source")


@q(""", s AS (SELECT lang, length(text) AS n, length(text) - length(replace(text, ' ', '')) AS gaps FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL) SELECT lang, count(*) AS sequences, max(n) AS max_sites, round(sum(gaps)::DOUBLE / sum(n), 6) AS gap_fraction FROM s GROUP BY lang""")
def s114_alignment_summary(spark, sf):
    d = table(spark, sf, "documents").where("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.length("text").alias("n"), (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("gaps"))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("sequences"), F.max("n").alias("max_sites"), F.round(F.sum("gaps") / F.sum("n"), 6).alias("gap_fraction"))


@q(""", n AS (SELECT count(DISTINCT l_suppkey) AS n FROM lineitem), m AS (SELECT l_partkey % 500 AS site, l_returnflag AS alt, count(DISTINCT l_suppkey) AS ac FROM lineitem GROUP BY ALL) SELECT site, alt, ac, n AS an, round(ac::DOUBLE / n, 6) AS af FROM m, n WHERE ac >= 2 AND ac::DOUBLE / n <= least(0.5, 1 - 2.0::DOUBLE / n)""")
def s115_variant_merge(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_partkey") % 500).alias("site"), F.col("l_returnflag").alias("alt"), F.col("l_suppkey").alias("sample_id"))
    return agg.variant_merge(li, ["site", "alt"], li.select("sample_id").distinct().count(), 0.5).withColumn("af", F.round("af", 6))


@q("SELECT sample_id, count(*) AS n_calls, count(*) FILTER (determinant_type = 'point') AS point, count(*) FILTER (variant IS NOT NULL) AS with_variant, grouping(sample_id)::INT AS total FROM calls WHERE sample_id IS NOT NULL GROUP BY ROLLUP (sample_id)")
def s116_provenance_totals(spark, sf):
    c = calls(spark, sf, "sample_id", "variant", "determinant_type").where("sample_id IS NOT NULL")
    return c.rollup("sample_id").agg(F.count(F.lit(1)).alias("n_calls"), F.count_if(F.col("determinant_type") == "point").alias("point"), F.count_if(F.col("variant").isNotNull()).alias("with_variant"), F.grouping("sample_id").cast("int").alias("total"))


@q("""SELECT sample_id, gene, (['absent','disrupted','variant','intact'])[min(CASE WHEN mechanism = 'porin_loss' AND variant IS NOT NULL THEN 2 WHEN mechanism = 'porin_loss' THEN 1 WHEN variant IS NOT NULL THEN 3 ELSE 4 END)] AS status FROM calls WHERE sample_id IS NOT NULL AND gene IS NOT NULL GROUP BY ALL""")
def s117_locus_status(spark, sf):
    s = F.when((F.col("mechanism") == "porin_loss") & F.col("variant").isNotNull(), "disrupted").when(F.col("mechanism") == "porin_loss", "absent").when(F.col("variant").isNotNull(), "variant").otherwise("intact")
    c = calls(spark, sf, "sample_id", "gene", "variant", "mechanism").where("sample_id IS NOT NULL AND gene IS NOT NULL").withColumn("s", s)
    return agg.max_by_rank(c, ["sample_id", "gene"], "s", ["absent", "disrupted", "variant", "intact"], "status")


@q("""SELECT d AS disposition, count(c.call_id) AS n FROM (VALUES ('no_sample'),('no_gene'),('low_identity'),('low_coverage'),('kept')) v(d) LEFT JOIN (SELECT call_id, CASE WHEN sample_id IS NULL THEN 'no_sample' WHEN gene IS NULL THEN 'no_gene' WHEN identity_pct < 90 THEN 'low_identity' WHEN coverage_pct < 90 THEN 'low_coverage' ELSE 'kept' END AS x FROM calls) c ON x = d GROUP BY d""")
def s118_screen_accounting(spark, sf):
    return feat.disposition_counts(calls(spark, sf, "sample_id", "gene", "identity_pct", "coverage_pct"), [("no_sample", F.col("sample_id").isNull()), ("no_gene", F.col("gene").isNull()), ("low_identity", F.col("identity_pct") < 90), ("low_coverage", F.col("coverage_pct") < 90)])


@q("SELECT mechanism, count(*) AS n FROM calls WHERE claim_status = 'PREDICTED' AND mechanism IS NOT NULL GROUP BY 1")
def s119_class_counts(spark, sf):
    return calls(spark, sf, "mechanism", "claim_status").where("claim_status = 'PREDICTED' AND mechanism IS NOT NULL").groupBy("mechanism").agg(F.count(F.lit(1)).alias("n"))


@q("SELECT mechanism, count(DISTINCT sample_id) AS samples, count(*) AS calls FROM calls GROUP BY 1")
def s120_distributions(spark, sf):
    return calls(spark, sf, "sample_id", "mechanism").groupBy("mechanism").agg(F.countDistinct("sample_id").alias("samples"), F.count(F.lit(1)).alias("calls"))


@q(""", f AS (SELECT DISTINCT gene AS feature, sample_id FROM calls WHERE gene IS NOT NULL AND sample_id IS NOT NULL), c AS (SELECT sample_id, phenotype AS category FROM phenotypes WHERE phenotype IS NOT NULL), t AS (SELECT category, count(*) AS total FROM c GROUP BY 1)
SELECT feature, category, count(c.sample_id) AS carriers, any_value(total) AS total FROM (SELECT DISTINCT feature FROM f) x CROSS JOIN t LEFT JOIN (SELECT feature, category, c.sample_id FROM f JOIN c USING (sample_id)) c USING (feature, category) GROUP BY feature, category""")
def s121_crosstab(spark, sf):
    f = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL AND sample_id IS NOT NULL").select(F.col("gene").alias("feature"), "sample_id")
    return agg.crosstab(f, phenotypes(spark, sf).select("sample_id", F.col("phenotype").alias("category")))


@q("SELECT mechanism, phenotype, count(*) AS n FROM (SELECT DISTINCT sample_id, mechanism FROM calls WHERE mechanism IS NOT NULL) JOIN phenotypes USING (sample_id) WHERE phenotype IS NOT NULL GROUP BY ALL")
def s122_state_counts(spark, sf):
    m = calls(spark, sf, "sample_id", "mechanism").where("mechanism IS NOT NULL").select("sample_id", "mechanism").distinct()
    return m.join(phenotypes(spark, sf).where("phenotype IS NOT NULL"), "sample_id").groupBy("mechanism", "phenotype").agg(F.count(F.lit(1)).alias("n"))


_CLASSES = ("efflux", "enzyme", "porin_loss", "target_change")


@q("SELECT sample_id, " + ", ".join(f"max((mechanism = '{m}')::INT) AS {m}" for m in _CLASSES) + " FROM calls WHERE sample_id IS NOT NULL AND mechanism IS NOT NULL GROUP BY 1")
def s123_presence_matrix(spark, sf):
    c = calls(spark, sf, "sample_id", "mechanism").where("sample_id IS NOT NULL AND mechanism IS NOT NULL").select("sample_id", "mechanism").distinct().withColumn("one", F.lit(1))
    return c.groupBy("sample_id").pivot("mechanism", list(_CLASSES)).agg(F.max("one")).na.fill(0)


@q("SELECT sample_id, string_agg(DISTINCT mechanism, ',' ORDER BY mechanism) AS mechanisms, count(DISTINCT gene) AS genes FROM calls WHERE sample_id IS NOT NULL GROUP BY 1")
def s124_tip_annotation(spark, sf):
    return calls(spark, sf, "sample_id", "gene", "mechanism").where("sample_id IS NOT NULL").groupBy("sample_id").agg(fn.sorted_set(F.col("mechanism")).alias("mechanisms"), F.countDistinct("gene").alias("genes"))


@q(""", d AS (SELECT DISTINCT sample_id, gene, mechanism FROM calls WHERE sample_id IS NOT NULL AND gene IS NOT NULL), g AS (SELECT DISTINCT sample_id, gene FROM d), p AS (SELECT x.gene AS a, y.gene AS b FROM g x JOIN g y ON x.sample_id = y.sample_id AND x.gene < y.gene GROUP BY ALL HAVING count(*) >= 5), e AS (SELECT a AS gene FROM p UNION ALL SELECT b FROM p)
SELECT e.gene, count(*) AS degree, any_value(t.types) AS types FROM e LEFT JOIN (SELECT gene, string_agg(DISTINCT mechanism, ',' ORDER BY mechanism) AS types FROM d GROUP BY 1) t USING (gene) GROUP BY e.gene""")
def s125_network_nodes(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "mechanism").where("sample_id IS NOT NULL AND gene IS NOT NULL")
    p = stats.pair_counts(c.select("sample_id", F.col("gene").alias("name"))).where("n_both >= 5")
    e = p.select(F.explode(F.array("feature_a", "feature_b")).alias("gene")).groupBy("gene").agg(F.count(F.lit(1)).alias("degree"))
    return e.join(c.groupBy("gene").agg(fn.sorted_set(F.col("mechanism")).alias("types")), "gene", "left")


@q(""", t AS (SELECT count(*) AS n, count(*) FILTER (phenotype = 'R') AS r, count(*) FILTER (phenotype = 'S') AS s FROM phenotypes) SELECT gene, count(DISTINCT sample_id) AS n, round(count(DISTINCT sample_id)::DOUBLE / any_value(t.n), 6) AS freq, round(count(DISTINCT sample_id) FILTER (phenotype = 'R')::DOUBLE / any_value(r), 6) AS freq_r, round(count(DISTINCT sample_id) FILTER (phenotype = 'S')::DOUBLE / any_value(s), 6) AS freq_s FROM calls JOIN phenotypes USING (sample_id), t WHERE gene IS NOT NULL GROUP BY gene""")
def s126_gene_frequency(spark, sf):
    p = phenotypes(spark, sf)
    t = p.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("phenotype") == "R").alias("r"), F.count_if(F.col("phenotype") == "S").alias("s")).first()
    j = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL").select("gene", "sample_id").distinct().join(p, "sample_id")
    share = lambda c, total: F.round(F.try_divide(c.cast("double"), F.lit(total)), 6)
    return j.groupBy("gene").agg(F.count(F.lit(1)).alias("n"), share(F.count(F.lit(1)), t.n).alias("freq"), share(F.count_if(F.col("phenotype") == "R"), t.r).alias("freq_r"), share(F.count_if(F.col("phenotype") == "S"), t.s).alias("freq_s"))


@q(""", s AS (SELECT sample_id, list_sort(list(DISTINCT mechanism)) AS s FROM calls WHERE mechanism IS NOT NULL AND sample_id IS NOT NULL GROUP BY 1), m AS (SELECT s, unnest(generate_series(1, (1 << len(s)) - 1)) AS m FROM s)
SELECT array_to_string(list_filter(s, lambda x, i: (m >> (i - 1)) & 1 = 1), '+') AS combination, count(*) AS samples FROM m GROUP BY 1""")
def s127_mechanism_combinations(spark, sf):
    return agg.combinations(calls(spark, sf, "sample_id", "mechanism").where("sample_id IS NOT NULL"), "sample_id", "mechanism")


@q(""", d AS (SELECT DISTINCT sample_id, mechanism AS m FROM calls WHERE sample_id IS NOT NULL AND mechanism IS NOT NULL) SELECT x.m AS a, y.m AS b, count(*) AS samples, round(count(*)::DOUBLE / (SELECT count(DISTINCT sample_id) FROM d), 6) AS freq FROM d x JOIN d y ON x.sample_id = y.sample_id AND x.m < y.m GROUP BY ALL""")
def s128_pair_frequency(spark, sf):
    p = stats.pair_counts(calls(spark, sf, "sample_id", "mechanism").where("sample_id IS NOT NULL AND mechanism IS NOT NULL").select("sample_id", F.col("mechanism").alias("name")))
    return p.select(F.col("feature_a").alias("a"), F.col("feature_b").alias("b"), F.col("n_both").alias("samples"), F.round(F.col("n_both") / F.col("n"), 6).alias("freq"))


@q("SELECT phenotype, count(*) AS n, count(*) FILTER (antibiotic IS NULL) AS no_antibiotic FROM phenotypes GROUP BY 1")
def s129_phenotype_report(spark, sf):
    return phenotypes(spark, sf).groupBy("phenotype").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("antibiotic").isNull()).alias("no_antibiotic"))


@q("SELECT count(*) FILTER (phenotype = 'R') AS r, count(*) FILTER (phenotype = 'I') AS i, count(*) FILTER (phenotype = 'S') AS s, count(*) FILTER (phenotype = 'R') >= 5 AND count(*) FILTER (phenotype = 'S') >= 5 AS enough FROM phenotypes WHERE sample_id IN (SELECT sample_id FROM samples)")
def s130_group_sizes(spark, sf):
    p = phenotypes(spark, sf).join(samples(spark, sf).select("sample_id").distinct(), "sample_id", "left_semi")
    n = lambda x: F.count_if(F.col("phenotype") == x)
    return p.agg(n("R").alias("r"), n("I").alias("i"), n("S").alias("s"), ((n("R") >= 5) & (n("S") >= 5)).alias("enough"))


@q("SELECT regexp_extract(exclusion_reason, '^([a-z]+)', 1) AS reason, count(*) AS n FROM (SELECT DISTINCT * FROM pilot100_manifest) WHERE analysis_included = 'FALSE' GROUP BY 1")
def s131_exclusion_breakdown(spark, sf):
    return table(spark, sf, "pilot100_manifest").distinct().where("analysis_included = 'FALSE'").groupBy(F.regexp_extract("exclusion_reason", "^([a-z]+)", 1).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@q("SELECT trim(antibiotic) AS value, count(*) AS n FROM calls WHERE trim(antibiotic) <> '' GROUP BY 1")
def s132_value_counts(spark, sf):
    return agg.value_counts(calls(spark, sf, "antibiotic"), "antibiotic")


@q("""SELECT gene, string_agg(l || '=' || n, ';' ORDER BY l) AS distribution FROM (SELECT gene, coalesce(lineage, 'unknown') AS l, count(*) AS n FROM (SELECT DISTINCT c.gene, c.sample_id, s.lineage FROM calls c JOIN samples s USING (sample_id) WHERE gene IS NOT NULL) GROUP BY ALL) GROUP BY gene""")
def s133_lineage_distribution(spark, sf):
    d = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL").select("gene", "sample_id").distinct().join(samples(spark, sf).select("sample_id", "lineage").distinct(), "sample_id")
    return agg.distribution_map(d, ["gene"], "lineage", "m").select("gene", fn.format_cell(F.col("m"), "map").alias("distribution"))


@q("SELECT gene, string_agg(DISTINCT sample_id, ',' ORDER BY sample_id) AS carriers FROM calls WHERE gene IS NOT NULL AND sample_id IS NOT NULL GROUP BY 1")
def s134_carrier_inversion(spark, sf):
    return calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL AND sample_id IS NOT NULL").groupBy("gene").agg(fn.sorted_set(F.col("sample_id")).alias("carriers"))


def _tree(spark, sf):
    """The tree world - region - nation - customer as edges (node, parent, length)."""
    n = table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), (F.col("n_nationkey") + 1).cast("double").alias("length"))
    r = table(spark, sf, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.lit("root").alias("parent"), (F.col("r_regionkey") * 2 + 1).cast("double").alias("length"))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.concat(F.lit("n"), "s_nationkey").alias("parent"), (F.col("s_suppkey") % 7).cast("double").alias("length"))
    root = spark.createDataFrame([("root", None, None)], "node string, parent string, length double")
    return root.unionByName(r).unionByName(n).unionByName(s)


_TREE = """WITH RECURSIVE edges AS (SELECT 'root' AS node, NULL::VARCHAR AS parent, NULL::DOUBLE AS length UNION ALL SELECT 'r' || r_regionkey, 'root', (r_regionkey * 2 + 1)::DOUBLE FROM region
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, (n_nationkey + 1)::DOUBLE FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, (s_suppkey % 7)::DOUBLE FROM supplier),
up(below, above) AS (SELECT node, node FROM edges UNION ALL SELECT below, parent FROM up JOIN edges ON node = above WHERE parent IS NOT NULL)"""


@q(_TREE + " SELECT above AS node, round(avg(length), 6) AS mean_length, count(*) AS edges FROM up JOIN edges ON node = below WHERE length IS NOT NULL GROUP BY 1")
def s135_clade_means(spark, sf):
    return agg.clade_means(_tree(spark, sf)).withColumn("mean_length", F.round("mean_length", 6))


_COLUMNS = "s AS (SELECT i, substr(seq, i, 1) AS b FROM (SELECT seq, unnest(generate_series(1, length(seq))) AS i FROM seqs))"


@q(f", {_SEQS}, {_COLUMNS} SELECT i::INT AS pos, string_agg(DISTINCT b, '' ORDER BY b) AS bases, count(*) AS covered FROM s GROUP BY i HAVING count(DISTINCT b) > 1")
def s136_variable_columns(spark, sf):
    return agg.segregating_columns(_sequences(spark, sf).select(F.col("doc_id").alias("header"), "seq"))


@q(f", {_SEQS}, {_COLUMNS} SELECT i::INT AS pos, string_agg(DISTINCT b, '' ORDER BY b) AS bases, count(*) AS covered FROM s GROUP BY i HAVING count(DISTINCT b) > 1 AND count(*) >= round((SELECT count(*) FROM seqs) * 0.5)")
def s137_segregating_floor(spark, sf):
    return agg.segregating_columns(_sequences(spark, sf).select(F.col("doc_id").alias("header"), "seq"), floor=0.5)


@q("""SELECT stage, count(ended_at) AS finished, round(date_diff('microsecond', min(started_at), max(ended_at)) / 1e6, 3) AS span_s, round(median(CASE WHEN ended_at IS NOT NULL THEN date_diff('microsecond', started_at, ended_at) / 1e6 END), 3) AS median_s,
 CASE WHEN count(ended_at) >= 3 THEN round(3600.0 * count(ended_at) / (date_diff('microsecond', min(started_at), max(ended_at)) / 1e6), 6) END AS per_hour FROM (SELECT DISTINCT * FROM execution) GROUP BY stage""")
def s138_throughput(spark, sf):
    t = agg.throughput(table(spark, sf, "execution").distinct(), ["stage"], "started_at", "ended_at")
    return t.select("stage", "finished", F.round("span_s", 3).alias("span_s"), F.round("median_s", 3).alias("median_s"), F.round("per_hour", 6).alias("per_hour"))


@q("SELECT subject, (['FAILED','INVALID','INCOMPLETE','RUNNING','SUCCEEDED'])[min(coalesce(list_position(['FAILED','INVALID','INCOMPLETE','RUNNING','SUCCEEDED'], state), 6))] AS state FROM execution GROUP BY 1")
def s139_state_rollup(spark, sf):
    return agg.max_by_rank(table(spark, sf, "execution"), ["subject"], "state", ["FAILED", "INVALID", "INCOMPLETE", "RUNNING", "SUCCEEDED"], "state")


@q("SELECT gene, (['UNKNOWN','DETECTED','PREDICTED','ASSOCIATED','SUPPORTED'])[max(coalesce(list_position(['UNKNOWN','DETECTED','PREDICTED','ASSOCIATED','SUPPORTED'], claim_status), 1))] AS claim FROM calls WHERE gene IS NOT NULL GROUP BY 1")
def s140_claim_rollup(spark, sf):
    return calls(spark, sf, "gene", "claim_status").where("gene IS NOT NULL").groupBy("gene").agg(fn.claim_of(F.max(fn.claim_rank(F.col("claim_status")))).alias("claim"))


@q(", v AS (SELECT gene, string_agg(sample_id, ',' ORDER BY sample_id) AS s FROM presence GROUP BY 1) SELECT count(DISTINCT s) AS patterns, count(*) AS features FROM v")
def s141_pattern_count(spark, sf):
    return agg.pattern_count(presence(spark, sf), "gene", "sample_id")


# 2.7 windows, sort, top-k

def _fisher_sql(source: str) -> str:
    """SQL of exact p values for (..., a, k, n1, n) rows of `source`."""
    lf = lambda x: f"lgamma(({x}) + 1)"
    pmf = lambda x: f"({lf('n1')} - {lf(x)} - {lf(f'n1 - {x}')} + {lf('n - n1')} - {lf(f'k - {x}')} - {lf(f'n - n1 - k + {x}')} - ({lf('n')} - {lf('k')} - {lf('n - k')}))"
    x = "x::DOUBLE"
    return f"""SELECT * EXCLUDE (ps), least(1.0, list_sum(ps)) AS p FROM (SELECT *, list_transform(list_filter(generate_series(greatest(0, k + n1 - n), least(k, n1)), lambda x: {pmf(x)} <= {pmf('a')} + 1e-7), lambda x: exp({pmf(x)})) AS ps FROM {source})"""


_SCAN = """o AS (SELECT sample_id, CASE phenotype WHEN 'R' THEN 1 WHEN 'S' THEN 0 END AS y FROM phenotypes WHERE phenotype IN ('R', 'S')), tot AS (SELECT count(*) AS n, sum(y) AS n1 FROM o),
t2 AS (SELECT gene AS feature, sum(y)::BIGINT AS a, count(*) AS k FROM (SELECT DISTINCT gene, sample_id FROM presence) JOIN o USING (sample_id) GROUP BY 1), t3 AS (SELECT feature, a, k, n1::BIGINT AS n1, n FROM t2, tot WHERE k >= 2 AND k <= 0.95 * n)"""
_TESTED = f"{_SCAN}, tested AS ({_fisher_sql('t3')})"
_ADJUSTED = f"{_TESTED}, ranked AS (SELECT *, p * (SELECT count(*) FROM tested) / count(*) OVER (ORDER BY p) AS raw FROM tested), adj AS (SELECT *, least(1.0, min(raw) OVER (ORDER BY p DESC)) AS adjusted FROM ranked)"


def _scan(spark, sf) -> DataFrame:
    p = presence(spark, sf).select(F.col("gene").alias("feature"), "sample_id")
    o = phenotypes(spark, sf).select("sample_id", fn.binarise(F.col("phenotype"), ["R"], ["S"]).alias("y"))
    return stats.association_scan(p, o)


@q(f", {_ADJUSTED} SELECT feature, round(p, 6) AS p_value, round(adjusted, 6) AS adjusted_p_value FROM adj")
def s142_benjamini_hochberg(spark, sf):
    return windows.benjamini_hochberg(_scan(spark, sf)).select("feature", F.round("p_value", 6).alias("p_value"), F.round("adjusted_p_value", 6).alias("adjusted_p_value"))


_BLOCKS = """b AS (SELECT o_custkey AS contig, o_orderkey AS k, epoch(o_orderdate)::BIGINT // 86400 AS qs, epoch(o_orderdate)::BIGINT // 86400 + 5 AS qe, (o_orderkey * 37 % 9000) AS rs, (o_orderkey * 37 % 9000) + 5 AS re FROM orders)"""


@q(f", {_BLOCKS}, g AS (SELECT *, lead(qs) OVER w - qe AS q_gap, lead(rs) OVER w - re AS r_gap FROM b WINDOW w AS (PARTITION BY contig ORDER BY qs, k)) SELECT contig, k, q_gap, r_gap, CASE WHEN q_gap >= 30 AND q_gap > 4 * r_gap THEN 'insertion' ELSE 'deletion' END AS kind FROM g WHERE q_gap >= 0 AND r_gap >= 0 AND ((q_gap >= 30 AND q_gap > 4 * r_gap) OR (r_gap >= 30 AND r_gap > 4 * q_gap))")
def s144_gap_calls(spark, sf):
    day = F.floor(F.unix_timestamp("o_orderdate") / 86400)
    b = table(spark, sf, "orders").select(F.col("o_custkey").alias("contig"), F.col("o_orderkey").alias("k"), day.alias("qs"), (day + 5).alias("qe"), (F.col("o_orderkey") * 37 % 9000).alias("rs"), (F.col("o_orderkey") * 37 % 9000 + 5).alias("re"))
    return windows.call_gaps(b, ["contig"], "qs", "qe", "rs", "re", 30, tie=["k"]).select("contig", "k", "q_gap", "r_gap", "kind")


@q("""SELECT c_custkey, part, from_pos, to_pos FROM (SELECT c_custkey, 20000 AS n, min(d) AS s, max(d) + 5 AS e FROM customer LEFT JOIN (SELECT o_custkey, epoch(o_orderdate)::BIGINT // 86400 AS d FROM orders) o ON o_custkey = c_custkey GROUP BY 1) x,
LATERAL (SELECT 'whole' AS part, 1 AS from_pos, n AS to_pos WHERE s IS NULL UNION ALL SELECT 'head', 1, s - 1 WHERE s - 1 >= 500 UNION ALL SELECT 'tail', e + 1, n WHERE n - e >= 500) t""")
def s145_unassessable_ends(spark, sf):
    day = F.floor(F.unix_timestamp("o_orderdate") / 86400)
    blocks = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), day.alias("s"), (day + 5).alias("e"))
    contigs = table(spark, sf, "customer").select("c_custkey", F.lit(20000).alias("n"))
    return windows.unassessable_ends(contigs, blocks, "c_custkey", "n", "s", "e", 500)


@q("""SELECT antibiotic, floor, count(*) FILTER (identity_pct >= floor) AS passed, count(*) AS total FROM calls, (VALUES (85.0::DOUBLE), (90.0), (95.0), (99.0)) f(floor) WHERE antibiotic IS NOT NULL GROUP BY ALL""")
def s150_threshold_sweep(spark, sf):
    return windows.threshold_sweep(calls(spark, sf, "antibiotic", "identity_pct").where("antibiotic IS NOT NULL"), "identity_pct", [85.0, 90.0, 95.0, 99.0], ["antibiotic"])


@q("SELECT call_id, confidence FROM calls ORDER BY confidence IS NULL DESC, try_cast(confidence AS DOUBLE) IS NULL DESC, try_cast(confidence AS DOUBLE) DESC, confidence DESC, call_id LIMIT 30 OFFSET 20")
def s151_page(spark, sf):
    from isolake import query

    return query.page(calls(spark, sf, "confidence"), query.PageRequest(columns=("call_id", "confidence"), sort="-confidence", offset=20, limit=30), tie=["call_id"])


@q(f", {_ADJUSTED} SELECT feature, round(p, 6) AS p_value, round(adjusted, 6) AS adjusted_p_value FROM adj ORDER BY round(adjusted, 9), round(p, 9), feature LIMIT 20")
def s152_top_associations(spark, sf):
    t = windows.benjamini_hochberg(_scan(spark, sf))
    return windows.top_k(t, [F.round("adjusted_p_value", 9), F.round("p_value", 9), "feature"], 20).select("feature", F.round("p_value", 6).alias("p_value"), F.round("adjusted_p_value", 6).alias("adjusted_p_value"))


@q(""", c AS (SELECT gene AS value, count(*) AS n FROM calls WHERE gene <> '' GROUP BY 1), h AS (SELECT * FROM c ORDER BY n DESC, value LIMIT 10) SELECT * FROM h UNION ALL SELECT NULL, sum(n) FROM c WHERE value NOT IN (SELECT value FROM h)""")
def s153_top_with_rest(spark, sf):
    return agg.value_counts(calls(spark, sf, "gene"), "gene", 10)


# 2.8 statistics


@q(f", {_TESTED} SELECT feature, a, k, n1, n, CASE WHEN (k - a) * (n1 - a) <> 0 THEN round(a::DOUBLE * (n - n1 - k + a) / ((k - a) * (n1 - a)), 6) END AS odds_ratio, round(p, 6) AS p_value FROM tested")
def s158_fisher_scan(spark, sf):
    return _scan(spark, sf).select("feature", "a", "k", "n1", "n", F.round("odds_ratio", 6).alias("odds_ratio"), F.round("p_value", 6).alias("p_value"))


@q("""SELECT gene, round(max(n)::DOUBLE / sum(n), 6) AS top_share, max(n)::DOUBLE / sum(n) >= 0.5 AS confounded FROM (SELECT gene, coalesce(lineage, 'unknown') AS l, count(*) AS n FROM (SELECT DISTINCT c.gene, c.sample_id, s.lineage FROM calls c JOIN samples s USING (sample_id) WHERE gene IS NOT NULL) GROUP BY ALL) GROUP BY gene""")
def s159_lineage_confounded(spark, sf):
    d = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL").select("gene", "sample_id").distinct().join(samples(spark, sf).select("sample_id", "lineage").distinct(), "sample_id")
    m = agg.distribution_map(d, ["gene"], "lineage", "m")
    total = F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda s, x: s + x)
    return m.select("gene", F.round(F.array_max(F.map_values("m")) / total, 6).alias("top_share"), stats.lineage_confounded(F.col("m"), 0.5).alias("confounded"))


@q(f", {_ADJUSTED} SELECT feature FROM adj WHERE adjusted <= 0.9")
def s160_significant(spark, sf):
    return windows.benjamini_hochberg(_scan(spark, sf)).where("adjusted_p_value <= 0.9").select("feature")


@q(f", {_TESTED}, v AS (SELECT gene, string_agg(sample_id, ',' ORDER BY sample_id) AS s FROM presence GROUP BY 1), c AS (SELECT count(DISTINCT s) AS patterns FROM v) SELECT feature, round(p, 6) AS p_value, round(0.05 / patterns, 9) AS threshold, p <= 0.05 / patterns AS passes FROM tested, c")
def s161_pattern_bonferroni(spark, sf):
    n = agg.pattern_count(presence(spark, sf), "gene", "sample_id").first().patterns
    return _scan(spark, sf).select("feature", F.round("p_value", 6).alias("p_value"), F.round(F.lit(0.05 / n), 9).alias("threshold"), (F.col("p_value") <= 0.05 / n).alias("passes"))


@q("""WITH a AS (SELECT item_id, upper(regexp_replace(text, '[^acgtACGT]', '', 'g')) AS seq FROM eval_items), s AS (SELECT item_id, i, substr(seq, i, 1) AS b FROM (SELECT item_id, seq, unnest(generate_series(1, length(seq))) AS i FROM a))
SELECT x.item_id AS a, y.item_id AS b, round(avg((x.b = y.b)::INT), 6) AS value FROM s x JOIN s y ON x.i = y.i AND x.item_id <= y.item_id GROUP BY ALL""")
def s163_identity_by_state(spark, sf):
    a = table(spark, sf, "eval_items").select(F.col("item_id").alias("header"), F.upper(F.regexp_replace("text", "[^acgtACGT]", "")).alias("seq"))
    return stats.identity_by_state(a).select("a", "b", F.round("value", 6).alias("value"))


@q(""", v AS (SELECT DISTINCT sample_id AS s, gene AS f FROM calls WHERE gene IS NOT NULL AND sample_id IN (SELECT sample_id FROM samples)) SELECT x.s AS a, y.s AS b, round(count(*)::DOUBLE / (SELECT count(DISTINCT f) FROM v), 6) AS value FROM v x JOIN v y ON x.f = y.f AND x.s <= y.s GROUP BY ALL""")
def s164_feature_kinship(spark, sf):
    v = calls(spark, sf, "sample_id", "gene").join(samples(spark, sf), "sample_id", "left_semi").where("gene IS NOT NULL").select("sample_id", F.col("gene").alias("feature")).distinct().withColumn("value", F.lit(1.0))
    return stats.feature_kinship(v).withColumn("value", F.round("value", 6))


@q(_TREE + """, depth AS (SELECT below AS node, sum(coalesce(length, 0)) AS depth FROM up JOIN edges ON node = above GROUP BY 1), t AS (SELECT below, above FROM up WHERE below LIKE 's%')
SELECT x.below AS a, y.below AS b, any_value(da.depth) + any_value(db.depth) - 2 * max(dl.depth) AS d FROM t x JOIN t y ON x.above = y.above AND x.below <= y.below JOIN depth dl ON dl.node = x.above JOIN depth da ON da.node = x.below JOIN depth db ON db.node = y.below GROUP BY ALL""")
def s165_patristic(spark, sf):
    e = _tree(spark, sf)
    return stats.patristic(e, e.where("node LIKE 's%'").select("node"))


@q(_TREE + """, depth AS (SELECT below AS node, sum(coalesce(length, 0)) AS depth FROM up JOIN edges ON node = above GROUP BY 1), t AS (SELECT below, above FROM up WHERE below LIKE 's%'),
d AS (SELECT x.below AS a, y.below AS b, (any_value(da.depth) + any_value(db.depth) - 2 * max(dl.depth)) ** 2 AS d2 FROM t x JOIN t y ON x.above = y.above JOIN depth dl ON dl.node = x.above JOIN depth da ON da.node = x.below JOIN depth db ON db.node = y.below GROUP BY ALL)
SELECT a, b, round(-0.5 * (d2 - avg(d2) OVER (PARTITION BY a) - avg(d2) OVER (PARTITION BY b) + avg(d2) OVER ()), 4) AS value FROM d""")
def s166_gower(spark, sf):
    e = _tree(spark, sf)
    return stats.tree_similarity(e, e.where("node LIKE 's%'").select("node")).withColumn("value", F.round("value", 4))


_PAIRS = """d AS (SELECT DISTINCT sample_id, gene FROM calls WHERE sample_id IS NOT NULL AND gene IS NOT NULL), m AS (SELECT gene, count(*) AS c FROM d GROUP BY 1), t0 AS (SELECT count(DISTINCT sample_id) AS n FROM d),
pc AS (SELECT x.gene AS feature_a, y.gene AS feature_b, count(*) AS a FROM d x JOIN d y ON x.sample_id = y.sample_id AND x.gene < y.gene GROUP BY ALL), pt AS (SELECT feature_a, feature_b, a, ma.c AS k, mb.c AS n1, n FROM pc JOIN m ma ON ma.gene = feature_a JOIN m mb ON mb.gene = feature_b, t0 WHERE ma.c < n AND mb.c < n)"""


@q(f", {_PAIRS}, pv AS ({_fisher_sql('pt')}), rk AS (SELECT *, p * (SELECT count(*) FROM pv) / count(*) OVER (ORDER BY p) AS raw FROM pv) SELECT feature_a, feature_b, k AS n_a, n1 AS n_b, a AS n_both, round(p, 5) AS p_value, round(least(1.0, min(raw) OVER (ORDER BY p DESC)), 4) AS adjusted_p_value FROM rk")
def s167_cooccurrence_test(spark, sf):
    c = calls(spark, sf, "sample_id", "gene").where("sample_id IS NOT NULL AND gene IS NOT NULL").select("sample_id", F.col("gene").alias("name"))
    p = stats.pair_counts(c).where("n_a < n AND n_b < n").withColumn("p_value", stats.fisher_p("n_both", "n_a", "n_b", "n"))
    return windows.benjamini_hochberg(p).select("feature_a", "feature_b", "n_a", "n_b", "n_both", F.round("p_value", 5).alias("p_value"), F.round("adjusted_p_value", 4).alias("adjusted_p_value"))


@q(f", {_PAIRS} SELECT feature_a, feature_b, a AS n_both FROM pc")
def s168_matrix_pair_counts(spark, sf):
    return stats.matrix_pair_counts(calls(spark, sf, "sample_id", "gene").where("sample_id IS NOT NULL AND gene IS NOT NULL").select("sample_id", F.col("gene").alias("name")), chunk=128)


@q("SELECT gene AS name, count(*) AS n_item FROM presence GROUP BY 1 HAVING count(*) >= ceil(round(0.05 * (SELECT count(DISTINCT sample_id) FROM presence), 9))")
def s169_admission(spark, sf):
    return stats.admit(presence(spark, sf).withColumnRenamed("gene", "name"), "sample_id", "name", 0.05, 100_000)


@q(""", l AS (SELECT DISTINCT sample_id, lineage FROM samples WHERE lineage IS NOT NULL), c AS (SELECT gene AS feature, count(*) AS carriers, count(DISTINCT lineage) AS independent_lineages FROM presence LEFT JOIN l USING (sample_id) GROUP BY 1)
SELECT feature, carriers, independent_lineages, CASE WHEN carriers::DOUBLE / (SELECT count(*) FROM l) > 0.75 THEN 'widespread' WHEN carriers <= 2 THEN 'rare' WHEN independent_lineages = 0 THEN 'unknown' WHEN independent_lineages < 2 THEN 'lineage_associated' ELSE 'recurrent' END AS category FROM c""")
def s170_convergence(spark, sf):
    return stats.convergence(presence(spark, sf).withColumnRenamed("gene", "feature"), samples(spark, sf).select("sample_id", "lineage"))


def _design(spark, sf) -> DataFrame:
    o = phenotypes(spark, sf).select("sample_id", fn.binarise(F.col("phenotype"), ["R"], ["S"]).alias("y")).where("y IS NOT NULL")
    l = samples(spark, sf).select("sample_id", (F.coalesce("lineage", F.lit("")) == "L01").cast("int").alias("l01"), (F.col("data_class") == "clinical").cast("int").alias("clinical")).distinct()
    return o.join(l, "sample_id").na.fill(0)


@q("SELECT CASE WHEN phenotype = 'R' THEN 1 WHEN phenotype = 'S' THEN 0 END AS y, count(DISTINCT sample_id) AS samples FROM phenotypes WHERE phenotype IN ('R', 'S') AND sample_id IS NOT NULL GROUP BY 1")
def s156_association_input(spark, sf):
    return stats.association_input(phenotypes(spark, sf), ["R"], ["S"]).groupBy("y").agg(F.count(F.lit(1)).alias("samples"))


def _outcome(spark, sf) -> DataFrame:
    return stats.association_input(phenotypes(spark, sf), ["R"], ["S"])


@q(f", {_SCAN} SELECT feature, k AS carriers FROM t3")
def s157_testable(spark, sf):
    return stats.testable(presence(spark, sf).select(F.col("gene").alias("feature"), "sample_id"), _outcome(spark, sf))


_CELLS = f", {_SCAN}, c AS (SELECT feature, n, k, a::DOUBLE AS a, (k - a)::DOUBLE AS b, (n1 - a)::DOUBLE AS c, (n - k - n1 + a)::DOUBLE AS d FROM t3)"
_FULL = "a * b * c * d > 0"


def _plain_scan(spark, sf) -> DataFrame:
    """Logistic fits without covariates, for which the estimates have a closed form."""
    o = _outcome(spark, sf)
    f = presence(spark, sf).select(F.col("gene").alias("feature"), "sample_id")
    return stats.conditional_scan(f.join(stats.testable(f, o), "feature", "left_semi"), o, [])


@q(_CELLS + f" SELECT feature, n, k AS carriers, round(ln(a * d / (b * c)), 5) + 0.0 AS beta FROM c WHERE {_FULL}")
def s171_logistic_fit(spark, sf):
    whole = _scan(spark, sf).where("odds_ratio > 0").select("feature")
    return _plain_scan(spark, sf).join(whole, "feature", "left_semi").select("feature", "n", "carriers", (F.round("beta", 5) + 0.0).alias("beta"))


@q(_CELLS + f" SELECT feature, round(ln(a * d / (b * c)) / sqrt(1 / a + 1 / b + 1 / c + 1 / d), 4) + 0.0 AS wald_z FROM c WHERE {_FULL}")
def s173_wald(spark, sf):
    whole = _scan(spark, sf).where("odds_ratio > 0").select("feature")
    return _plain_scan(spark, sf).join(whole, "feature", "left_semi").select("feature", (F.round("wald_z", 4) + 0.0).alias("wald_z"))


@q(f""", {_SCAN}, g AS (SELECT min(gene) AS g FROM presence), o2 AS (SELECT DISTINCT sample_id FROM o), x AS (SELECT sample_id, sample_id IN (SELECT sample_id FROM presence, g WHERE gene = g) AS x FROM o2),
h AS (SELECT DISTINCT gene, sample_id FROM presence WHERE sample_id IN (SELECT sample_id FROM o2)), m AS (SELECT gene AS feature, count(*) AS k, count(*) FILTER (x) AS kx FROM h JOIN x USING (sample_id) GROUP BY 1)
SELECT feature, k = (SELECT count(*) FROM x) OR (k = (SELECT count(*) FROM x WHERE x) AND kx = k) OR (kx = 0 AND k = (SELECT count(*) FROM x WHERE NOT x)) AS collinear FROM m""")
def s172_span_test(spark, sf):
    """Features that are the same for all samples, or tell no more than the first gene does."""
    p = presence(spark, sf)
    first = p.agg(F.min("gene")).scalar()
    x = p.where(F.col("gene") == first).select("sample_id", F.lit(1).alias("x"))
    design = _outcome(spark, sf).join(x, "sample_id", "left").na.fill(0, ["x"])
    return stats.conditional_scan(p.select(F.col("gene").alias("feature"), "sample_id"), design, ["x"]).select("feature", "collinear")


@q()
def s174_conditional_scan(spark, sf):
    """Likelihood-ratio and Wald tests by logistic fits given lineage and class, false-discovery adjusted."""
    f = calls(spark, sf, "sample_id", "gene").where("sample_id IS NOT NULL AND gene IS NOT NULL").select(F.col("gene").alias("feature"), "sample_id").distinct()
    d = _design(spark, sf)
    return windows.benjamini_hochberg(stats.conditional_scan(f.join(stats.testable(f, d), "feature", "left_semi"), d, ["l01", "clinical"]), "lrt_p")


_KNOWN = "mechanism = 'target_change' AND determinant_type = 'point'"


def _features_with_known(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(features, known): genes present, and determinants of the known kind as features of their own."""
    k = calls(spark, sf, "sample_id", "gene", "mechanism", "determinant_type").where(_KNOWN + " AND sample_id IS NOT NULL AND gene IS NOT NULL").select(F.concat(F.lit("known__"), "gene").alias("feature"), "sample_id").distinct()
    return presence(spark, sf).select(F.col("gene").alias("feature"), "sample_id").unionByName(k), k.select("feature").distinct()


@q(f""", o AS (SELECT DISTINCT sample_id, CASE phenotype WHEN 'R' THEN 1 WHEN 'S' THEN 0 END AS y FROM phenotypes WHERE phenotype IN ('R', 'S') AND sample_id NOT IN (SELECT sample_id FROM calls WHERE {_KNOWN} AND sample_id IS NOT NULL AND gene IS NOT NULL)), tot AS (SELECT count(*) AS n, sum(y) AS n1 FROM o),
t2 AS (SELECT gene AS feature, sum(y)::BIGINT AS a, count(*) AS k FROM presence JOIN o USING (sample_id) GROUP BY 1), t3 AS (SELECT feature, a, k, n1::BIGINT AS n1, n FROM t2, tot WHERE k >= 2 AND k <= 0.95 * n), tested AS ({_fisher_sql('t3')}) SELECT feature, a, k, round(p, 6) AS p_value FROM tested""")
def s175_stratified_scan(spark, sf):
    """The scan over the samples that lack all known determinants."""
    from isolake.operators import downstream

    f, known = _features_with_known(spark, sf)
    return downstream.stratified_scan(f, _outcome(spark, sf), known).select("feature", "a", "k", F.round("p_value", 6).alias("p_value"))


#: Declared pairs of kinds of determinants; the last names a kind that does not occur.
PAIRS = (("efflux/point", "porin_loss/point"), ("efflux/acquired", "target_change/point"), ("enzyme/acquired", "porin_loss/acquired"), ("enzyme/point", "target_change/acquired"), ("efflux/point", "not/there"))


def _kinds(spark, sf) -> DataFrame:
    c = calls(spark, sf, "sample_id", "mechanism", "determinant_type").where("sample_id IS NOT NULL AND mechanism IS NOT NULL AND determinant_type IS NOT NULL")
    return c.select(F.concat_ws("/", "mechanism", "determinant_type").alias("feature"), "sample_id").distinct()


@q(f", {_SCAN}, o2 AS (SELECT DISTINCT sample_id, y FROM o), f AS (SELECT DISTINCT mechanism || '/' || determinant_type AS f, sample_id FROM calls WHERE mechanism IS NOT NULL AND determinant_type IS NOT NULL AND sample_id IS NOT NULL), p(a, b) AS (VALUES {', '.join(str(p) for p in PAIRS)}),"
   """ s AS (SELECT p.a, p.b, y, sample_id IN (SELECT sample_id FROM f WHERE f = p.a) AS fa, sample_id IN (SELECT sample_id FROM f WHERE f = p.b) AS fb FROM p, o2),
c AS (SELECT a, b, count(*) FILTER (fa AND fb) AS n_both, count(*) FILTER (fa AND fb AND y = 1)::DOUBLE AS a1, count(*) FILTER (fa AND fb AND y = 0)::DOUBLE AS a0, count(*) FILTER (fa AND NOT fb AND y = 1)::DOUBLE AS b1, count(*) FILTER (fa AND NOT fb AND y = 0)::DOUBLE AS b0,
 count(*) FILTER (NOT fa AND fb AND y = 1)::DOUBLE AS c1, count(*) FILTER (NOT fa AND fb AND y = 0)::DOUBLE AS c0, count(*) FILTER (NOT fa AND NOT fb AND y = 1)::DOUBLE AS d1, count(*) FILTER (NOT fa AND NOT fb AND y = 0)::DOUBLE AS d0 FROM s GROUP BY ALL)
SELECT a AS feature_a, b AS feature_b, n_both, CASE WHEN a1 * a0 * b1 * b0 * c1 * c0 * d1 * d0 > 0 THEN round(ln(a1 / a0) - ln(b1 / b0) - ln(c1 / c0) + ln(d1 / d0), 4) END AS beta FROM c WHERE a1 * a0 * b1 * b0 * c1 * c0 * d1 * d0 > 0 OR n_both = 0""")  # fmt: skip
def s177_interactions(spark, sf):
    """Product terms of declared pairs: with all eight counts filled they have a closed form, which the SQL gives."""
    p = spark.createDataFrame(list(PAIRS), "feature_a string, feature_b string")
    x = windows.benjamini_hochberg(stats.interaction_scan(p, _kinds(spark, sf), _outcome(spark, sf)))
    return x.select("feature_a", "feature_b", "n_both", F.round("beta", 4).alias("beta"))


_META = """o AS (SELECT sample_id, CASE phenotype WHEN 'R' THEN 1 WHEN 'S' THEN 0 END AS y, lineage FROM phenotypes JOIN (SELECT DISTINCT sample_id, lineage FROM samples) USING (sample_id) WHERE phenotype IN ('R', 'S') AND lineage IS NOT NULL),
st AS (SELECT lineage, sum(y) AS n1, count(*) AS n FROM o GROUP BY 1), f AS (SELECT gene AS feature, lineage, sum(y) AS a, count(*) - sum(y) AS b FROM presence JOIN o USING (sample_id) GROUP BY ALL),
s AS (SELECT feature, a::DOUBLE AS a, b::DOUBLE AS b, (n1 - a)::DOUBLE AS c, (n - n1 - b)::DOUBLE AS d FROM f JOIN st USING (lineage)), s2 AS (SELECT *, CASE WHEN a * b * c * d = 0 THEN 0.5 ELSE 0 END AS z FROM s WHERE a + b > 0 AND c + d > 0 AND a + c > 0 AND b + d > 0),
s3 AS (SELECT feature, ln((a + z) * (d + z) / ((b + z) * (c + z))) AS l, 1 / (1 / (a + z) + 1 / (b + z) + 1 / (c + z) + 1 / (d + z)) AS w FROM s2)"""


@q(f", {_META} SELECT feature, count(*) AS strata, round(sum(w * l) / sum(w), 6) + 0.0 AS log_or, round(sqrt(1 / sum(w)), 6) AS se, round(greatest(0, sum(w * l * l) - sum(w * l) ** 2 / sum(w)), 5) + 0.0 AS q FROM s3 GROUP BY 1 HAVING count(*) >= 2")
def s179_meta_analysis(spark, sf):
    l = samples(spark, sf).where("lineage IS NOT NULL").select("sample_id", "lineage").distinct()
    o = phenotypes(spark, sf).select("sample_id", fn.binarise(F.col("phenotype"), ["R"], ["S"]).alias("y")).where("y IS NOT NULL").join(l, "sample_id")
    st = o.groupBy("lineage").agg(F.sum("y").alias("n1"), F.count(F.lit(1)).alias("n"))
    f = presence(spark, sf).join(o, "sample_id").groupBy(F.col("gene").alias("feature"), "lineage").agg(F.sum("y").alias("a"), (F.count(F.lit(1)) - F.sum("y")).alias("b"))
    strata = f.join(st, "lineage").select("feature", "a", "b", (F.col("n1") - F.col("a")).alias("c"), (F.col("n") - F.col("n1") - F.col("b")).alias("d"))
    m = stats.meta_analysis(strata)
    return m.select("feature", "strata", (F.round("log_or", 6) + 0.0).alias("log_or"), F.round("se", 6).alias("se"), (F.round("q", 5) + 0.0).alias("q"))


@q(""", g AS (SELECT gene, count(DISTINCT lineage) AS lineages, count(DISTINCT c.sample_id) AS carriers FROM calls c LEFT JOIN (SELECT DISTINCT sample_id, lineage FROM samples) s USING (sample_id) WHERE gene IS NOT NULL GROUP BY 1) SELECT gene, CASE WHEN carriers >= 20 AND lineages >= 5 THEN 'A' WHEN carriers >= 20 THEN 'B' WHEN carriers >= 5 THEN 'C' ELSE 'D' END AS tier FROM g""")
def s180_evidence_tier(spark, sf):
    g = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL").join(samples(spark, sf).select("sample_id", "lineage").distinct(), "sample_id", "left").groupBy("gene").agg(F.countDistinct("lineage").alias("l"), F.countDistinct("sample_id").alias("n"))
    return g.select("gene", stats.tier_of(F.col("n") >= 20, F.col("l"), F.col("n") >= 5, 5).alias("tier"))


# 2.9 feature engineering


@q("SELECT DISTINCT sample_id, 'gene__' || gene AS feature, 1 AS value FROM presence")
def s182_gene_features(spark, sf):
    return feat.gene_features(presence(spark, sf))


@q("SELECT DISTINCT sample_id, 'amr__' || gene || CASE WHEN variant IS NULL THEN '' ELSE '_' || variant END AS feature, 1 AS value FROM calls WHERE antibiotic = 'meropenem' AND sample_id IS NOT NULL AND gene IS NOT NULL")
def s183_determinant_features(spark, sf):
    return feat.determinant_features(calls(spark, sf, "sample_id", "antibiotic", "gene", "variant").where("gene IS NOT NULL"), "meropenem")


@q("""SELECT sample_id, 'locus__' || gene || '_lost' AS feature, CASE WHEN bool_and(coverage_pct IS NULL) THEN NULL ELSE max((mechanism = 'porin_loss' AND mechanism IS NOT NULL)::INT) END AS value FROM calls WHERE sample_id IS NOT NULL AND gene IS NOT NULL GROUP BY sample_id, gene""")
def s184_locus_features(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "mechanism", "coverage_pct").where("sample_id IS NOT NULL AND gene IS NOT NULL").groupBy("sample_id", "gene").agg(F.max(F.coalesce(F.col("mechanism") == "porin_loss", F.lit(False))).alias("lost"), F.count("coverage_pct").alias("seen"))
    return feat.locus_features(c.withColumn("status", F.when(F.col("seen") == 0, "not_assessed").when(F.col("lost"), "absent").otherwise("intact")))


@q("SELECT s.sample_id, " + ", ".join(f"coalesce(max((mechanism = '{m}')::INT), 0) AS mechanism__{m}" for m in _CLASSES) + " FROM (SELECT DISTINCT sample_id FROM samples) s LEFT JOIN calls USING (sample_id) GROUP BY 1")
def s185_feature_matrix(spark, sf):
    f = calls(spark, sf, "sample_id", "mechanism").where("sample_id IS NOT NULL AND mechanism IS NOT NULL").select("sample_id", F.concat(F.lit("mechanism__"), "mechanism").alias("feature")).distinct().withColumn("value", F.lit(1))
    return feat.feature_matrix(f, samples(spark, sf).select("sample_id").distinct(), feat.ordered_columns(f, ["mechanism"]))


@q("""SELECT DISTINCT sample_id, 'family__' || CASE WHEN starts_with(gene, 'bla') THEN 'beta_lactam' WHEN starts_with(gene, 'aac(6') THEN 'six' WHEN starts_with(gene, 'aac') THEN 'aminoglycoside' WHEN starts_with(gene, 'mex') THEN 'efflux' END AS feature, 1 AS value FROM calls WHERE sample_id IS NOT NULL AND (starts_with(gene, 'bla') OR starts_with(gene, 'aac') OR starts_with(gene, 'mex'))""")
def s186_prefix_families(spark, sf):
    fam = spark.createDataFrame([("beta_lactam", "bla"), ("six", "aac(6"), ("aminoglycoside", "aac"), ("efflux", "mex")], "family string, gene_prefix string")
    return feat.prefix_family_features(calls(spark, sf, "sample_id", "gene"), fam)


@q("""SELECT sample_id, unnest(list_filter([CASE WHEN bool_or(coalesce(starts_with(gene, 'mex') AND variant IS NOT NULL, false)) THEN 'pump_variant' END, CASE WHEN bool_or(coalesce(mechanism = 'efflux', false)) AND bool_or(coalesce(mechanism = 'porin_loss', false)) THEN 'efflux_and_porin' END,
 CASE WHEN bool_or(coalesce(variant = 'T83I', false)) OR bool_or(coalesce(starts_with(gene, 'qn'), false)) THEN 'target_any' END], lambda x: x IS NOT NULL)) AS feature, 1 AS value FROM calls WHERE sample_id IS NOT NULL GROUP BY 1""")
def s187_rule_features(spark, sf):
    rules = [
        feat.Rule("pump_variant", [F.col("gene").startswith("mex") & F.col("variant").isNotNull()]),
        feat.Rule("efflux_and_porin", [F.col("mechanism") == "efflux", F.col("mechanism") == "porin_loss"], "all"),
        feat.Rule("target_any", [F.col("variant") == "T83I", F.col("gene").startswith("qn")]),
    ]
    return feat.rule_features(calls(spark, sf, "sample_id", "gene", "variant", "mechanism"), rules)


@q("SELECT sample_id, CASE WHEN count(*) FILTER (determinant_type = 'point') > 0 THEN count(DISTINCT CASE WHEN determinant_type = 'point' THEN gene || '/' || coalesce(variant, '') END) ELSE 0 END AS distinct_pairs FROM calls WHERE sample_id IS NOT NULL GROUP BY 1")
def s190_distinct_pairs(spark, sf):
    pair = F.when(F.col("determinant_type") == "point", F.concat(F.col("gene"), F.lit("/"), F.coalesce("variant", F.lit(""))))
    return calls(spark, sf, "sample_id", "gene", "variant", "determinant_type").where("sample_id IS NOT NULL").groupBy("sample_id").agg(F.countDistinct(pair).alias("distinct_pairs"))


@q("SELECT 'gene__' || gene AS feature, count(*)::BIGINT AS carriers, CASE WHEN count(*) < 5 THEN 'carriers<5' WHEN count(*) > 0.98 * (SELECT count(DISTINCT sample_id) FROM samples) THEN 'prevalence>0.98' END AS dropped FROM presence GROUP BY gene")
def s191_drop_rule(spark, sf):
    return feat.drop_rule(feat.gene_features(presence(spark, sf)), samples(spark, sf).select("sample_id").distinct().count())


@q("SELECT sample_id, max((coverage_pct < 90)::INT) AS value FROM calls WHERE sample_id IS NOT NULL GROUP BY 1")
def s192_partial_flag(spark, sf):
    c = calls(spark, sf, "sample_id", "coverage_pct").where("sample_id IS NOT NULL").withColumn("partial", F.col("coverage_pct") < 90)
    return feat.partial_call_flag(c, "partial")


QUERIES, ORACLE = q.queries, q.oracle
