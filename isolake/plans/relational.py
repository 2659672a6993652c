"""Queries of scalar functions, joins and set operations (2.3 to 2.5 of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake import query
from isolake.functions import scalars as fn
from isolake.operators import joins, sets, windows
from isolake.plans.views import Catalogue, calls, phenotypes, presence, samples, table

q = Catalogue()
C = query.Clause


# 2.3 projection, filter, scalar functions


@q("SELECT call_id, gene, identity_pct, mechanism FROM calls WHERE identity_pct >= 95 AND trim(antibiotic) IN ('colistin', 'amikacin') AND mechanism IS NOT NULL AND (trim(confidence) <> 'low' OR confidence IS NULL)")
def s051_api_filter(spark: SparkSession, sf: str) -> DataFrame:
    request = query.PageRequest(clauses=(C("identity_pct", "min", "95"), C("antibiotic", "in", "colistin,amikacin"), C("mechanism", "null", "0"), C("confidence", "ne", "low")))
    return query.select_rows(calls(spark, sf, "antibiotic", "gene", "mechanism", "confidence", "identity_pct"), request).select("call_id", "gene", "identity_pct", "mechanism")


@q("SELECT call_id, gene, determinant FROM calls WHERE contains(lower(gene), 'mex') OR contains(lower(determinant), 'mex') OR contains(lower(mechanism), 'mex')")
def s052_search(spark, sf):
    return query.search(calls(spark, sf, "determinant", "gene", "mechanism"), " MEX ", ("gene", "determinant", "mechanism")).select("call_id", "gene", "determinant")


@q("SELECT call_id, antibiotic FROM calls")
def s053_projection(spark, sf):
    return calls(spark, sf, "antibiotic").select("call_id", "antibiotic")


@q("""SELECT call_id, array_to_string(list_filter([CASE WHEN identity_pct IS NULL THEN 'identity:not_measurable' WHEN identity_pct < 90 THEN 'identity:below' END,
 CASE WHEN coverage_pct IS NULL THEN 'coverage:not_measurable' WHEN coverage_pct < 90 THEN 'coverage:below' WHEN coverage_pct > 99.5 THEN 'coverage:above' END], lambda x: x IS NOT NULL), ';') AS reasons,
 CASE WHEN identity_pct >= 90 AND coverage_pct BETWEEN 90 AND 99.5 THEN 'pass' ELSE 'flagged' END AS status FROM calls""")
def s054_threshold_reasons(spark, sf):
    i, c = F.col("identity_pct"), F.col("coverage_pct")
    reasons = F.array_compact(F.array(F.when(i.isNull(), "identity:not_measurable").when(i < 90, "identity:below"), F.when(c.isNull(), "coverage:not_measurable").when(c < 90, "coverage:below").when(c > 99.5, "coverage:above")))
    return calls(spark, sf, "identity_pct", "coverage_pct").select("call_id", F.array_join(reasons, ";").alias("reasons"), F.when(F.size(reasons) == 0, "pass").otherwise("flagged").alias("status"))


@q("""SELECT sample_id, CASE WHEN assembly_path IS NULL THEN 'missing' WHEN NOT ends_with(assembly_path, '.fna') THEN 'wrong_suffix' WHEN withdrawn_at IS NOT NULL THEN 'withdrawn'
 WHEN lineage IS NULL THEN 'unplaced' ELSE 'ok' END AS verdict FROM (SELECT DISTINCT sample_id, assembly_path, withdrawn_at, lineage FROM sample_metadata)""")
def s055_ordered_verdict(spark, sf):
    d = table(spark, sf, "sample_metadata").select("sample_id", "assembly_path", "withdrawn_at", "lineage").distinct()
    v = F.when(F.col("assembly_path").isNull(), "missing").when(~F.endswith("assembly_path", F.lit(".fna")), "wrong_suffix").when(F.col("withdrawn_at").isNotNull(), "withdrawn").when(F.col("lineage").isNull(), "unplaced").otherwise("ok")
    return d.select("sample_id", v.alias("verdict"))


@q("""SELECT DISTINCT 'amr__' || gene AS feature, 'amr' AS kind, gene AS label FROM calls WHERE gene IS NOT NULL""")
def s056_feature_name_split(spark, sf):
    f = calls(spark, sf, "gene").where("gene IS NOT NULL").select(F.concat(F.lit("amr__"), "gene").alias("feature")).distinct()
    return f.select("feature", fn.feature_type(F.col("feature")).alias("kind"), fn.feature_label(F.col("feature")).alias("label"))


@q(r"SELECT DISTINCT determinant, upper(regexp_replace(split_part(determinant, '~', 1), '^bla', '')) AS token FROM calls WHERE determinant IS NOT NULL")
def s057_gene_token(spark, sf):
    return calls(spark, sf, "determinant").where("determinant IS NOT NULL").select("determinant", fn.gene_token(F.col("determinant")).alias("token")).distinct()


@q(r"""SELECT DISTINCT variant, try_cast(coalesce(nullif(regexp_extract(variant, '^[A-Z*]([0-9]+)', 1), ''), nullif(regexp_extract(variant, '([0-9]+)', 1), '')) AS INT) AS position FROM calls WHERE variant IS NOT NULL""")
def s058_residue_position(spark, sf):
    return calls(spark, sf, "variant").where("variant IS NOT NULL").select("variant", fn.residue_position(F.col("variant")).alias("position")).distinct()


@q(r"SELECT DISTINCT gene, trim(regexp_replace(gene, '[^0-9A-Za-z._-]', '_', 'g'), '_') AS name FROM calls WHERE gene IS NOT NULL")
def s059_sanitise(spark, sf):
    return calls(spark, sf, "gene").where("gene IS NOT NULL").select("gene", fn.sanitise(F.col("gene")).alias("name")).distinct()


@q("SELECT DISTINCT gene AS label FROM calls WHERE gene IS NOT NULL")
def s060_normalise_label(spark, sf):
    name = F.concat(F.lit("L2_amr__"), "gene")
    return calls(spark, sf, "gene").where("gene IS NOT NULL").select(fn.normalise_label(name).alias("label")).distinct()


@q(r"SELECT DISTINCT Assembly AS accession, regexp_extract(Assembly, '_([0-9]+)', 1)::BIGINT AS number, regexp_extract(Assembly, '\.([0-9]+)$', 1)::INT AS version FROM pilot100_manifest WHERE Assembly IS NOT NULL")
def s061_accession_key(spark, sf):
    m = table(spark, sf, "pilot100_manifest").where("Assembly IS NOT NULL").select(F.col("Assembly").alias("accession"), fn.accession_key(F.col("Assembly")).alias("k"))
    return m.select("accession", "k.number", "k.version").distinct()


@q("SELECT sample_id, CASE WHEN phenotype = 'R' THEN 1 WHEN phenotype IN ('S', 'SDD') THEN 0 END AS y FROM phenotypes")
def s062_binarise(spark, sf):
    return phenotypes(spark, sf).select("sample_id", fn.binarise(F.col("phenotype"), ["R"], ["S", "SDD"]).alias("y"))


@q("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(log2(c_acctbal), 6) END AS trait FROM customer")
def s063_log_trait(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.round(fn.log_trait(F.col("c_acctbal")), 6).alias("trait"))


@q("SELECT c_custkey, CASE WHEN c_acctbal <= 1000 THEN 'S' WHEN c_acctbal <= 5000 THEN 'I' WHEN c_acctbal IS NOT NULL THEN 'R' END AS category FROM customer")
def s064_breakpoint(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", fn.breakpoint_category(F.col("c_acctbal"), 1000, 5000).alias("category"))


_ALLELES = "SELECT p_partkey AS id, substr('ACGTAC', 1 + (p_partkey % 4)::INT, 1 + (p_size % 3)::INT) AS ref, substr('ACGTACG', 1 + (p_size % 5)::INT, 1 + (p_partkey % 3)::INT) AS alt FROM part"


def _alleles(spark, sf):
    p = table(spark, sf, "part")
    k, s = F.col("p_partkey"), F.col("p_size").cast("long")
    return p.select(k.alias("id"), F.substr(F.lit("ACGTAC"), (1 + k % 4).cast("int"), (1 + s % 3).cast("int")).alias("ref"), F.substr(F.lit("ACGTACG"), (1 + s % 5).cast("int"), (1 + k % 3).cast("int")).alias("alt"))


@q(f", v AS ({_ALLELES}) SELECT length(ref) <> 1 OR length(alt) <> 1 AS indel, count(*) AS n FROM v GROUP BY 1")
def s065_indels(spark, sf):
    return _alleles(spark, sf).groupBy(fn.is_indel(F.col("ref"), F.col("alt")).alias("indel")).agg(F.count(F.lit(1)).alias("n"))


@q(f""", v AS ({_ALLELES}) SELECT id, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNV' WHEN length(ref) = length(alt) THEN 'MNV'
 WHEN length(ref) < length(alt) AND ref[1] = alt[1] THEN 'insertion' WHEN length(ref) > length(alt) AND ref[1] = alt[1] THEN 'deletion' ELSE 'complex' END AS kind FROM v""")
def s066_variant_kind(spark, sf):
    return _alleles(spark, sf).select("id", fn.variant_kind(F.col("ref"), F.col("alt")).alias("kind"))


_CODONS = "['ATG','TGG','CAA','CGA','TAC','GAA','TAA','TAG']"


@q(f""", v AS ({_ALLELES}), c AS (SELECT *, {_CODONS}[1 + (id % 8)] AS rc, {_CODONS}[1 + ((id * 3) % 8)] AS ac FROM v)
SELECT id, CASE WHEN length(ref) = 1 AND length(alt) = 1 AND ac IN ('TAA','TAG','TGA') AND rc NOT IN ('TAA','TAG','TGA') THEN 'PREMATURE_STOP' WHEN length(ref) = length(alt) THEN 'SNV'
 WHEN abs(length(alt) - length(ref)) % 3 = 0 THEN 'INDEL' ELSE 'FRAMESHIFT' END AS class FROM c""")
def s067_variant_class(spark, sf):
    codons = F.array(*[F.lit(x) for x in ("ATG", "TGG", "CAA", "CGA", "TAC", "GAA", "TAA", "TAG")])
    v = _alleles(spark, sf).withColumn("rc", F.get(codons, (F.col("id") % 8).cast("int"))).withColumn("ac", F.get(codons, (F.col("id") * 3 % 8).cast("int")))
    return v.select("id", fn.variant_class(F.col("ref"), F.col("alt"), F.col("rc"), F.col("ac")).alias("class"))


def _sequences(spark, sf):
    """Sequences made of the letters A, C, G and T of the documents' texts."""
    d = table(spark, sf, "documents").where("text IS NOT NULL")
    return d.select("doc_id", "source", F.upper(F.regexp_replace("text", "[^acgtACGT]", "")).alias("seq")).where("seq <> ''")


_SEQS = "seqs AS (SELECT doc_id, source, upper(regexp_replace(text, '[^acgtACGT]', '', 'g')) AS seq FROM documents WHERE text IS NOT NULL AND regexp_replace(text, '[^acgtACGT]', '', 'g') <> '')"


@q(f", {_SEQS} SELECT doc_id, reverse(translate(seq, 'ACGTN', 'TGCAN')) AS rc, CASE WHEN doc_id % 2 = 0 THEN (10 - 4) // 3 + 1 ELSE (100 - 10) // 3 + 1 END::INT AS codon, substr(seq, 7, 3) AS third FROM seqs")
def s068_codons(spark, sf):
    strand = F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-")
    s = _sequences(spark, sf)
    return s.select("doc_id", fn.reverse_complement(F.col("seq")).alias("rc"), fn.codon_number(F.lit(10), F.lit(4), F.lit(100), strand).alias("codon"), fn.codon_at(F.col("seq"), F.lit(3)).alias("third"))


@q(f", v AS ({_ALLELES}) SELECT id, ref || (id + 100)::VARCHAR || alt AS variant, CASE WHEN length(ref) = length(alt) THEN 'c.' || id || ref || '>' || alt ELSE 'c.' || id || 'delins' || alt END AS effect FROM v")
def s069_effect_text(spark, sf):
    return _alleles(spark, sf).select(
        "id", F.concat("ref", (F.col("id") + 100).cast("string"), "alt").alias("variant"),
        F.when(F.length("ref") == F.length("alt"), F.format_string("c.%d%s>%s", "id", "ref", "alt")).otherwise(F.format_string("c.%ddelins%s", "id", "alt")).alias("effect"),
    )


_AA = "list_aggregate(list_transform(generate_series(1, length(seq) // 3), lambda i: substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', 1 + 16 * (instr('TCAG', substr(seq, (3 * i - 2)::BIGINT, 1)) - 1) + 4 * (instr('TCAG', substr(seq, (3 * i - 1)::BIGINT, 1)) - 1) + instr('TCAG', substr(seq, (3 * i)::BIGINT, 1)) - 1, 1)), 'string_agg', '')"


@q(f", {_SEQS} SELECT doc_id, coalesce({_AA}, '') AS protein FROM seqs")
def s070_translate(spark, sf):
    return _sequences(spark, sf).select("doc_id", fn.translate_sequence(F.col("seq")).alias("protein"))


@q("""SELECT call_id, (['UNKNOWN','DETECTED','PREDICTED','ASSOCIATED','SUPPORTED'])[1 + least(coalesce(list_position(['UNKNOWN','DETECTED','PREDICTED','ASSOCIATED','SUPPORTED'], claim_status) - 1, 0), CASE mechanism WHEN 'efflux' THEN 1 WHEN 'enzyme' THEN 2 ELSE 4 END)] AS claim FROM calls""")
def s071_clamp_claim(spark, sf):
    ceiling = F.when(F.col("mechanism") == "efflux", "DETECTED").when(F.col("mechanism") == "enzyme", "PREDICTED")
    return calls(spark, sf, "mechanism", "claim_status").select("call_id", fn.clamp_claim(F.col("claim_status"), ceiling).alias("claim"))


_FAMILIES = (("bla", "beta_lactam"), ("aac", "aminoglycoside"), ("ant", "aminoglycoside_other"), ("aac(6", "aminoglycoside_six"), ("mex", "efflux"), ("qn", "target"))


@q(""", fam(p, f) AS (VALUES ('bla','beta_lactam'),('aac','aminoglycoside'),('ant','aminoglycoside_other'),('aac(6','aminoglycoside_six'),('mex','efflux'),('qn','target')),
g AS (SELECT DISTINCT gene FROM calls WHERE gene IS NOT NULL) SELECT gene, coalesce(arg_max(f, length(p)), 'other') AS category FROM g LEFT JOIN fam ON starts_with(gene, p) GROUP BY gene""")
def s072_functional_category(spark, sf):
    from isolake.operators.features import prefix_family_features

    fam = spark.createDataFrame([(f, p) for p, f in _FAMILIES], "family string, gene_prefix string")
    genes = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL").select("gene").distinct()
    best = prefix_family_features(genes.withColumn("sample_id", F.col("gene")), fam).select(F.col("sample_id").alias("gene"), fn.feature_label(F.col("feature")).alias("category"))
    return genes.join(best, "gene", "left").select("gene", F.coalesce("category", F.lit("other")).alias("category"))


@q("""SELECT call_id, CASE WHEN starts_with(gene, 'mex') AND variant IS NOT NULL THEN 'regulator_loss' WHEN mechanism = 'enzyme' THEN 'inactivation' WHEN mechanism IS NOT NULL THEN mechanism ELSE 'unknown' END AS mechanism_class FROM calls""")
def s073_mechanism_rule(spark, sf):
    rule = F.when(F.col("gene").startswith("mex") & F.col("variant").isNotNull(), "regulator_loss").when(F.col("mechanism") == "enzyme", "inactivation").otherwise(F.coalesce("mechanism", F.lit("unknown")))
    return calls(spark, sf, "gene", "variant", "mechanism").select("call_id", rule.alias("mechanism_class"))


@q("SELECT DISTINCT determinant FROM calls WHERE determinant = 'mexG7' OR starts_with(determinant, 'mexG7~') OR determinant = 'czwB.3' OR starts_with(determinant, 'czwB.3~')")
def s074_control_match(spark, sf):
    controls = spark.createDataFrame([("mexG7",), ("czwB.3",)], "member string")
    d = calls(spark, sf, "determinant").select("determinant").distinct().withColumn("member", F.substring_index("determinant", "~", 1))
    return d.join(controls, "member", "left_semi").select("determinant")


@q(""", g AS (SELECT DISTINCT gene, variant FROM calls WHERE gene IS NOT NULL) SELECT gene, variant, CASE WHEN gene IN ('mexG7', 'czwB.3') THEN 'gene' WHEN gene || '_' || variant IN ('mexJ6_T83I', 'mexH2_del12') THEN 'composite' WHEN starts_with(gene, 'mex') THEN 'family'
 WHEN substr(gene, 1, 2) IN ('qn') THEN 'stem' END AS kind FROM g""")
def s075_known_determinant(spark, sf):
    known = spark.createDataFrame([("mexG7", "gene"), ("czwB.3", "gene"), ("mexJ6_T83I", "composite"), ("mexH2_del12", "composite"), ("mex", "family"), ("qn", "stem")], "name string, kind string")
    g = calls(spark, sf, "gene", "variant").where("gene IS NOT NULL").select("gene", "variant").distinct()
    keys = {"gene": F.col("gene"), "composite": F.concat_ws("_", "gene", F.coalesce("variant", F.lit("\u0000"))), "family": F.substring("gene", 1, 3), "stem": F.substring("gene", 1, 2)}
    for kind, key in keys.items():
        d = known.where(F.col("kind") == kind).select(F.col("name").alias(f"k_{kind}"), F.lit(kind).alias(f"found_{kind}"))
        g = g.withColumn(f"k_{kind}", key).join(d, f"k_{kind}", "left")
    return g.select("gene", "variant", F.coalesce(*[f"found_{k}" for k in keys]).alias("kind"))


@q("SELECT sample_id, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes FROM calls WHERE sample_id IS NOT NULL GROUP BY 1")
def s076_multi_value_join(spark, sf):
    return calls(spark, sf, "sample_id", "gene").where("sample_id IS NOT NULL").groupBy("sample_id").agg(fn.sorted_set(F.col("gene")).alias("genes"))


@q("SELECT call_id, concat_ws(';', 'source=' || evidence_source, CASE WHEN variant IS NOT NULL THEN 'variant=' || variant END, CASE WHEN identity_pct < 90 THEN 'low_identity' END) AS notes FROM calls")
def s077_notes(spark, sf):
    return calls(spark, sf, "variant", "evidence_source", "identity_pct").select("call_id", F.concat_ws(";", F.concat(F.lit("source="), "evidence_source"), F.concat(F.lit("variant="), "variant"), F.when(F.col("identity_pct") < 90, "low_identity")).alias("notes"))


@q(f", {_SEQS} SELECT doc_id, (SELECT max(length(r)) FROM (SELECT unnest(regexp_extract_all(seq, '(A+|C+|G+|T+)')) AS r)) AS run FROM seqs")
def s078_homopolymer(spark, sf):
    runs = F.regexp_extract_all("seq", F.lit(r"(A+|C+|G+|T+)"), 1)
    return _sequences(spark, sf).select("doc_id", F.array_max(F.transform(runs, lambda r: F.length(r))).cast("long").alias("run"))


@q("SELECT event_id, event_id % 7 + 0.0::DOUBLE AS first, value AS second, 2 AS n FROM events WHERE value IS NOT NULL")
def s079_distance_vector(spark, sf):
    packed = F.concat_ws(" ; ", (F.col("event_id") % 7).cast("string"), F.col("value").cast("string"))
    v = table(spark, sf, "events").where("value IS NOT NULL").select("event_id", fn.parse_distances(packed).alias("v"))
    return v.select("event_id", F.get("v", F.lit(0)).alias("first"), F.get("v", F.lit(1)).alias("second"), F.size("v").alias("n"))


@q("""SELECT call_id, confidence, row_number() OVER (ORDER BY confidence IS NULL, try_cast(confidence AS DOUBLE) IS NULL, try_cast(confidence AS DOUBLE), confidence, call_id) AS rn FROM calls""")
def s080_mixed_sort(spark, sf):
    return windows.numbered(calls(spark, sf, "confidence").select("call_id", "confidence"), [*fn.mixed_sort_key(F.col("confidence")), "call_id"])


# 2.4 joins


@q("""SELECT sample_id, phenotype, CASE WHEN p.sample_id IS NULL THEN 'NO_CALL' WHEN phenotype IS NULL OR phenotype IN ('ND', 'I', 'SDD') THEN 'UNUSABLE_CATEGORY' END AS excluded FROM (SELECT DISTINCT sample_id FROM samples WHERE data_class IN ('clinical', 'reference')) s LEFT JOIN phenotypes p USING (sample_id)
UNION ALL SELECT sample_id, phenotype, 'NO_ASSEMBLY' FROM phenotypes WHERE sample_id NOT IN (SELECT sample_id FROM samples WHERE data_class IN ('clinical', 'reference'))""")
def s081_directional_join(spark, sf):
    manifest = samples(spark, sf).where("data_class IN ('clinical', 'reference')").select("sample_id").distinct()
    return joins.directional_join(manifest, phenotypes(spark, sf), usable=("R", "S"), strict=False)


@q("SELECT s.sample_id, coalesce(string_agg(gene, ';' ORDER BY gene), '') AS genes FROM (SELECT DISTINCT sample_id FROM samples) s LEFT JOIN (SELECT * FROM calls WHERE gene IS NOT NULL) c USING (sample_id) GROUP BY 1")
def s082_group_to_manifest(spark, sf):
    c = calls(spark, sf, "sample_id", "gene").where("gene IS NOT NULL")
    return joins.group_to_manifest(samples(spark, sf).select("sample_id").distinct(), c, F.col("gene"), "genes").withColumn("genes", F.array_join("genes", ";"))


@q("SELECT sample_id, count(*) AS records FROM calls WHERE sample_id IS NOT NULL AND sample_id NOT IN (SELECT sample_id FROM samples) GROUP BY 1")
def s082_orphans(spark, sf):
    return joins.orphan_count(samples(spark, sf), calls(spark, sf, "sample_id"))


@q("SELECT s.sample_id, phenotype FROM (SELECT DISTINCT sample_id FROM samples) s LEFT JOIN phenotypes p USING (sample_id)")
def s083_align_to_manifest(spark, sf):
    return samples(spark, sf).select("sample_id").distinct().join(phenotypes(spark, sf).select("sample_id", "phenotype"), "sample_id", "left")


@q("SELECT sample_id, coalesce(lineage, 'unknown') AS lineage FROM (SELECT DISTINCT sample_id, lineage FROM samples)")
def s084_lineage_labels(spark, sf):
    s = samples(spark, sf)
    return joins.lineage_labels(s.select("sample_id").distinct(), s.select("sample_id", "lineage").distinct(), "lineage")


@q("""SELECT sample_id, 'left' AS side FROM (SELECT sample_id FROM samples EXCEPT SELECT sample_id FROM calls)
UNION ALL SELECT sample_id, 'right' FROM (SELECT sample_id FROM calls WHERE sample_id IS NOT NULL EXCEPT SELECT sample_id FROM samples)""")
def s085_set_equality(spark, sf):
    from isolake.operators.guards import set_difference

    return set_difference(samples(spark, sf), calls(spark, sf, "sample_id"), "sample_id")


@q("SELECT n_nationkey AS k, n_name, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def s086_two_sided_join(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"))
    return joins.strict_two_sided(n.join(c.select("k"), "k", "left_semi"), c, "k")


_DIM = (("enzyme", "acquired", "amikacin,tobramycin"), ("efflux", "chromosomal", "all"), ("porin_loss", "chromosomal", "meropenem"))


@q("SELECT call_id, mechanism, coalesce(CASE mechanism WHEN 'enzyme' THEN 'acquired' WHEN 'efflux' THEN 'chromosomal' WHEN 'porin_loss' THEN 'chromosomal' END, 'unmapped') AS origin FROM calls")
def s087_knowledge_lookup(spark, sf):
    dim = spark.createDataFrame(_DIM, "mechanism string, origin string, scope string")
    return joins.lookup(calls(spark, sf, "mechanism").select("call_id", "mechanism"), dim, "mechanism", ["origin"], "unmapped")


@q("SELECT call_id FROM calls WHERE mechanism IN ('efflux', 'enzyme') AND antibiotic = 'amikacin'")
def s088_scoped_dimension(spark, sf):
    dim = joins.scoped(spark.createDataFrame(_DIM, "mechanism string, origin string, scope string"), "scope", "amikacin")
    return calls(spark, sf, "antibiotic", "mechanism").where("antibiotic = 'amikacin'").join(dim, "mechanism", "left_semi").select("call_id")


@q("""SELECT call_id FROM calls c WHERE gene IN (SELECT gene FROM calls WHERE mechanism = 'porin_loss') AND NOT EXISTS (SELECT 1 FROM calls v WHERE v.sample_id = c.sample_id AND v.gene = c.gene AND v.variant IS NOT NULL)""")
def s089_intact_locus(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "variant", "mechanism")
    return joins.intact_locus(c, c.where("mechanism = 'porin_loss'"), c.where("variant IS NOT NULL")).select("call_id")


_BANDS = (("early", "1992-01-01", "1995-06-30"), ("middle", "1995-01-01", "1998-03-31"), ("spring", "1996-03-01", "1996-05-31"), ("late", "1998-01-01", "2002-12-31"), ("day", "1997-07-04", "1997-07-04"))


@q("""SELECT band, l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem JOIN (VALUES ('early', DATE '1992-01-01', DATE '1995-06-30'), ('middle', DATE '1995-01-01', DATE '1998-03-31'), ('spring', DATE '1996-03-01', DATE '1996-05-31'), ('late', DATE '1998-01-01', DATE '2002-12-31'), ('day', DATE '1997-07-04', DATE '1997-07-04')) b(band, lo, hi) ON l_shipdate::DATE BETWEEN lo AND hi GROUP BY ALL""")
def s090_point_in_interval(spark, sf):
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    bands = spark.createDataFrame(_BANDS, "band string, a string, b string").select("band", day(F.col("a").cast("date")).alias("lo"), day(F.col("b").cast("date")).alias("hi"))
    points = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", day(F.col("l_shipdate").cast("date")).alias("x"))
    hit = joins.point_in_interval(points, bands, [], "x", "lo", "hi", 90)
    return hit.groupBy("band", F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@q("""WITH s AS (SELECT DISTINCT l_suppkey AS g, d::INT AS d FROM (SELECT l_suppkey, unnest(generate_series(l_partkey % 1000, l_partkey % 1000 + l_quantity::INT)) AS d FROM lineitem)),
l AS (SELECT 100 AS lo, 299 AS hi, 'a' AS locus UNION ALL SELECT 500, 549, 'b' UNION ALL SELECT 290, 520, 'c')
SELECT g AS supplier, locus, round(count(*) / (hi - lo + 1), 6) AS coverage FROM s JOIN l ON d BETWEEN lo AND hi GROUP BY g, locus, lo, hi""")
def s091_interval_coverage(spark, sf):
    spans = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("supplier"), (F.col("l_partkey") % 1000).alias("s"), (F.col("l_partkey") % 1000 + F.col("l_quantity").cast("int")).alias("e"))
    loci = spark.createDataFrame([("a", 100, 299), ("b", 500, 549), ("c", 290, 520)], "locus string, lo long, hi long")
    return joins.locus_coverage(spans, loci, ["supplier"], "locus", "s", "e", "lo", "hi", 200).withColumn("coverage", F.round("coverage", 6))


@q("SELECT l.lineage, a.antibiotic, n FROM (SELECT DISTINCT lineage FROM samples WHERE lineage IS NOT NULL) l, (SELECT DISTINCT antibiotic FROM calls WHERE antibiotic IS NOT NULL) a LEFT JOIN (SELECT lineage, antibiotic, count(*) AS n FROM calls JOIN samples USING (sample_id) GROUP BY ALL) c ON c.lineage = l.lineage AND c.antibiotic = a.antibiotic")
def s092_grid(spark, sf):
    c, s = calls(spark, sf, "sample_id", "antibiotic"), samples(spark, sf)
    values = c.join(s.select("sample_id", "lineage"), "sample_id").groupBy("lineage", "antibiotic").agg(F.count(F.lit(1)).alias("n"))
    return joins.grid(s.select("lineage").where("lineage IS NOT NULL").distinct(), c.select("antibiotic").where("antibiotic IS NOT NULL").distinct(), values, ["lineage", "antibiotic"])


@q("""SELECT s.sample_id, s.lineage, p.phenotype, c.genes, c.variants, g.n_genes, coalesce(c.best, 'UNKNOWN') AS claim FROM (SELECT DISTINCT sample_id, lineage FROM samples) s LEFT JOIN phenotypes p USING (sample_id)
LEFT JOIN (SELECT sample_id, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes, string_agg(DISTINCT variant, ',' ORDER BY variant) AS variants, CASE max(coalesce(list_position(['UNKNOWN','DETECTED','PREDICTED','ASSOCIATED','SUPPORTED'], claim_status), 1)) WHEN 3 THEN 'PREDICTED' WHEN 2 THEN 'DETECTED' ELSE 'UNKNOWN' END AS best FROM calls GROUP BY 1) c USING (sample_id)
LEFT JOIN (SELECT sample_id, count(*) AS n_genes FROM presence GROUP BY 1) g USING (sample_id)""")
def s093_master_table(spark, sf):
    s = samples(spark, sf).select("sample_id", "lineage").distinct()
    c = calls(spark, sf, "sample_id", "gene", "variant", "claim_status").groupBy("sample_id").agg(fn.sorted_set(F.col("gene")).alias("genes"), fn.sorted_set(F.col("variant")).alias("variants"), fn.claim_of(F.max(fn.claim_rank(F.col("claim_status")))).alias("best"))
    g = presence(spark, sf).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_genes"))
    out = s.join(phenotypes(spark, sf).select("sample_id", "phenotype"), "sample_id", "left").join(c, "sample_id", "left").join(g, "sample_id", "left")
    return out.select("sample_id", "lineage", "phenotype", "genes", "variants", "n_genes", F.coalesce("best", F.lit("UNKNOWN")).alias("claim"))


@q("SELECT c.sample_id, min(c.gene) AS feature FROM calls c WHERE gene IN (SELECT gene FROM calls GROUP BY gene HAVING count(DISTINCT sample_id) >= 20) AND sample_id IS NOT NULL GROUP BY 1")
def s094_association_annotation(spark, sf):
    c = calls(spark, sf, "sample_id", "gene")
    wide = c.groupBy("gene").agg(F.countDistinct("sample_id").alias("n")).where("n >= 20 AND gene IS NOT NULL")
    return c.where("sample_id IS NOT NULL").join(wide.select("gene"), "gene", "left_semi").groupBy("sample_id").agg(F.min("gene").alias("feature"))


@q("""SELECT sample_id, CASE count(DISTINCT mechanism) WHEN 0 THEN 'not_assessed' WHEN 1 THEN min(mechanism) ELSE 'mixed:' || string_agg(DISTINCT mechanism, ',' ORDER BY mechanism) END AS mechanism FROM calls WHERE sample_id IS NOT NULL GROUP BY 1""")
def s095_mixed_annotation(spark, sf):
    return joins.mixed_annotation(calls(spark, sf, "sample_id", "mechanism").where("sample_id IS NOT NULL"), ["sample_id"], "mechanism", "mechanism")


@q("""SELECT s.sample_id, coalesce(p.phenotype, 'not_assessed') AS phenotype, coalesce(c.n, 0) AS calls, coalesce(g.n, 0) AS genes, coalesce(e.n, 0) AS executions FROM (SELECT DISTINCT sample_id FROM samples) s LEFT JOIN phenotypes p USING (sample_id) LEFT JOIN (SELECT sample_id, count(*) AS n FROM calls GROUP BY 1) c USING (sample_id)
LEFT JOIN (SELECT sample_id, count(*) AS n FROM presence GROUP BY 1) g USING (sample_id) LEFT JOIN (SELECT subject AS sample_id, count(DISTINCT id) AS n FROM execution GROUP BY 1) e USING (sample_id)""")
def s096_isolate_view(spark, sf):
    out = samples(spark, sf).select("sample_id").distinct().join(phenotypes(spark, sf).select("sample_id", "phenotype"), "sample_id", "left")
    sides = {"calls": calls(spark, sf, "sample_id"), "genes": presence(spark, sf), "executions": table(spark, sf, "execution").select(F.col("subject").alias("sample_id"), "id").distinct()}
    for name, df in sides.items():
        out = out.join(df.groupBy("sample_id").agg(F.count(F.lit(1)).alias(name)), "sample_id", "left")
    return out.select("sample_id", F.coalesce("phenotype", F.lit("not_assessed")).alias("phenotype"), *[F.coalesce(n, F.lit(0)).alias(n) for n in sides])


@q("SELECT count(*) FILTER (p.sample_id IS NOT NULL) AS matched, count(*) FILTER (p.sample_id IS NULL) AS missing FROM (SELECT DISTINCT sample_id FROM calls WHERE sample_id IS NOT NULL) c LEFT JOIN phenotypes p USING (sample_id)")
def s097_match_counts(spark, sf):
    c = calls(spark, sf, "sample_id").where("sample_id IS NOT NULL").select("sample_id").distinct()
    j = c.join(phenotypes(spark, sf).select("sample_id", F.lit(1).alias("m")), "sample_id", "left")
    return j.agg(F.count("m").alias("matched"), F.count_if(F.col("m").isNull()).alias("missing"))


@q("SELECT s.sample_id, coalesce(phenotype, '.') AS phenotype, coalesce(lineage, '.') AS lineage, coalesce(data_class, '.') AS data_class FROM (SELECT DISTINCT sample_id, lineage, data_class FROM samples) s LEFT JOIN phenotypes USING (sample_id)")
def s098_consolidation(spark, sf):
    j = samples(spark, sf).select("sample_id", "lineage", "data_class").distinct().join(phenotypes(spark, sf).select("sample_id", "phenotype"), "sample_id", "left")
    return j.select("sample_id", *[fn.format_cell(F.col(c), "string").alias(c) for c in ("phenotype", "lineage", "data_class")])


@q("SELECT x.gene AS feature_a, y.gene AS feature_b, count(*) AS n_both FROM (SELECT DISTINCT sample_id, gene FROM calls WHERE sample_id IS NOT NULL) x JOIN (SELECT DISTINCT sample_id, gene FROM calls WHERE sample_id IS NOT NULL) y ON x.sample_id = y.sample_id AND x.gene < y.gene GROUP BY ALL")
def s099_pair_self_join(spark, sf):
    from isolake.operators.stats import pair_counts

    c = calls(spark, sf, "sample_id", "gene").where("sample_id IS NOT NULL AND gene IS NOT NULL").select("sample_id", F.col("gene").alias("name"))
    return pair_counts(c).select("feature_a", "feature_b", "n_both")


@q("""SELECT coalesce(a.gene, b.gene) AS gene, a.gene IS NOT NULL AS in_baseline, b.gene IS NOT NULL AS in_more, CASE WHEN a.gene IS NULL THEN 1 ELSE 0 END AS ord FROM (SELECT DISTINCT gene FROM calls WHERE mechanism = 'enzyme' AND gene IS NOT NULL) a FULL JOIN (SELECT DISTINCT gene FROM calls WHERE antibiotic = 'colistin' AND gene IS NOT NULL) b ON a.gene = b.gene""")
def s100_evidence_union(spark, sf):
    c = calls(spark, sf, "antibiotic", "gene", "mechanism").where("gene IS NOT NULL")
    return joins.evidence_union(c.where("mechanism = 'enzyme'"), c.where("antibiotic = 'colistin'"), "gene")


@q("SELECT DISTINCT gene FROM calls WHERE gene IN (SELECT gene FROM calls JOIN samples USING (sample_id) WHERE lineage IS NOT NULL GROUP BY gene HAVING count(DISTINCT lineage) >= 5) AND gene IN (SELECT gene FROM calls WHERE claim_status = 'PREDICTED')")
def s101_supported(spark, sf):
    c = calls(spark, sf, "sample_id", "gene", "claim_status").where("gene IS NOT NULL")
    wide = c.join(samples(spark, sf).where("lineage IS NOT NULL"), "sample_id").groupBy("gene").agg(F.countDistinct("lineage").alias("n")).where("n >= 5")
    return wide.select("gene").join(c.where("claim_status = 'PREDICTED'").select("gene").distinct(), "gene", "left_semi")


# 2.5 set operations, sampling, partitioning


@q("SELECT sample_id, gene AS name FROM presence UNION SELECT sample_id, gene FROM calls WHERE sample_id IS NOT NULL AND gene IS NOT NULL")
def s102_union_namespaces(spark, sf):
    return sets.union_namespaces(presence(spark, sf).withColumnRenamed("gene", "name"), calls(spark, sf, "sample_id", "gene").select("sample_id", F.col("gene").alias("name")))


@q("""SELECT count(a.s) AS selected, count(b.s) AS reference, count(*) FILTER (a.s IS NOT NULL AND b.s IS NOT NULL) AS both, count(*) FILTER (b.s IS NULL) AS only_selected, count(*) FILTER (a.s IS NULL) AS only_reference FROM (SELECT DISTINCT sample_id AS s FROM calls WHERE sample_id IS NOT NULL) a FULL JOIN (SELECT DISTINCT sample_id AS s FROM samples) b ON a.s = b.s""")
def s103_overlap_report(spark, sf):
    return sets.overlap_report(calls(spark, sf, "sample_id").where("sample_id IS NOT NULL"), samples(spark, sf), "sample_id")


@q("SELECT * FROM (SELECT call_id, sample_id, antibiotic, gene FROM calls QUALIFY row_number() OVER (PARTITION BY sample_id, antibiotic, gene ORDER BY call_id) = 1)")
def s104_first_per_key(spark, sf):
    return sets.first_per_key(calls(spark, sf, "sample_id", "antibiotic", "gene").select("call_id", "sample_id", "antibiotic", "gene"), ["sample_id", "antibiotic", "gene"], ["call_id"])


@q("SELECT gene, gene IN (SELECT gene FROM calls WHERE gene IS NOT NULL) AS known FROM (SELECT DISTINCT gene FROM presence)")
def s105_known_novel(spark, sf):
    g = presence(spark, sf).select("gene").distinct()
    return g.join(calls(spark, sf, "gene").select("gene").where("gene IS NOT NULL").distinct().withColumn("k", F.lit(True)), "gene", "left").select("gene", F.coalesce("k", F.lit(False)).alias("known"))


@q("SELECT gene, count(*) AS n_samples, CASE WHEN count(*) >= 0.95 * (SELECT count(DISTINCT sample_id) FROM presence) THEN 'core' ELSE 'accessory' END AS compartment FROM presence GROUP BY gene")
def s106_core_accessory(spark, sf):
    p = presence(spark, sf)
    return sets.core_partition(p, p.select("sample_id").distinct().count(), 0.95)


@q("""SELECT sample_id, lineage FROM (SELECT sample_id, lineage, row_number() OVER (PARTITION BY lineage ORDER BY sample_id) AS turn, count(*) OVER (PARTITION BY lineage) AS size FROM (SELECT DISTINCT sample_id, lineage FROM samples)) ORDER BY turn, size DESC, lineage NULLS LAST, sample_id LIMIT 40""")
def s107_round_robin(spark, sf):
    return sets.round_robin(samples(spark, sf).select("sample_id", "lineage").distinct(), "lineage", "sample_id", 40)


@q(r"SELECT DISTINCT Assembly FROM pilot100_manifest WHERE Assembly IS NOT NULL ORDER BY regexp_extract(Assembly, '_([0-9]+)', 1)::BIGINT LIMIT 15")
def s108_head_natural(spark, sf):
    m = table(spark, sf, "pilot100_manifest").where("Assembly IS NOT NULL").select("Assembly").distinct()
    return sets.head_natural(m, [fn.accession_key(F.col("Assembly"))], 15)


@q("SELECT position, sample_id, lineage FROM (SELECT row_number() OVER (ORDER BY sample_id DESC) AS position, sample_id FROM (SELECT DISTINCT sample_id FROM calls WHERE sample_id IS NOT NULL)) JOIN (SELECT DISTINCT sample_id, lineage FROM samples) USING (sample_id)")
def s108_listed(spark, sf):
    from pyspark.sql import Window

    ids = calls(spark, sf, "sample_id").where("sample_id IS NOT NULL").select("sample_id").distinct().withColumn("position", F.row_number().over(Window.orderBy(F.desc("sample_id"))).cast("long"))
    return sets.listed(samples(spark, sf).select("sample_id", "lineage").distinct(), "sample_id", ids)[0].select("position", "sample_id", "lineage")


@q("SELECT DISTINCT sample_id, lineage FROM samples WHERE sample_id IN (SELECT sample_id FROM phenotypes WHERE phenotype = 'R')")
def s109_subset(spark, sf):
    return sets.subset(samples(spark, sf).select("sample_id", "lineage").distinct(), "sample_id", phenotypes(spark, sf).where("phenotype = 'R'"))


@q("SELECT DISTINCT sample_id FROM samples WHERE sample_id NOT IN (SELECT sample_id FROM calls WHERE sample_id IS NOT NULL AND mechanism = 'enzyme')")
def s110_stratum_restriction(spark, sf):
    c = calls(spark, sf, "sample_id", "mechanism").where("sample_id IS NOT NULL")
    values = c.select("sample_id", F.coalesce("mechanism", F.lit("none")).alias("feature")).distinct().withColumn("value", F.lit(1))
    return sets.without_features(values, samples(spark, sf).select("sample_id").distinct(), spark.createDataFrame([("enzyme",)], "feature string"))


def _farthest_sql(k: int) -> str:
    """The greedy choice written out step by step; the medoid is the point of least summed squared distance to all."""
    d = lambda a, b: f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) ** 2))"
    out = f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL), x AS (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
m AS (SELECT list(a ORDER BY i) AS m FROM (SELECT i, avg(x) AS a FROM x GROUP BY i)), c1 AS MATERIALIZED (SELECT vec_id, v, 0 AS ord FROM e, m ORDER BY round({d('v', 'm')}, 9), vec_id LIMIT 1)"""
    for n in range(2, k + 1):
        before = " UNION ALL ".join(f"SELECT * FROM c{x}" for x in range(1, n))
        out += f""", c{n} AS MATERIALIZED (SELECT e.vec_id, any_value(e.v) AS v, {n - 1} AS ord FROM e, ({before}) c WHERE e.vec_id NOT IN (SELECT vec_id FROM ({before})) GROUP BY 1 ORDER BY round(min({d('e.v', 'c.v')}), 9) DESC, e.vec_id LIMIT 1)"""
    return out + " " + " UNION ALL ".join(f"SELECT ord, vec_id FROM c{x}" for x in range(1, k + 1))


@q(_farthest_sql(12))
def s111_farthest_points(spark, sf):
    return sets.farthest_points(table(spark, sf, "embeddings"), "vec_id", "embedding", 12)


@q("SELECT sample_id, antibiotic, call_id, identity_pct FROM calls WHERE sample_id IS NOT NULL AND identity_pct >= 90 QUALIFY row_number() OVER (PARTITION BY sample_id, antibiotic ORDER BY identity_pct DESC, coverage_pct DESC NULLS LAST, call_id) = 1")
def s143_best_hit(spark, sf):
    c = calls(spark, sf, "sample_id", "antibiotic", "identity_pct", "coverage_pct").where("sample_id IS NOT NULL")
    return windows.best_hit(c, ["sample_id", "antibiotic"], ["identity_pct", "coverage_pct"], ["call_id"], {"identity_pct": 90}).select("sample_id", "antibiotic", "call_id", "identity_pct")


QUERIES, ORACLE = q.queries, q.oracle
