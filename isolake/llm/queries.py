"""Queries of the training-data problems 1, 5, 7, 8 and 9 with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.llm import leakage, mixing, pairs, reading, terms
from isolake.session import materialise


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables' pairs: two collections of one pair table, loaded in two changes of half the baskets each.

    One table for both keeps the number of plans, and with it the driver's memory, down."""
    space = lambda df, name: df.withColumn("space", F.lit(name))
    presence = space(pairs.presence_baskets(table(spark, sf, "gene_presence_absence")), "gene_presence_absence")
    calls = space(pairs.determinant_baskets(table(spark, sf, "amr_determinants")), "amr_determinants")
    t = pairs.pair_table(spark, *pairs.in_changes(presence.unionByName(calls), 2))
    return pairs.associated(t).select(F.col("space").alias("table_name"), F.col("a").alias("gene_a"), F.col("b").alias("gene_b"))


def p1_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of amr_determinants after loading it in three steps: what was loaded by April, by June, and all.

    Each later step brings the whole contents of the samples it touches.
    """
    calls = table(spark, sf, "amr_determinants")
    steps = [F.col("loaded_at") < "2026-04-01", F.col("loaded_at") < "2026-06-01", F.lit(True)]
    changes, before = [], None
    for until in steps:
        now = calls.where(F.coalesce(until, F.lit(False)))
        if before is not None:
            fresh = now.exceptAll(before).select(pairs._trim("sample_id").alias("basket")).distinct()
            changes.append(pairs.determinant_baskets(now).join(fresh, "basket", "left_semi"))
        else:
            changes.append(pairs.determinant_baskets(now))
        before = now
    t = pairs.pair_table(spark, *changes)
    return pairs.associated(t).select(F.col("a").alias("gene_a"), F.col("b").alias("gene_b"), "n_both", "n_a", "n_b", "n", F.round("lift", 6).alias("lift"), F.round("g2", 4).alias("g2"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return terms.gene_marks(table(spark, sf, "gene_presence_absence")).where("mark IS NOT NULL").select("gene", "mark")


def p5_genes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and samples of every gene, with the mark."""
    return terms.gene_marks(table(spark, sf, "gene_presence_absence"))


def p5_text_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Word n-grams of up to three words in the documents' texts."""
    return terms.text_terms(table(spark, sf, "documents"), 3)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_passages(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.find_passages(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_leaked_items(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The shares reached, by source."""
    documents, targets = table(spark, sf, "documents"), table(spark, sf, "mix_targets")
    return mixing.report(materialise(mixing.mix(documents, targets), "mixing"), targets)


def p8_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """How often the mix holds each document."""
    return mixing.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets")).select("doc_id", "source", "tokens", F.round("rate", 6).alias("rate"), "repeats")


def p8_heldout(spark: SparkSession, sf: str) -> DataFrame:
    """Expected against true shares of sources, on labelled documents kept from the classifier."""
    return mixing.held_out_shares(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p8_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the mix whatever is chosen: one row a document, no repeat above what its source allows, no use of other sources."""
    documents, targets = table(spark, sf, "documents"), table(spark, sf, "mix_targets")
    m = mixing.mix(documents, targets).select("doc_id", "source", "repeats")
    allowed = targets.select(mixing.source_key(F.col("source")).alias("source"), "max_repeats")
    over = m.join(allowed, "source", "left").where("repeats < 0 OR (source IS NOT NULL AND repeats > coalesce(max_repeats, 0)) OR (source IS NULL AND repeats > 1)")
    return m.agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("doc_id").alias("distinct_documents"), (F.sum("repeats") > 0).alias("used")).withColumn("over_cap", F.lit(over.count()))


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    return reading.levels(table(spark, sf, "documents"), table(spark, sf, "reading_anchors"), table(spark, sf, "eval_items"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).where("level >= 4").select("doc_id")


def p9_levels(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).select("doc_id", "level", F.round("posterior", 6).alias("posterior"))


def p9_profile(spark: SparkSession, sf: str) -> DataFrame:
    return reading.profile(table(spark, sf, "documents"), _levels(spark, sf))


QUERIES = {f.__name__: f for f in (p1_found, p1_incremental, p5_found, p5_genes, p5_text_terms, p7_found, p7_passages, p7_leaked_items, p8_mix, p8_repeats, p8_heldout, p8_invariants, p9_found, p9_levels, p9_profile)}

_B = r"e' \t\r\n'"
_PAIRS = """
, t AS (SELECT table_name, count(DISTINCT s) AS n FROM b GROUP BY table_name),
m AS (SELECT table_name, g, count(*) AS n FROM b GROUP BY table_name, g),
c AS (SELECT x.table_name, x.g AS gene_a, y.g AS gene_b, count(*) AS n_both FROM b x JOIN b y ON x.table_name = y.table_name AND x.s = y.s AND x.g < y.g GROUP BY ALL),
f AS (SELECT c.*, t.n, ma.n AS n_a, mb.n AS n_b FROM c JOIN t USING (table_name) JOIN m ma ON ma.table_name = c.table_name AND ma.g = gene_a
    JOIN m mb ON mb.table_name = c.table_name AND mb.g = gene_b WHERE n_both >= 6 AND n_both * t.n >= 3 * ma.n * mb.n)
"""
_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')"
_GENES = f"""
WITH g AS (SELECT trim(gene, {_B}) AS gene, count(*) AS occurrences, count(DISTINCT sample_id) FILTER (present = 1) AS records
    FROM gene_presence_absence WHERE gene IS NOT NULL GROUP BY 1),
m AS (SELECT *, CASE WHEN records < 4 THEN 'rare' WHEN records * 100 >= 95 * (SELECT count(DISTINCT sample_id) FROM gene_presence_absence) THEN 'common' END AS mark FROM g)
"""
ORACLE = {
    "p1_found": f"""
WITH b AS (SELECT DISTINCT 'gene_presence_absence' AS table_name, trim(sample_id, {_B}) AS s, trim(gene, {_B}) AS g FROM gene_presence_absence
        WHERE present = 1 AND gene IS NOT NULL AND sample_id IS NOT NULL
    UNION SELECT 'amr_determinants', trim(sample_id, {_B}), trim(gene, {_B}) FROM amr_determinants WHERE gene IS NOT NULL AND sample_id IS NOT NULL)
{_PAIRS} SELECT table_name, gene_a, gene_b FROM f""",
    "p1_incremental": f"""
WITH b AS (SELECT DISTINCT 'a' AS table_name, trim(sample_id, {_B}) AS s, trim(gene, {_B}) AS g FROM amr_determinants WHERE gene IS NOT NULL AND sample_id IS NOT NULL)
{_PAIRS} SELECT gene_a, gene_b, n_both, n_a, n_b, n, round(n_both::DOUBLE * n / (n_a::DOUBLE * n_b), 6) AS lift,
round(2 * (n_both * ln(n_both::DOUBLE * n / (n_a::DOUBLE * n_b))
  + CASE WHEN n_a > n_both THEN (n_a - n_both) * ln((n_a - n_both)::DOUBLE * n / (n_a::DOUBLE * (n - n_b))) ELSE 0 END
  + CASE WHEN n_b > n_both THEN (n_b - n_both) * ln((n_b - n_both)::DOUBLE * n / ((n - n_a)::DOUBLE * n_b)) ELSE 0 END
  + CASE WHEN n - n_a - n_b + n_both > 0 THEN (n - n_a - n_b + n_both) * ln((n - n_a - n_b + n_both)::DOUBLE * n / ((n - n_a)::DOUBLE * (n - n_b))) ELSE 0 END), 4) AS g2 FROM f""",
    "p5_found": _GENES + "SELECT gene, mark FROM m WHERE mark IS NOT NULL",
    "p5_genes": _GENES + "SELECT gene, occurrences, records, mark FROM m",
    "p5_text_terms": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+(?:[''’-][\p{L}\p{N}]+)*') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(w)), lambda i: w[i:i + 2])) AS s FROM w),
g AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(s)), lambda k: s[1:k])) AS g FROM s)
SELECT array_to_string(g, ' ') AS ngram, len(g)::INT AS terms, count(*) AS occurrences, count(DISTINCT doc_id) AS records,
    CASE WHEN count(DISTINCT doc_id) < 4 THEN 'rare' WHEN count(DISTINCT doc_id) * 100 >= 95 * (SELECT count(DISTINCT doc_id) FROM documents) THEN 'common' END AS mark
FROM g GROUP BY g""",
    "p7_found": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {_WORDS} AS w FROM eval_items WHERE text IS NOT NULL),
ir AS (SELECT item_id, array_to_string(w, ' ') AS r FROM i WHERE len(w) BETWEEN 1 AND 11
    UNION SELECT item_id, unnest(list_transform(generate_series(1, len(w) - 11), lambda k: array_to_string(w[k:k + 11], ' '))) FROM i WHERE len(w) >= 12),
lengths AS (SELECT DISTINCT least(len(w), 12) AS n FROM i WHERE len(w) > 0),
dr AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, len(w) - n + 1), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS r
    FROM d JOIN lengths ON len(w) >= n)
SELECT DISTINCT doc_id, item_id FROM dr JOIN ir USING (r)""",
}
ORACLE["p8_invariants"] = "SELECT count(*) AS documents, count(DISTINCT doc_id) AS distinct_documents, true AS used, 0 AS over_cap FROM (SELECT DISTINCT doc_id FROM documents)"
ORACLE["p7_passages"] = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, regexp_extract_all(lower(text), '[^a-z0-9]*[a-z0-9]+') AS k FROM d),
w AS (SELECT doc_id, list_transform(k, lambda x: len(x)) AS sizes, list_transform(k, lambda x: regexp_replace(x, '^[^a-z0-9]+', '')) AS w FROM k),
i AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM eval_items WHERE text IS NOT NULL),
ir AS (SELECT DISTINCT item_id, least(len(w), 12) AS n, unnest(list_transform(generate_series(1, greatest(1, len(w) - 11)), lambda k: array_to_string(w[k:k + least(len(w), 12) - 1], ' '))) AS r FROM i WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM ir),
pos AS (SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM w JOIN lengths ON len(w) >= n),
dr AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS r FROM pos JOIN w USING (doc_id)),
h AS (SELECT DISTINCT doc_id, item_id, i, i + n - 1 AS j FROM dr JOIN ir USING (n, r)),
m AS (SELECT *, max(j) OVER (PARTITION BY doc_id, item_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM h),
g AS (SELECT *, sum((reach IS NULL OR i > reach)::INT) OVER (PARTITION BY doc_id, item_id ORDER BY i) AS island FROM m),
p AS (SELECT doc_id, item_id, min(i) AS a, max(j) AS b FROM g GROUP BY doc_id, item_id, island)
SELECT doc_id, item_id, (list_sum(sizes[1:a]) - len(w[a]))::INT AS start_at, list_sum(sizes[1:b])::INT AS end_at FROM p JOIN w USING (doc_id)"""
ORACLE["p7_leaked_items"] = f"SELECT item_id, suite, count(doc_id) AS documents FROM (SELECT DISTINCT item_id, suite FROM eval_items) LEFT JOIN ({ORACLE['p7_found']}) USING (item_id) GROUP BY ALL"
