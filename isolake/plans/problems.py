"""Queries of the general training-data problems (2, 3, 4 and 6) with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isolake.operators import orphans, packed, rejects
from isolake.streaming import changefeed


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return rejects.failed_rows(rejects.read_records(table(spark, sf, "amr_raw")))


def p2_typed(spark: SparkSession, sf: str) -> DataFrame:
    return rejects.valid_rows(rejects.read_records(table(spark, sf, "amr_raw"))).drop("file_name", "line_no")


def p2_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Failed records by reason and by what decided it: the reader's values, its reject table, or the raw text."""
    bad = rejects.read_records(table(spark, sf, "amr_raw")).where("reason IS NOT NULL")
    return bad.groupBy("reason", "decided_by").agg(F.countDistinct("line_id").alias("records"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return changefeed.status_table(spark, f"{sf}/status_feed.parquet")


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    return packed.parsed(
        [
            ("pilot100_manifest", table(spark, sf, "pilot100_manifest"), "Pilot_ID", ["AMR_genotypes"]),
            ("execution", table(spark, sf, "execution"), "id", ["input_ids", "output_paths"]),
        ]
    )


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return packed.exploded(_packed(spark, sf))


def p4_dialects(spark: SparkSession, sf: str) -> DataFrame:
    """How many fields each kind of dialect won, and how many of its parses the field rule would not give."""
    kinds = F.array(*[F.lit(kind) for _, kind, _, _ in packed.dialects()])
    p = _packed(spark, sf)
    kind = F.when(F.col("dialect").isNull(), "single value").otherwise(F.element_at(kinds, F.col("dialect") + 1))
    return p.groupBy("field", kind.alias("kind")).agg(F.count(F.lit(1)).alias("fields"), F.count_if(~F.col("agrees")).alias("disagree"))


def reference_graph(spark: SparkSession, sf: str) -> tuple[dict[str, orphans.Node], list[orphans.Edge]]:
    execution = table(spark, sf, "execution").withColumn("sample", F.when(F.col("subject") != "all", F.col("subject")))
    nodes = {
        "attempt_log": orphans.Node(table(spark, sf, "attempt_log"), "id", "recorded_at"),
        "execution": orphans.Node(execution, "id", "created_at", "created_at", "deleted_at"),
        "amr_determinants": orphans.Node(table(spark, sf, "amr_determinants"), "call_id", "loaded_at"),
        "sample_metadata": orphans.Node(table(spark, sf, "sample_metadata"), "sample_id", None, "registered_at", "withdrawn_at"),
    }
    edges = [
        orphans.Edge("attempt_log", "execution_id", "execution"),
        orphans.Edge("amr_determinants", "sample_id", "sample_metadata"),
        orphans.Edge("execution", "sample", "sample_metadata"),
    ]
    return nodes, edges


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """What the cascade finds to be direct orphans, in the two reporting tables; inherited ones are in `p6_cascade`."""
    found = orphans.cascade(*reference_graph(spark, sf)).where("kind = 'direct' AND table_name <> 'execution'")
    return found.select("table_name", "period", F.col("row_id").cast("long").alias("row_id"), "reason")


def p6_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.cascade(*reference_graph(spark, sf))


QUERIES = {f.__name__: f for f in (p2_found, p2_typed, p2_reasons, p3_found, p4_found, p4_dialects, p6_found, p6_cascade)}

_VALUE = r'"(?:[^"]|"")*"|[^"\t][^\t]*|'
_B = r"e' \t\r\n'"
_P2 = rf"""
WITH r AS (SELECT DISTINCT line_id, file_name, line_no, raw FROM amr_raw
    WHERE raw IS NOT NULL AND NOT starts_with(raw, '#') AND trim(raw, {_B}) <> ''
    AND NOT regexp_matches(raw, '^([ \r\n]*sample_id[ \r\n]*|"[ \t\r\n]*sample_id[ \t\r\n]*")(\t|$)')),
q AS (SELECT line_id, regexp_full_match(raw, '({_VALUE})(\t({_VALUE}))*', 's') AS quoted,
    regexp_extract_all(e'\t' || raw, '\t({_VALUE})', 1) AS v0 FROM r),
c AS (SELECT line_id, quoted, list_transform(v0, lambda x:
    trim(CASE WHEN starts_with(x, '"') THEN replace(x[2:-2], '""', '"') ELSE x END, {_B})) AS v1 FROM q),
v AS (SELECT line_id, quoted, list_transform(v1, lambda x: CASE WHEN x IN ('', '.') THEN NULL ELSE x END) AS v FROM c),
j AS (SELECT line_id, v, CASE WHEN NOT quoted THEN 'quoting' WHEN len(v) <> 14 THEN 'column_count' WHEN v[3] IS NULL THEN 'determinant'
    WHEN NOT regexp_full_match(coalesce(v[13], '0'), '0*(100(\.0+)?|[0-9]{{1,2}}(\.[0-9]+)?)') THEN 'identity_pct'
    WHEN NOT regexp_full_match(coalesce(v[14], '0'), '0*(100(\.0+)?|[0-9]{{1,2}}(\.[0-9]+)?)') THEN 'coverage_pct' END AS reason FROM v)
"""
_P4 = f"""
WITH f AS (
    SELECT DISTINCT 'pilot100_manifest' AS table_name, Pilot_ID AS row_key, 'AMR_genotypes' AS field, AMR_genotypes AS t FROM pilot100_manifest
    UNION SELECT 'execution', id::VARCHAR, 'input_ids', input_ids FROM execution
    UNION SELECT 'execution', id::VARCHAR, 'output_paths', output_paths FROM execution),
g AS (SELECT * FROM f WHERE t IS NOT NULL AND trim(t, {_B}) NOT IN ('', '.', 'NA', 'MISSING')),
p AS (SELECT table_name, row_key, field, CASE WHEN starts_with(trim(t, {_B}), '[') THEN from_json(trim(t, {_B}), '["VARCHAR"]')
    ELSE list_transform(list_filter(list_transform(string_split(array_to_string(list_transform(string_split(t, '"'),
        lambda s, i: CASE WHEN i % 2 = 1 THEN translate(s, e',;|\\r\\n', repeat(chr(1), 5)) ELSE s END), '"'), chr(1)),
        lambda x: trim(x, {_B})), lambda x: x <> ''),
        lambda x: CASE WHEN regexp_full_match(x, '"(?:[^"]|"")*"', 's') THEN replace(x[2:-2], '""', '"') ELSE x END) END AS v FROM g)
SELECT table_name, row_key, field, unnest(generate_series(1, len(v)))::INT AS pos, unnest(v) AS value FROM p
"""
_P6 = f"""
WITH refs AS (
    SELECT DISTINCT 'attempt_log' AS table_name, 'execution' AS parent, id AS row_id, trim(execution_id::VARCHAR, {_B}) AS ref, recorded_at AS made FROM attempt_log
    UNION SELECT 'amr_determinants', 'sample_metadata', call_id, trim(sample_id, {_B}), loaded_at FROM amr_determinants
    UNION SELECT 'execution', 'sample_metadata', id, trim(nullif(subject, 'all'), {_B}), created_at FROM execution),
keys AS (
    SELECT DISTINCT 'execution' AS parent, id::VARCHAR AS key, created_at AS b, deleted_at AS e FROM execution
    UNION SELECT 'sample_metadata', trim(sample_id, {_B}), registered_at, withdrawn_at FROM sample_metadata),
direct AS (
    SELECT DISTINCT table_name, strftime(made AT TIME ZONE 'UTC', '%Y-%m') AS period, row_id,
        CASE WHEN key IS NULL THEN 'missing' WHEN b > made THEN 'late' WHEN e <= made THEN 'deleted' END AS reason
    FROM refs LEFT JOIN keys ON keys.parent = refs.parent AND key = ref WHERE ref IS NOT NULL)
"""
ORACLE = {
    "p2_found": _P2 + "SELECT DISTINCT line_id, reason FROM j WHERE reason IS NOT NULL",
    "p2_typed": _P2
    + "SELECT line_id, "
    + ", ".join(f"v[{i}]{'::DOUBLE' if c.endswith('_pct') else ''} AS {c}" for i, c in enumerate(rejects.AMR_COLUMNS, 1))
    + " FROM j WHERE reason IS NULL",
    "p2_reasons": _P2 + "SELECT reason, CASE WHEN reason IN ('quoting', 'column_count') THEN 'reject_errors' ELSE 'reader' END AS decided_by, count(DISTINCT line_id) AS records FROM j WHERE reason IS NOT NULL GROUP BY ALL",
    "p3_found": r"""
WITH c AS (SELECT stage, sample, op, event, change_id, seq,
        try_cast(regexp_replace(t, '^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})', '\1-\2-\3T\4:\5:\6') AS TIMESTAMPTZ) AS made_at
    FROM status_feed WHERE stage IS NOT NULL AND sample IS NOT NULL AND t IS NOT NULL),
o AS (SELECT DISTINCT stage, sample, op, event, change_id, row(made_at, seq, change_id) AS v FROM c WHERE made_at IS NOT NULL),
w AS (SELECT *, max(v) FILTER (op = 'delete') OVER (PARTITION BY stage, sample) AS gone FROM o),
n AS (SELECT *, min(v) FILTER (op = 'insert') OVER (PARTITION BY stage, sample) AS made FROM w WHERE gone IS NULL OR v > gone)
SELECT stage, sample, event, change_id FROM n WHERE op IN ('insert', 'update') AND v >= made
QUALIFY row_number() OVER (PARTITION BY stage, sample ORDER BY v DESC) = 1""",
    "p4_found": _P4,
    "p4_dialects": f"""SELECT field, CASE WHEN NOT regexp_matches(t, '[,;|\\r\\n"\\[]') THEN 'single value' WHEN starts_with(trim(t, {_B}), '[') THEN 'json' ELSE 'delimited' END AS kind, count(*) AS fields, 0 AS disagree
FROM (SELECT DISTINCT 'pilot100_manifest' AS table_name, Pilot_ID AS row_key, 'AMR_genotypes' AS field, AMR_genotypes AS t FROM pilot100_manifest
    UNION SELECT 'execution', id::VARCHAR, 'input_ids', input_ids FROM execution UNION SELECT 'execution', id::VARCHAR, 'output_paths', output_paths FROM execution)
WHERE t IS NOT NULL AND trim(t, {_B}) NOT IN ('', '.', 'NA', 'MISSING') GROUP BY ALL""",
    "p6_found": _P6 + "SELECT table_name, period, row_id, reason FROM direct WHERE reason IS NOT NULL AND table_name <> 'execution'",
    "p6_cascade": _P6
    + """, d AS (SELECT table_name, period, row_id::VARCHAR AS row_id, 'direct' AS kind, reason FROM direct WHERE reason IS NOT NULL)
SELECT * FROM d UNION ALL
SELECT 'attempt_log', strftime(min(recorded_at) AT TIME ZONE 'UTC', '%Y-%m'), id::VARCHAR, 'inherited', 'execution' FROM attempt_log
WHERE execution_id::VARCHAR IN (SELECT row_id FROM d WHERE table_name = 'execution')
AND id::VARCHAR NOT IN (SELECT row_id FROM d WHERE table_name = 'attempt_log') GROUP BY id""",
}
