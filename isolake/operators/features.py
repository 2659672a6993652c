"""Feature engineering: rules as data make one long table (sample_id, feature, value); matrices are pivoted at the sink only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isolake.errors import ContractError, LimitError


def gene_features(presence: DataFrame, kind: str = "gene") -> DataFrame:
    return presence.select("sample_id", F.concat(F.lit(f"{kind}__"), F.col("gene")).alias("feature")).distinct().withColumn("value", F.lit(1))


def determinant_features(calls: DataFrame, antibiotic: str | None = None, kind: str = "amr") -> DataFrame:
    """Feature per gene, or gene_variant where a variant is known. A variant without a gene is refused when its row is read."""
    c = calls if antibiotic is None else calls.where(F.col("antibiotic") == antibiotic)
    name = F.when(F.col("variant").isNotNull() & F.col("gene").isNull(), F.raise_error(F.lit("variant without a gene"))).when(F.col("variant").isNotNull(), F.concat_ws("_", "gene", "variant")).otherwise(F.col("gene"))
    c = c.where("sample_id IS NOT NULL AND (gene IS NOT NULL OR variant IS NOT NULL)")
    return c.select("sample_id", F.concat(F.lit(f"{kind}__"), name).alias("feature")).where("feature IS NOT NULL").distinct().withColumn("value", F.lit(1))


@dataclass(frozen=True)
class Rule:
    """A feature is 1 for a sample if any (`all`: every) of its conditions holds in at least one of the sample's rows."""

    feature: str
    conditions: Sequence[Column]
    need: str = "any"


def rule_features(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(sample_id, feature, value) of the rules that hold, in one pass over the rows; value is always 1."""
    flags = [F.max(F.coalesce(c, F.lit(False))).alias(f"r{i}_{j}") for i, r in enumerate(rules) for j, c in enumerate(r.conditions)]
    g = rows.where("sample_id IS NOT NULL").groupBy("sample_id").agg(*flags)
    made = []
    for i, r in enumerate(rules):
        parts = [F.col(f"r{i}_{j}") for j in range(len(r.conditions))]
        held = parts[0]
        for p in parts[1:]:
            held = (held & p) if r.need == "all" else (held | p)
        made.append(F.when(held, F.lit(r.feature)))
    return g.select("sample_id", F.explode(F.array_compact(F.array(*made))).alias("feature")).withColumn("value", F.lit(1))


def prefix_family_features(calls: DataFrame, families: DataFrame, kind: str = "family") -> DataFrame:
    """Feature per gene family; a gene belongs to the family with the longest matching prefix. Families (family, gene_prefix) are a small dimension."""
    genes = calls.select("gene").where("gene IS NOT NULL").distinct()
    pre = families.withColumn("n", F.length("gene_prefix"))
    lengths = pre.agg(F.array_sort(F.collect_set("n"))).scalar()  # one number a length of prefix
    g = genes.withColumn("n", F.explode(lengths)).select("gene", F.substr("gene", F.lit(1), F.col("n")).alias("p")).join(pre, F.col("p") == F.col("gene_prefix"))
    best = g.groupBy("gene").agg(F.max_by("family", F.struct("n", "family")).alias("family"))
    return calls.join(best, "gene").select("sample_id", F.concat(F.lit(f"{kind}__"), F.col("family")).alias("feature")).where("sample_id IS NOT NULL").distinct().withColumn("value", F.lit(1))


def locus_features(status: DataFrame, disrupted: Sequence[str] = ("absent", "disrupted")) -> DataFrame:
    """(sample_id, feature, value) with 1 for a lost locus, 0 for a kept one and null where it was not assessed."""
    v = F.when(F.col("status") == "not_assessed", None).when(F.col("status").isin(*disrupted), 1).otherwise(0)
    return status.select("sample_id", F.concat(F.lit("locus__"), F.col("gene"), F.lit("_lost")).alias("feature"), v.cast("int").alias("value"))


def partial_call_flag(df: DataFrame, flag: str) -> DataFrame:
    """(sample_id, value): 1 if any row has the flag, 0 if rows were seen without, null if only nulls were."""
    return df.groupBy("sample_id").agg(F.max(F.col(flag).cast("int")).alias("value"))


def drop_rule(features: DataFrame, n_samples: int, min_carriers: int = 5, max_prevalence: float = 0.98) -> DataFrame:
    """(feature, carriers, dropped): the reason a feature is dropped, or null."""
    g = features.groupBy("feature").agg(F.sum(F.when(F.col("value") == 1, 1).otherwise(0)).alias("carriers"))
    return g.withColumn("dropped", F.when(F.col("carriers") < min_carriers, f"carriers<{min_carriers}").when(F.col("carriers") > F.lit(max_prevalence) * n_samples, f"prevalence>{max_prevalence}"))


def ordered_columns(features: DataFrame, families: Sequence[str], max_columns: int = 10_000) -> list[str]:
    """Columns of a matrix: by rank of the family before `__`, then by name. Undeclared families and too many columns are refused."""
    kind = F.substring_index("feature", "__", 1)
    names = [r[0] for r in features.select("feature").distinct().orderBy(F.array_position(F.array(*[F.lit(f) for f in families]), kind), "feature").limit(max_columns + 1).collect()]
    if len(names) > max_columns:
        raise LimitError(f"more than {max_columns} columns")
    bad = sorted({n for n in names if n.partition("__")[0] not in families})
    if bad:
        raise ContractError(f"undeclared feature families: {bad[:10]}")
    return names


def feature_matrix(features: DataFrame, manifest: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row a manifest sample, one 0/1 column a feature; what is not there is 0."""
    m = features.where("value = 1").groupBy("sample_id").pivot("feature", list(columns)).agg(F.max("value"))
    return manifest.select("sample_id").join(m, "sample_id", "left").na.fill(0, list(columns))


def disposition_counts(df: DataFrame, rules: Sequence[tuple[str, Column]], otherwise: str = "kept") -> DataFrame:
    """(disposition, n) of one pass: each row takes the first rule that holds. Every disposition is listed, with 0 if unseen."""
    d = F.lit(otherwise)
    for name, c in reversed(list(rules)):
        d = F.when(c, name).otherwise(d)
    counted = df.groupBy(d.alias("disposition")).agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(n,) for n, _ in rules] + [(otherwise,)], "disposition string")
    return names.join(counted, "disposition", "left").select("disposition", F.coalesce("n", F.lit(0)).alias("n"))
