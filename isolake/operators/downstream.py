"""What follows an association scan: a gate on known positives, conditional and stratified tests, pairs with known features, meta-analysis, tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isolake.errors import ContractError
from isolake.operators import stats, windows
from isolake.operators.joins import product
from isolake.operators.sets import without_features
from isolake.session import materialise


def control_outcomes(results: DataFrame, controls: DataFrame, threshold: float = 0.05) -> DataFrame:
    """(control, members, adjusted_p_value, recovered) of controls (control, member): recovered if any member feature reaches the threshold."""
    label = F.when(F.instr("feature", "__") > 0, F.substr("feature", F.instr("feature", "__") + 2)).otherwise(F.col("feature"))
    r = results.select(label.alias("member"), "adjusted_p_value")
    j = controls.join(r, "member", "left").groupBy("control").agg(F.count("adjusted_p_value").alias("members"), F.min("adjusted_p_value").alias("adjusted_p_value"))
    return j.withColumn("recovered", F.coalesce(F.col("adjusted_p_value") <= threshold, F.lit(False)))


def control_gate(results: DataFrame, controls: DataFrame, threshold: float = 0.05) -> DataFrame:
    """The outcomes, if every control is recovered; refused otherwise."""
    out = control_outcomes(results, controls, threshold)
    lost = out.where("NOT recovered").orderBy("control").limit(10).collect()
    if lost:
        raise ContractError(f"controls not recovered: {[r['control'] for r in lost]}")
    return out


def anchored_pairs(features: DataFrame, known: DataFrame, max_pairs: int | None) -> DataFrame:
    """(feature_a, feature_b): known features with every other one. The product is the result; with `max_pairs` its size is checked first."""
    names = features.select("feature").distinct()
    k = names.join(known.select("feature").distinct(), "feature", "left_semi")
    novel = names.join(known.select("feature").distinct(), "feature", "left_anti")
    return product(novel.select(F.col("feature").alias("feature_b")), k.select(F.col("feature").alias("feature_a")), max_pairs).select("feature_a", "feature_b")


def anchored_scan(features: DataFrame, known: DataFrame, design: DataFrame, max_pairs: int | None) -> DataFrame:
    """Product terms of every known testable feature with every other testable one, false-discovery adjusted.

    More than `max_pairs` pairs are refused, never cut; with None every pair is fitted, however many there are. (feature_a known, feature_b, n_both, beta, p_value, adjusted_p_value.)
    """
    f = materialise(stats.carriers(features, design), "carriers")
    known = materialise(known.select("feature").distinct(), "known")
    names = materialise(stats.testable(f, design.where("y IN (0, 1)"), carried=True).select("feature"), "testable")
    pairs = materialise(anchored_pairs(names, known, max_pairs), "anchored")
    return windows.benjamini_hochberg(stats.interaction_scan(pairs, f, design, product=True, carried=True))


def stratified_scan(features: DataFrame, outcome: DataFrame, known: DataFrame, min_group: int = 1) -> DataFrame:
    """The association scan over the samples that carry none of the known features; `known` (feature) is a table, the carriers are in `features`."""
    values = features.withColumn("value", F.lit(1))
    stratum = without_features(values, outcome.select("sample_id").distinct(), known)
    free = features.join(known.select("feature").distinct(), "feature", "left_anti")
    return stats.association_scan(free, outcome.join(stratum, "sample_id", "left_semi"), min_group)


def lineage_meta(features: DataFrame, outcome: DataFrame, lineages: DataFrame) -> DataFrame:
    """Pooled log odds ratios of each feature over the lineages."""
    o = outcome.where("y IN (0, 1)").select("sample_id", "y").distinct().join(lineages.where("lineage IS NOT NULL").select("sample_id", "lineage").distinct(), "sample_id")
    st = o.groupBy("lineage").agg(F.sum("y").alias("n1"), F.count(F.lit(1)).alias("n"))
    f = features.select("feature", "sample_id").distinct().join(o, "sample_id").groupBy("feature", "lineage").agg(F.sum("y").alias("a"), (F.count(F.lit(1)) - F.sum("y")).alias("b"))
    return stats.meta_analysis(f.join(st, "lineage").select("feature", "a", "b", (F.col("n1") - F.col("a")).alias("c"), (F.col("n") - F.col("n1") - F.col("b")).alias("d")))


def evidence(features: DataFrame, design: DataFrame, lineages: DataFrame, covariates: Sequence[str], controls: DataFrame | None = None, known: DataFrame | None = None, alpha: float = 0.05, floor: int = 2, gate_alpha: float = 0.05) -> DataFrame:
    """What is known of each feature: scan, conditional test, scan of the stratum without known features, lineages, pooled effect and tier.

    With `controls` (control, member) nothing is reported unless every control is recovered at `gate_alpha`.
    """
    scan = windows.benjamini_hochberg(stats.association_scan(features, design))
    if controls is not None:
        control_gate(scan, controls, gate_alpha)
    tested = features.join(scan.select("feature"), "feature", "left_semi")
    cond = windows.benjamini_hochberg(stats.conditional_scan(tested, design, covariates), "lrt_p", name="adjusted_lrt_p")
    wide = stats.convergence(features, lineages).select("feature", F.col("independent_lineages").alias("lineages"))
    meta = lineage_meta(tested, design, lineages).select("feature", "strata", "log_or", F.col("p_value").alias("meta_p"))
    out = scan.select("feature", "p_value", "adjusted_p_value").join(cond.select("feature", "lrt_p", "adjusted_lrt_p"), "feature", "left").join(wide, "feature", "left").join(meta, "feature", "left")
    if known is not None:
        out = out.join(stratified_scan(features, design.where("y IN (0, 1)").select("sample_id", "y"), known).select("feature", F.col("p_value").alias("stratum_p")), "feature", "left")
    passes = lambda c: F.coalesce(F.col(c) <= alpha, F.lit(False))
    return out.withColumn("tier", stats.tier_of(passes("adjusted_lrt_p"), F.coalesce("lineages", F.lit(0)), passes("adjusted_p_value"), floor))
