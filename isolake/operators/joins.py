"""Joins of cohort tables. The left side of every join is the manifest; what does not match is kept or reported, never lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isolake.errors import ContractError, LimitError, MismatchError
from isolake.operators.guards import require_unique


def directional_join(manifest: DataFrame, calls: DataFrame, usable: Sequence[str], never: Sequence[str] = ("ND",), need_trait: Sequence[str] = ("I", "SDD"), trait: str | None = None, require_trait: bool = False, strict: bool = True) -> DataFrame:
    """(sample_id, phenotype, excluded) of every manifest sample, and of calls outside the manifest.

    `excluded` is null for usable rows, else the first that applies: NO_ASSEMBLY (no such sample), NO_CALL (only if not
    `strict`), UNUSABLE_CATEGORY (a category in `never`, one in `need_trait` without its trait, or none of `usable`), NO_TRAIT.
    With `strict` every manifest sample must have exactly one call.
    """
    m = require_unique(manifest.select("sample_id"), ["sample_id"], "manifest").where("sample_id IS NOT NULL")
    c = calls.where("sample_id IS NOT NULL")
    require_unique(c.join(m, "sample_id", "left_semi"), ["sample_id"], "calls")
    t = F.col(trait) if trait else F.lit(None).cast("double")
    c = c.select("sample_id", "phenotype", t.alias("trait"), F.lit(True).alias("called"))
    inside = m.join(c, "sample_id", "left")
    if strict:
        lost = inside.where("called IS NULL").select("sample_id").orderBy("sample_id").limit(10).collect()
        if lost:
            raise MismatchError(f"no call for {[r[0] for r in lost]}")
    outside = c.join(m, "sample_id", "left_anti").select("sample_id", "phenotype", F.lit("NO_ASSEMBLY").alias("excluded"))
    ph = F.col("phenotype")
    unusable = ph.isNull() | ph.isin(*never) | (ph.isin(*need_trait) & F.col("trait").isNull()) | ~ph.isin(*usable, *need_trait)
    reason = F.when(F.col("called").isNull(), "NO_CALL").when(unusable, "UNUSABLE_CATEGORY").when(F.lit(require_trait) & F.col("trait").isNull(), "NO_TRAIT")
    return inside.select("sample_id", "phenotype", reason.alias("excluded")).unionByName(outside)


def group_to_manifest(manifest: DataFrame, records: DataFrame, value: Column, name: str = "values") -> DataFrame:
    """Every manifest sample with the sorted array of its records' values (empty if none); orphans are reported by `orphan_count`."""
    r = records.select("sample_id", value.alias("__v")).where("sample_id IS NOT NULL")
    grouped = r.groupBy("sample_id").agg(F.sort_array(F.collect_list("__v")).alias(name))
    return manifest.select("sample_id").join(grouped, "sample_id", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def orphan_count(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose sample is not in the manifest, by sample."""
    return records.where("sample_id IS NOT NULL").join(manifest.select("sample_id"), "sample_id", "left_anti").groupBy("sample_id").agg(F.count(F.lit(1)).alias("records"))


def lineage_labels(manifest: DataFrame, typing: DataFrame, label: str, unknown: str = "unknown") -> DataFrame:
    """Every manifest sample with its label, or the word for an unknown one."""
    return manifest.select("sample_id").join(typing.select("sample_id", F.col(label).alias("lineage")), "sample_id", "left").withColumn("lineage", F.coalesce("lineage", F.lit(unknown)))


def strict_two_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that refuses keys missing on either side."""
    require_unique(left, [key], "left")
    require_unique(right, [key], "right")
    both = left.withColumn("__l", F.lit(True)).join(right.withColumn("__r", F.lit(True)), key, "full_outer")
    off = both.where("__l IS NULL OR __r IS NULL").select(key).orderBy(key).limit(10).collect()
    if off:
        raise MismatchError(f"keys on one side only: {[r[0] for r in off]}")
    return both.drop("__l", "__r")


def lookup(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str], default: str | None = None) -> DataFrame:
    """Left join to a dimension that has one row a key; `default` replaces what is not found. Spark broadcasts the dimension if it is small."""
    d = require_unique(dimension.select(key, *columns), [key], "dimension")
    out = df.join(d, key, "left")
    return out if default is None else out.withColumns({c: F.coalesce(c, F.lit(default)) for c in columns})


def scoped(dimension: DataFrame, scope: str, value: str, everything: str = "all") -> DataFrame:
    """Rows whose scope list (comma separated) holds `value` or the word for everything."""
    words = F.transform(F.split(F.coalesce(F.col(scope), F.lit("")), ","), lambda x: F.trim(x))
    return dimension.where(F.arrays_overlap(words, F.array(F.lit(value), F.lit(everything))))


def intact_locus(calls: DataFrame, loss: DataFrame, alleles: DataFrame) -> DataFrame:
    """Calls in genes subject to loss of function, without a variant allele of the same sample and gene."""
    return calls.join(loss.select("gene").distinct(), "gene", "left_semi").join(alleles.select("sample_id", "gene").distinct(), ["sample_id", "gene"], "left_anti")


def point_in_interval(points: DataFrame, intervals: DataFrame, group: Sequence[str], pos: str, start: str, end: str, width: int) -> DataFrame:
    """Every (point, interval) with start <= pos <= end in the same group: bins make it an equi-join.

    An interval is repeated for each bin of `width` it touches, a point falls into one, so each match is found once. Null
    positions and bounds match nothing; an interval may hold many points and a point lie in many intervals. Column names must not clash beyond `group`.
    """
    if width <= 0:
        raise ContractError("the bin width must be positive")
    p = points.where(F.col(pos).isNotNull()).withColumn("__bin", F.floor(F.col(pos) / width))
    i = intervals.where(F.col(start) <= F.col(end)).withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return p.join(i, [*group, "__bin"]).where((F.col(pos) >= F.col(start)) & (F.col(pos) <= F.col(end))).drop("__bin")


def merged_spans(spans: DataFrame, group: Sequence[str], start: str, end: str) -> DataFrame:
    """Overlapping or touching closed spans of a group merged into one, by a running maximum of ends."""
    w = Window.partitionBy(*group).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(reach.isNull() | (F.col(start) > reach + 1), 1).otherwise(0)
    s = spans.where(F.col(start) <= F.col(end)).withColumn("__first", first)
    s = s.withColumn("__island", F.sum("__first").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(*group, "__island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__island")


def locus_coverage(spans: DataFrame, loci: DataFrame, group: Sequence[str], locus: str, start: str, end: str, locus_start: str, locus_end: str, width: int = 10_000) -> DataFrame:
    """Share of each locus that the union of spans covers (0 where none), per group and locus; spans are clipped to the locus first.

    `group` columns beyond those of `loci` (such as the sample) form the grid of the spans seen.
    """
    on = [g for g in group if g in loci.columns]
    s = spans.where(F.col(start) <= F.col(end)).withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    k = loci.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(locus_start) / width), F.floor(F.col(locus_end) / width))))
    hit = s.join(k, [*on, "__bin"]).where((F.col(start) <= F.col(locus_end)) & (F.col(end) >= F.col(locus_start))).drop("__bin").distinct()
    clipped = hit.select(*group, locus, locus_start, locus_end, F.greatest(start, locus_start).alias("__s"), F.least(end, locus_end).alias("__e"))
    merged = merged_spans(clipped, [*group, locus, locus_start, locus_end], "__s", "__e")
    return merged.groupBy(*group, locus, locus_start, locus_end).agg(F.sum(F.col("__e") - F.col("__s") + 1).alias("__n")).select(
        *group, locus, (F.col("__n") / (F.col(locus_end) - F.col(locus_start) + 1)).alias("coverage")
    )


def product(left: DataFrame, right: DataFrame, max_cells: int | None, rows_per_part: int = 1000) -> DataFrame:
    """Every combination of the rows of two dimensions. The product is the result, so its size is checked first, unless `max_cells` is None.

    The right side is cut into parts of about `rows_per_part` rows, the left side into spreads; each pair of them meets by an equi-join, so
    neither side is gathered whole in one task.
    """
    m = right.count()
    n = left.count() * m
    if max_cells is not None and n > max_cells:
        raise LimitError(f"a product of {n} rows is above {max_cells}")
    parts = max(1, -(-m // rows_per_part))
    spreads = max(1, -(-n // max(1, m) // 100_000))
    l = left.withColumn("__spread", F.pmod(F.xxhash64(*left.columns), F.lit(spreads))).withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    r = right.withColumn("__part", F.pmod(F.xxhash64(*right.columns), F.lit(parts)).cast("int")).withColumn("__spread", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spreads - 1).cast("long"))))
    return l.join(r, ["__part", "__spread"]).select(*left.columns, *right.columns)


def grid(left: DataFrame, right: DataFrame, values: DataFrame, keys: Sequence[str], max_cells: int = 100_000_000) -> DataFrame:
    """Every combination of two dimensions with its value or null."""
    return product(left, right, max_cells).join(values, list(keys), "left")


def mixed_annotation(df: DataFrame, keys: Sequence[str], value: str, name: str, none: str = "not_assessed") -> DataFrame:
    """Per key: the value, `mixed:a,b` of several, or the word for none."""
    vs = F.array_sort(F.collect_set(value))
    return df.groupBy(*keys).agg(F.when(F.size(vs) == 0, none).when(F.size(vs) == 1, vs[0]).otherwise(F.concat(F.lit("mixed:"), F.array_join(vs, ","))).alias(name))


def evidence_union(baseline: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """All keys of both with flags; baseline keys come first in `ord`, then the others, each by name."""
    b = baseline.select(key).distinct().withColumn("in_baseline", F.lit(True))
    m = more.select(key).distinct().withColumn("in_more", F.lit(True))
    out = b.join(m, key, "full_outer").select(key, F.coalesce("in_baseline", F.lit(False)).alias("in_baseline"), F.coalesce("in_more", F.lit(False)).alias("in_more"))
    return out.withColumn("ord", F.when(F.col("in_baseline"), 0).otherwise(1))
