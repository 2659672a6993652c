import math
import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from isolake import errors, query
from isolake.functions import scalars as fn
from isolake.operators import aggregates as agg
from isolake.operators import features as feat
from isolake.operators import downstream, guards, joins, sets, stats, windows
from tests.conftest import rows


# guards and joins


def test_guards_name_offenders(spark):
    d = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    with pytest.raises(errors.DuplicateKeyError, match="'a'"):
        guards.require_unique(d, ["k"])
    with pytest.raises(errors.DuplicateKeyError, match="null in part"):
        guards.require_unique(d.where("v > 1"), ["k", "v"])
    with pytest.raises(errors.ContractError, match="'b'"):
        guards.require_vocabulary(d, "k", ["a"])
    with pytest.raises(errors.MismatchError, match="c only in left"):
        guards.require_same_keys(spark.createDataFrame([("c",), ("b",)], "k string"), spark.createDataFrame([("b",)], "k string"), "k")
    with pytest.raises(PySparkException, match="do not sum"):
        guards.require_sum(spark.createDataFrame([(1, 2, 4)], "a int, b int, t int"), ["a", "b"], "t").collect()


def test_directional_join(spark):
    m = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("s4",), ("s5",)], "sample_id string")
    c = spark.createDataFrame([("s1", "R", 4.0), ("s2", "ND", 1.0), ("s3", "I", None), ("s4", "I", 2.0), ("s5", "S", None), ("x", "R", 1.0)], "sample_id string, phenotype string, mic double")
    got = {r.sample_id: r.excluded for r in joins.directional_join(m, c, ("R", "S"), trait="mic", require_trait=True).collect()}
    assert got == {"s1": None, "s2": "UNUSABLE_CATEGORY", "s3": "UNUSABLE_CATEGORY", "s4": None, "s5": "NO_TRAIT", "x": "NO_ASSEMBLY"}
    with pytest.raises(errors.MismatchError, match="s5"):
        joins.directional_join(m, c.where("sample_id <> 's5'"), ("R", "S"))
    with pytest.raises(errors.DuplicateKeyError):
        joins.directional_join(m, c.union(c), ("R", "S"))


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_point_in_interval_equals_the_nested_loop(spark, width):
    rnd = random.Random(width)
    pts = [(rnd.choice("ab"), k, rnd.choice([None, rnd.randrange(100)])) for k in range(60)]
    ivs = [(rnd.choice("ab"), k, s := rnd.randrange(100), s + rnd.randrange(-2, 30)) for k in range(40)]
    want = sorted((p[1], i[1]) for p in pts for i in ivs if p[0] == i[0] and p[2] is not None and i[2] <= p[2] <= i[3])
    got = joins.point_in_interval(spark.createDataFrame(pts, "g string, p int, x int"), spark.createDataFrame(ivs, "g string, i int, s int, e int"), ["g"], "x", "s", "e", width)
    assert rows(got, "p", "i") == want


def test_locus_coverage_equals_counting_positions(spark):
    rnd = random.Random(1)
    spans = [(rnd.choice("ab"), s := rnd.randrange(80), s + rnd.randrange(-1, 20)) for _ in range(30)]
    loci = [("l1", 10, 29), ("l2", 25, 70), ("l3", 200, 210)]
    want = {}
    for g in "ab":
        for name, lo, hi in loci:
            n = len({x for gg, s, e in spans if gg == g for x in range(max(s, lo), min(e, hi) + 1)})
            if n:
                want[g, name] = n / (hi - lo + 1)
    got = joins.locus_coverage(spark.createDataFrame(spans, "g string, s long, e long"), spark.createDataFrame(loci, "locus string, lo long, hi long"), ["g"], "locus", "s", "e", "lo", "hi", 16)
    assert {(r.g, r.locus): pytest.approx(r.coverage) for r in got.collect()} == want


def test_set_operators(spark):
    d = spark.createDataFrame([(f"s{k}", "big" if k < 4 else None if k == 6 else "small") for k in range(7)], "k string, g string")
    assert [r.k for r in sets.round_robin(d, "g", "k", 5).collect()] == ["s0", "s4", "s6", "s1", "s5"]
    with pytest.raises(errors.MismatchError):
        sets.head_natural(d, ["k"], 8)
    ids = spark.createDataFrame([(1, "s5"), (2, "zz"), (3, "s0")], "position int, k string")
    found, missing = sets.listed(d, "k", ids)
    assert [r.k for r in found.collect()] == ["s5", "s0"] and rows(missing, "k") == [("zz",)]
    with pytest.raises(errors.MismatchError, match="zz"):
        sets.subset(d, "k", ids)


def test_farthest_points(spark):
    v = spark.createDataFrame([(1, [0.0, 0.0]), (2, [10.0, 0.0]), (3, [0.0, 10.0]), (4, [0.1, 0.0]), (5, None)], "id long, v array<double>")
    assert [r.id for r in sets.farthest_points(v, "id", "v", 3).orderBy("ord").collect()] == [4, 3, 2]
    assert len(sets.farthest_points(v, "id", "v", 9).collect()) == 4
    assert sets.farthest_points(v.limit(0), "id", "v", 3).count() == 0


# what used to be cut off


def test_grids_are_whole(spark):
    """More categories than a thousand, and both sides of a product in several parts."""
    c = spark.range(1100).select(F.col("id").cast("string").alias("sample_id"), F.concat(F.lit("c"), F.col("id")).alias("category"))
    f = spark.createDataFrame([("f1", "3"), ("f2", "1099")], "feature string, sample_id string")
    x = agg.crosstab(f, c)
    assert x.count() == 2200 and x.where("carriers = 1").count() == 2 and x.where("category = 'c1099' AND feature = 'f2'").first().carriers == 1
    p = joins.product(spark.range(30).toDF("a"), spark.range(25).toDF("b"), 750, rows_per_part=4)
    assert p.count() == p.distinct().count() == 750
    with pytest.raises(errors.LimitError):
        joins.product(spark.range(30).toDF("a"), spark.range(25).toDF("b"), 749)


def test_deep_trees_and_cycles(spark):
    t = spark.createDataFrame([(f"n{k:04}", f"n{k - 1:04}" if k else None, 1.0) for k in range(300)], "node string, parent string, length double")
    up = agg.ancestors(t)
    assert up.where("below = 'n0299'").count() == 300 and up.agg(F.max("steps")).first()[0] == 299
    with pytest.raises(errors.ContractError, match="cycle"):
        agg.ancestors(spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("c", "a", 1.0)], "node string, parent string, length double"))


def test_the_longest_of_many_prefixes_wins(spark):
    fam = spark.createDataFrame([(f"f{n}", "x" * n) for n in range(1, 260)], "family string, gene_prefix string")
    calls = spark.createDataFrame([("s", "x" * 250 + "y"), ("t", "x" * 300), ("u", None)], "sample_id string, gene string")
    assert rows(feat.prefix_family_features(calls, fam), "sample_id", "feature") == [("s", "family__f250"), ("t", "family__f259")]


def test_pair_counts_of_large_samples_go_by_blocks(spark):
    d = spark.createDataFrame([("s", f"n{k:02}") for k in range(40)] + [("t", "n00"), ("t", "n39"), ("t", None), (None, "n01")], "sample_id string, name string")
    whole = rows(stats.pair_counts(d))
    assert len(whole) == 780 and rows(stats.pair_counts(d, block=7)) == whole
    assert rows(stats.matrix_pair_counts(d, columns=9)) == sorted((a, b, n) for a, b, _, _, n, _ in whole)


def test_adjusted_p_values_with_a_hot_value_and_null_groups(spark):
    d = spark.createDataFrame([(k, None if k % 2 else "g", 1.0 if k % 3 else k / 100) for k in range(60)] + [(99, "g", None)], "id long, g string, p_value double")
    got = {r.id: r.adjusted_p_value for r in windows.benjamini_hochberg(d, by=["g"], buckets=4).collect()}
    assert got[99] is None and len(got) == 61
    for g in (0, 1):
        p = sorted((1.0 if k % 3 else k / 100, k) for k in range(60) if k % 2 == g)
        least = 1.0
        for rank in range(len(p), 0, -1):
            least = min(least, p[rank - 1][0] * len(p) / max(r for r, x in enumerate(p, 1) if x[0] == p[rank - 1][0]))
            assert got[p[rank - 1][1]] == pytest.approx(least)


def test_conditional_and_anchored_scans_equal_fits_on_samples(spark):
    """Fits on counts against fits on a row a sample, and no bound on the samples."""
    rnd = random.Random(6)
    design = [(f"s{k:03}", rnd.randrange(2), rnd.randrange(2), rnd.randrange(3)) for k in range(120)]
    carriers = {f: {s for s, *_ in design if rnd.random() < p} for f, p in (("a", 0.3), ("b", 0.5), ("k", 0.4), ("all", 1.1), ("one", 0.005))}
    carriers["same"] = {s for s, _, x, _ in design if x}
    f = spark.createDataFrame([(n, s) for n, ss in carriers.items() for s in ss] + [("a", "nowhere"), (None, "s000"), ("a", None)], "feature string, sample_id string")
    d = spark.createDataFrame(design + [("s900", None, 1, 1)], "sample_id string, y int, x int, z int")
    y = np.array([r[1] for r in design], float)
    x0 = np.array([[1, r[2], r[3]] for r in design], float)
    base = stats.fit_logit(x0, y)[1]
    got = {r.feature: r for r in stats.conditional_scan(f, d, ["x", "z"]).collect()}
    for n in ("a", "b", "k"):
        v = np.array([r[0] in carriers[n] for r in design], float)
        beta, ll, _, cov = stats.fit_logit(np.column_stack([x0, v]), y)
        assert got[n].carriers == v.sum() and got[n].n == 120
        assert got[n].beta == pytest.approx(beta[-1], abs=1e-6) and got[n].lrt_p == pytest.approx(stats.lrt_p(ll, base), abs=1e-8)
        assert got[n].wald_z == pytest.approx(beta[-1] / math.sqrt(cov[-1, -1]), abs=1e-5)
    assert got["all"].collinear and got["same"].collinear and got["same"].lrt_p == 1.0
    scan = downstream.anchored_scan(f, spark.createDataFrame([("k",), ("not there",)], "feature string"), d, 100)
    pairs = {(r.feature_a, r.feature_b): r for r in scan.collect()}
    assert {b for _, b in pairs} >= {"a", "b", "same"} and {a for a, _ in pairs} == {"k"} and "all" not in {b for _, b in pairs}
    u, v = (np.array([r[0] in carriers[n] for r in design], float) for n in ("k", "b"))
    less, more = stats.fit_logit(np.column_stack([np.ones(120), u, v]), y), stats.fit_logit(np.column_stack([np.ones(120), u, v, u * v]), y)
    assert pairs["k", "b"].beta == pytest.approx(more[0][-1], abs=1e-5) and pairs["k", "b"].p_value == pytest.approx(stats.lrt_p(more[1], less[1]), abs=1e-7)
    assert pairs["k", "b"].n_both == int((u * v).sum())
    with pytest.raises(errors.LimitError):
        downstream.anchored_scan(f, spark.createDataFrame([("k",)], "feature string"), d, 1)
    declared = spark.createDataFrame([("a", "gone"), ("k", "b")], "feature_a string, feature_b string")
    r = {x.feature_b: x for x in stats.interaction_scan(declared, f, d).collect()}
    assert (r["gone"].n_both, r["gone"].beta, r["gone"].p_value) == (0, None, 1.0) and r["b"].beta == pytest.approx(more[0][-1], abs=1e-5)
    assert stats.conditional_scan(f.limit(0), d, ["x"]).count() == 0


def test_anchored_scan_query_takes_every_kind_and_tells_genes_from_kinds(spark, tmp_path):
    """All rows of the calls count, not those of one type; genes named like a kind stay genes."""
    from isolake.plans.more import s178_anchored_scan

    s = spark.range(24).selectExpr("concat('s', id) AS sample_id", "id")
    s.selectExpr("sample_id AS Isolate", "'meropenem' AS Antibiotic", "IF(id % 3 = 0, 'R', 'S') AS AST_phenotype").write.parquet(str(tmp_path / "pilot100_manifest.parquet"))
    kinds = [("efflux", "point", 2), ("efflux", "acquired", 4), ("enzyme", "intrinsic", 6)]
    calls = spark.createDataFrame(kinds, "mechanism string, determinant_type string, k int").crossJoin(s).where("id % k = 0").select("sample_id", "mechanism", "determinant_type")
    calls.unionByName(spark.createDataFrame([("s1", None, "point"), ("s1", "efflux", None)], calls.schema)).write.parquet(str(tmp_path / "amr_determinants.parquet"))
    genes = {"g": lambda i: i % 4 < 3, "x/point": lambda i: i % 3 == 1, "efflux/acquired": lambda i: i % 5 < 2}
    spark.createDataFrame([(g, f"s{i}", 1) for g, has in genes.items() for i in range(24) if has(i)], "gene string, sample_id string, present int").write.parquet(str(tmp_path / "gene_presence_absence.parquet"))
    want = {(f"{m}/{t}", g): sum(i % k == 0 and has(i) for i in range(24)) for m, t, k in kinds for g, has in genes.items()}
    assert {(r.feature_a, r.feature_b): r.n_both for r in s178_anchored_scan(spark, str(tmp_path)).collect()} == want


def test_many_fits_on_the_same_rows_equal_single_fits():
    rnd = np.random.default_rng(4)
    a, b, y = (np.array(v, float) for v in zip(*[(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]))
    w = np.concatenate([rnd.integers(0, 3, (60, 8)), rnd.integers(1, 40, (60, 8)), rnd.integers(0, 9000, (60, 8))]).astype(float)
    w = w[(w.reshape(-1, 4, 2).sum(axis=2) > 0).all(axis=1)]
    for x in (np.column_stack([np.ones(8), a, b]), np.column_stack([np.ones(8), a, b, a * b])):
        beta, ll = stats.fit_logits(x, y, w)
        for v, got, at in zip(w, beta, ll):
            want = stats.fit_logit(x[v > 0], y[v > 0], v[v > 0])
            assert at == pytest.approx(want[1], abs=1e-8) and (np.abs(want[0]).max() > 12 or got == pytest.approx(want[0], abs=1e-6))
    assert stats.fit_logits(np.ones((8, 1)), y, w[:0])[0].shape == (0, 1)


def test_anchored_scan_query_tests_more_pairs_than_the_former_limit(spark, tmp_path):
    """320 known kinds with 320 genes are 102,400 pairs; all are planned for, and counts from the samples equal those from the pairs."""
    from isolake.operators import joins
    from isolake.plans.more import s178_anchored_scan

    side = lambda n, x: spark.range(n).select(F.concat(F.lit(x), "id").alias(x))
    assert joins.product(side(320, "a"), side(320, "b"), None).distinct().count() == 102_400
    seen = []
    scan = downstream.anchored_scan
    try:
        downstream.anchored_scan = lambda f, k, d, most: seen.append(most) or scan(f, k, d, most)
        s = spark.range(24).selectExpr("concat('s', id) AS sample_id", "id")
        s.selectExpr("sample_id AS Isolate", "'meropenem' AS Antibiotic", "IF(id % 3 = 0, 'R', 'S') AS AST_phenotype").write.parquet(str(tmp_path / "pilot100_manifest.parquet"))
        s.where("id % 2 = 0").selectExpr("sample_id", "'efflux' AS mechanism", "'point' AS determinant_type").write.parquet(str(tmp_path / "amr_determinants.parquet"))
        s.where("id % 4 < 3").selectExpr("'g' AS gene", "sample_id", "1 AS present").write.parquet(str(tmp_path / "gene_presence_absence.parquet"))
        assert [(r.feature_a, r.feature_b, r.n_both) for r in s178_anchored_scan(spark, str(tmp_path)).collect()] == [("efflux/point", "g", 12)]
    finally:
        downstream.anchored_scan = scan
    assert seen == [None]
    rnd = random.Random(2)
    f = spark.createDataFrame([(n, f"s{i}") for n in "kabc" for i in range(40) if rnd.random() < 0.5], "feature string, sample_id string")
    d = spark.createDataFrame([(f"s{i}", rnd.randrange(2)) for i in range(40)], "sample_id string, y int")
    pairs = spark.createDataFrame([("k", "a"), ("k", "b"), ("k", "gone"), ("c", "a"), ("c", "b"), ("c", "gone")], "feature_a string, feature_b string")
    assert rows(stats.interaction_scan(pairs, f, d, product=True)) == rows(stats.interaction_scan(pairs, f, d))


def test_association_input_and_strata(spark):
    p = spark.createDataFrame([(f"s{k}", "R" if k < 5 else "S" if k < 11 else "I") for k in range(14)] + [("s0", "R"), (None, "R")], "sample_id string, phenotype string")
    o = stats.association_input(p, ["R"], ["S"])
    assert o.count() == 11
    with pytest.raises(errors.ContractError, match="6 are needed"):
        stats.association_input(p, ["R"], ["S"], min_group=6)
    f = spark.createDataFrame([("known", "s0"), ("g", "s0"), ("g", "s1"), ("g", "s2"), ("g", "s7")], "feature string, sample_id string")
    [r] = downstream.stratified_scan(f, o, spark.createDataFrame([("known",)], "feature string")).collect()
    assert (r.feature, r.a, r.k, r.n1, r.n) == ("g", 2, 3, 4, 10)


# aggregates and windows


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=30), st.sampled_from([0.5, 0.9]))
def test_nxx(spark, lengths, fraction):
    run, want = 0, None
    for n in sorted(lengths, reverse=True):
        run += n
        if run >= fraction * sum(lengths):
            want = n
            break
    d = spark.createDataFrame([("a", n) for n in lengths], "g string, n long")
    assert agg.nxx(d, ["g"], "n", fraction, "x").first().x == want


def bh(ps):
    m = len(ps)
    return [min(1.0, min(q * m / sum(r <= q for r in ps) for q in ps if q >= p)) for p in ps]


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_benjamini_hochberg(spark, buckets):
    rnd = random.Random(buckets)
    ps = [round(rnd.random() ** 3, 2) for _ in range(80)]
    d = spark.createDataFrame([(k, "a" if k % 3 else None, p) for k, p in enumerate(ps)] + [(99, "a", None)], "id int, g string, p_value double")
    got = {r.id: r.adjusted_p_value for r in windows.benjamini_hochberg(d, buckets=buckets).collect()}
    assert got.pop(99) is None
    assert [got[k] for k in range(80)] == pytest.approx(bh(ps))
    by = {r.id: r.adjusted_p_value for r in windows.benjamini_hochberg(d, by=["g"], buckets=buckets).collect()}
    for group in ([k for k in range(80) if k % 3], [k for k in range(80) if not k % 3]):
        assert [by[k] for k in group] == pytest.approx(bh([ps[k] for k in group]))


def test_pattern_count_and_combinations(spark):
    d = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f2", "b"), ("f2", "a"), ("f2", "a"), ("f3", "a"), ("f4", "c")], "f string, s string")
    r = agg.pattern_count(d, "f", "s").first()
    assert (r.patterns, r.features) == (3, 4)
    assert rows(agg.combinations(d, "s", "f")) == [("f1", 2), ("f1+f2", 2), ("f1+f2+f3", 1), ("f1+f3", 1), ("f2", 2), ("f2+f3", 1), ("f3", 1), ("f4", 1)]
    with pytest.raises(errors.ContractError):
        agg.combinations(d, "s", "f", max_names=3)


def test_tree_closure_and_patristic(spark):
    e = spark.createDataFrame([("r", None, None), ("x", "r", 1.0), ("y", "x", 2.0), ("a", "y", 3.0), ("b", "x", 4.0), ("c", "r", 5.0)], "node string, parent string, length double")
    tips = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    assert {(r.a, r.b): r.d for r in stats.patristic(e, tips).where("a < b").collect()} == {("a", "b"): 9.0, ("a", "c"): 11.0, ("b", "c"): 10.0}
    assert {r.node: r.mean_length for r in agg.clade_means(e).collect()}["x"] == pytest.approx(10 / 4)
    with pytest.raises(errors.MismatchError):
        stats.patristic(e, tips.union(tips))


# statistics


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 25), st.integers(0, 25), st.integers(0, 25), st.integers(0, 25))
def test_fisher_against_exact_binomials(a, b, c, d):
    row, col, n = a + b, a + c, a + b + c + d
    pmf = {x: math.comb(row, x) * math.comb(n - row, col - x) for x in range(max(0, row + col - n), min(row, col) + 1)}
    want = sum(v for v in pmf.values() if v <= pmf[a] * (1 + 1e-7)) / math.comb(n, col)
    assert stats.fisher_two_sided(a, row, col, n) == pytest.approx(want, rel=1e-9)


def test_chi_square_tails():
    assert stats.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05)
    assert stats.chi2_sf(5.991464547107979, 2) == pytest.approx(0.05)
    assert stats.chi2_sf(7.814727903251179, 3) == pytest.approx(0.05)
    assert stats.chi2_sf(18.307038053275146, 10) == pytest.approx(0.05)
    assert stats.chi2_sf(0, 4) == 1.0


def test_pair_counters_agree(spark):
    rnd = random.Random(6)
    data = [(f"s{rnd.randrange(40)}", f"f{rnd.randrange(12)}") for _ in range(300)]
    d = spark.createDataFrame(data, "sample_id string, name string")
    want = {}
    for s in {x for x, _ in data}:
        for p in combinations(sorted({f for x, f in data if x == s}), 2):
            want[p] = want.get(p, 0) + 1
    for df in (stats.pair_counts(d), stats.matrix_pair_counts(d, chunk=7)):
        assert {(r.feature_a, r.feature_b): r.n_both for r in df.collect()} == want


def test_logit_and_planted_signal(spark):
    rng = np.random.default_rng(3)
    n = 400
    cov, f = rng.integers(0, 2, n), rng.integers(0, 2, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(-1 + 0.5 * cov + 2.0 * f)))).astype(int)
    x = np.column_stack([np.ones(n), cov, f]).astype(float)
    beta, ll, separated, _ = stats.fit_logit(x, y.astype(float))
    mu = 1 / (1 + np.exp(-x @ beta))
    assert np.abs(x.T @ (y - mu)).max() < 1e-6 and not separated
    design = spark.createDataFrame([(f"s{i}", int(y[i]), int(cov[i])) for i in range(n)], "sample_id string, y int, cov int")
    carriers = [("real", f"s{i}") for i in range(n) if f[i]] + [("noise", f"s{i}") for i in range(0, n, 3)] + [("same", f"s{i}") for i in range(n) if cov[i]]
    got = {r.feature: r for r in stats.conditional_scan(spark.createDataFrame(carriers, "feature string, sample_id string"), design, ["cov"]).collect()}
    assert got["real"].lrt_p < 1e-6 and got["noise"].lrt_p > 1e-4 and got["same"].collinear and got["same"].lrt_p == 1.0
    with pytest.raises(errors.LimitError):
        stats.conditional_scan(spark.createDataFrame(carriers, "feature string, sample_id string"), design, ["cov"], max_patterns=3)


def test_meta_analysis_worked_example(spark):
    s = spark.createDataFrame([("f", 10, 20, 5, 40), ("f", 8, 12, 6, 30), ("one", 1, 2, 3, 4), ("f", 0, 0, 5, 5)], "feature string, a long, b long, c long, d long")
    r = stats.meta_analysis(s).collect()
    assert [x.feature for x in r] == ["f"] and r[0].strata == 2
    l = [math.log(10 * 40 / (20 * 5)), math.log(8 * 30 / (12 * 6))]
    w = [1 / (1 / 10 + 1 / 20 + 1 / 5 + 1 / 40), 1 / (1 / 8 + 1 / 12 + 1 / 6 + 1 / 30)]
    assert r[0].log_or == pytest.approx((l[0] * w[0] + l[1] * w[1]) / sum(w))
    assert r[0].p_value == pytest.approx(math.erfc(abs(r[0].z) / math.sqrt(2)))


def test_convergence_and_gower(spark):
    lin = spark.createDataFrame([(f"s{k}", f"L{k % 3}" if k < 9 else None) for k in range(10)], "sample_id string, lineage string")
    c = [("wide", f"s{k}") for k in range(8)] + [("rare", "s0")] + [("assoc", f"s{k}") for k in (0, 3, 6)] + [("rec", f"s{k}") for k in (0, 1, 2)] + [("unk", "s9"), ("unk", "zz"), ("unk", "yy")]
    got = {r.feature: r.category for r in stats.convergence(spark.createDataFrame(c, "feature string, sample_id string"), lin).collect()}
    assert got == {"wide": "widespread", "rare": "rare", "assoc": "lineage_associated", "rec": "recurrent", "unk": "unknown"}
    pts = {"a": 0.0, "b": 1.0, "c": 5.0}
    d = spark.createDataFrame([(x, y, abs(pts[x] - pts[y])) for x in pts for y in pts], "a string, b string, d double")
    m = np.array([[r.value for r in stats.gower_center(d).orderBy("a", "b").collect()][i * 3 : i * 3 + 3] for i in range(3)])
    assert np.abs(m.sum(0)).max() < 1e-9 and np.linalg.eigvalsh(m).min() > -1e-9


# scalars, features and the query layer


def test_scalars(spark):
    one = spark.range(1)
    ev = lambda c: one.select(c).first()[0]
    assert [ev(fn.format_cell(F.lit(x).cast("double"), "double")) for x in (0.0, 1.5, 123456.0, 1234567.0, 0.00001234, -2.0, 1 / 3)] == ["0", "1.5", "123456", "1.23457e+06", "1.234e-05", "-2", "0.333333"]
    assert ev(fn.format_cell(F.lit(None).cast("string"), "string")) == "."
    assert ev(fn.translate_sequence(F.lit("ATGTGGTAAC"))) == "MW*" and ev(fn.translate_sequence(F.lit("A"))) == ""
    with pytest.raises(PySparkException):
        ev(fn.translate_sequence(F.lit("ANG")))
    assert ev(fn.translate_sequence(F.lit("ANG"), "X")) == "X"
    assert ev(fn.clamp_claim(F.lit("SUPPORTED"), F.lit("PREDICTED"))) == "PREDICTED" and ev(fn.clamp_claim(F.lit("x"), F.lit(None).cast("string"))) == "UNKNOWN"
    assert ev(fn.clean_cell(F.lit(" NaN "))) is None and ev(fn.clean_cell(F.lit(" - "))) is None and ev(fn.clean_cell(F.lit("-"), fn.MODEL_NULLS)) == "-"
    with pytest.raises(ValueError):
        fn.log_trait(F.lit(1.0), 1)
    assert len(fn.codon_table()) == 64 and fn.codon_table()["ATG"] == "M"


def test_features(spark):
    f = spark.createDataFrame([("s1", "a__x", 1), ("s2", "a__x", 1), ("s1", "b__y", 1)], "sample_id string, feature string, value int")
    m = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sample_id string")
    cols = feat.ordered_columns(f, ["b", "a"])
    assert cols == ["b__y", "a__x"] and rows(feat.feature_matrix(f, m, cols)) == [("s1", 1, 1), ("s2", 0, 1), ("s3", 0, 0)]
    with pytest.raises(errors.ContractError):
        feat.ordered_columns(f, ["a"])
    assert rows(feat.drop_rule(f, 3, 2, 0.6), "feature", "dropped") == [("a__x", "prevalence>0.6"), ("b__y", "carriers<2")]
    with pytest.raises(PySparkException, match="variant without a gene"):
        feat.determinant_features(spark.createDataFrame([("s", None, "v")], "sample_id string, gene string, variant string")).collect()


def test_query_layer(spark):
    d = spark.createDataFrame([("a", "10", 1.0, ["x"]), ("b", "9", None, ["y", "x"]), ("c", "beta", 3.0, []), ("d", None, 2.0, None)], "id string, v string, n double, tags array<string>")
    page = lambda **k: [r.id for r in query.page(d, query.PageRequest(**k), tie=["id"]).collect()]
    assert page(sort="v") == ["b", "a", "c", "d"] and page(sort="-v") == ["d", "c", "a", "b"]
    assert page(clauses=(query.Clause("tags", "eq", "x"),)) == ["a", "b"] and page(clauses=(query.Clause("v", "eq", "9.0"),)) == ["b"]
    assert page(clauses=(query.Clause("n", "min", "2"),)) == ["c", "d"] and page(clauses=(query.Clause("n", "null", "1"),)) == ["b"]
    assert page(q="BET") == ["c"] and page(sort="id", offset=1, limit=2) == ["b", "c"]
    assert query.basis(d, query.PageRequest(q="bet", limit=5000)) == {"rows_total": 4, "rows": 1, "filtered": True, "limit_applied": 1000, "underpowered": True}
    for bad in (dict(sort="zz"), dict(columns=("zz",)), dict(clauses=(query.Clause("zz", "eq", "1"),)), dict(clauses=(query.Clause("id", "like", "1"),))):
        with pytest.raises(errors.UnknownNameError):
            page(**bad)


def test_mixed_sort_numbers_all_rows(spark, tmp_path):
    from isolake.functions.scalars import mixed_sort_key
    from isolake.plans.relational import s080_mixed_sort

    words = [None, "low", "high", "10", "9.5", "-1", "007"]
    d = [(i, words[i * 5 % 7]) for i in range(300)]

    def key(r):
        try:
            number = float(r[1])
        except (TypeError, ValueError):
            number = None
        return (r[1] is None, number is None, number or 0.0, r[1] or "", r[0])

    want = [(i, c, n) for n, (i, c) in enumerate(sorted(d, key=key), 1)]
    f = spark.createDataFrame(d, "call_id long, confidence string")
    cut = windows.numbered(f, [*mixed_sort_key(F.col("confidence")), "call_id"], ranges=5)
    assert sorted(map(tuple, cut.collect()), key=lambda r: r[2]) == want
    f.selectExpr("*", "'s' AS sample_id", "'g' AS gene").write.parquet(str(tmp_path / "amr_determinants.parquet"))
    assert sorted(map(tuple, s080_mixed_sort(spark, str(tmp_path)).collect()), key=lambda r: r[2]) == want


def test_squares_cover_tips_and_samples_and_refuse(spark, tmp_path):
    from isolake.plans.analysis import s164_feature_kinship, s165_patristic, s166_gower

    put = lambda name, sql: spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    put("region", "SELECT 0 AS r_regionkey")
    put("nation", "SELECT * FROM VALUES (0, 0), (1, 0) AS t(n_nationkey, n_regionkey)")
    put("supplier", "SELECT * FROM VALUES (1, 0), (2, 0), (3, 1) AS t(s_suppkey, s_nationkey)")
    put("sample_metadata", "SELECT sample_id, 'L1' AS lineage, 'clinical' AS data_class, 0 AS registered_at, 0 AS withdrawn_at FROM VALUES ('p'), ('q') AS t(sample_id)")
    put("amr_determinants", "SELECT * FROM VALUES ('p', 'x'), ('q', 'x'), ('q', 'y') AS t(sample_id, gene)")
    sf = str(tmp_path)
    d = s165_patristic(spark, sf)
    assert {(r.a, r.b): r.d for r in d.where("a < b").collect()} == {("s1", "s2"): 3.0, ("s1", "s3"): 7.0, ("s2", "s3"): 8.0}
    assert s166_gower(spark, sf).count() == 9
    assert rows(s164_feature_kinship(spark, sf), "a", "b", "value") == [("p", "p", 0.5), ("p", "q", 0.5), ("q", "q", 1.0)]
    e = spark.createDataFrame([("r", None, None), ("a", "r", 1.0), ("b", "r", 1.0)], "node string, parent string, length double")
    with pytest.raises(errors.LimitError):
        stats.patristic(e, e.where("node <> 'r'").select("node"), max_tips=1)
    with pytest.raises(errors.LimitError):
        stats.gower_center(d, max_points=2)


def _random_forest(rnd, n=60):
    """Edges in no order, several roots, a parent that is not there, negative and missing lengths; tips are any nodes."""
    names = [f"s{i}" for i in range(n)]
    edges = [(x, None if i in (0, 40) else "gone" if i == 50 else names[rnd.randrange(i)], rnd.choice([None, -1.0, 0.5, 2.0, 3.0])) for i, x in enumerate(names)]
    rnd.shuffle(edges)
    return edges, sorted(rnd.sample(names, 30)) + ["not there"]


def _distances_of_paths(edges, tips):
    up, length = {x: p for x, p, _ in edges}, {x: v or 0.0 for x, _, v in edges}

    def path(x):
        out = []
        while x in up:
            out.append(x)
            x = up[x]
        return out

    depth = {x: sum(length[y] for y in path(x)) for x in up}
    common = {(a, b): set(path(a)) & set(path(b)) for a in tips for b in tips}
    return {(a, b): depth[a] + depth[b] - 2 * max(depth[x] for x in s) for (a, b), s in common.items() if s}


def test_distances_of_more_tips_than_the_former_limit(spark):
    rnd = random.Random(3)
    edges, tips = _random_forest(rnd)
    e, t = spark.createDataFrame(edges, "node string, parent string, length double"), spark.createDataFrame([(x,) for x in tips], "node string")
    want = _distances_of_paths(edges, tips)
    got = {(r.a, r.b): r.d for r in stats.patristic(e, t).collect()}
    assert got == pytest.approx({k: v for k, v in want.items() if k[0] <= k[1]})
    n = 10_100
    wide = spark.range(n).selectExpr("concat('s', id) AS node", "concat('n', id % 3) AS parent", "CAST(1 AS DOUBLE) AS length").unionByName(spark.range(3).selectExpr("concat('n', id) AS node", "'root' AS parent", "CAST(id AS DOUBLE) AS length")).unionByName(spark.createDataFrame([("root", None, None)], e.schema))
    d = stats.patristic(wide, wide.where("node LIKE 's%'").select("node")).agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("s"), F.max(F.col("a") > F.col("b")).alias("swapped")).first()
    sizes = [sum(1 for i in range(n) if i % 3 == k) for k in range(3)]
    within = sum(k * (k - 1) // 2 * 2 for k in sizes)
    across = sum(sizes[i] * sizes[j] * (2 + i + j) for i in range(3) for j in range(i))
    assert (d.n, d.s, d.swapped) == (n * (n + 1) // 2, within + across, False)
    with pytest.raises(errors.ContractError, match="cycle"):
        stats.patristic(e.unionByName(spark.createDataFrame([("x", "y", 1.0), ("y", "x", 1.0)], e.schema)), t)
    with pytest.raises(errors.MismatchError):
        stats.patristic(e.unionByName(spark.createDataFrame([("s7", "s0", 99.0)], e.schema)), t)


def test_tree_similarity_is_the_centred_square(spark):
    rnd = random.Random(5)
    edges, tips = _random_forest(rnd)
    e, t = spark.createDataFrame(edges, "node string, parent string, length double"), spark.createDataFrame([(x,) for x in tips], "node string")
    square = spark.createDataFrame([(*k, v) for k, v in _distances_of_paths(edges, tips).items()], "a string, b string, d double")
    want = {(r.a, r.b): r.value for r in stats.gower_center(square).collect()}
    assert {(r.a, r.b): r.value for r in stats.tree_similarity(e, t).collect()} == pytest.approx(want)
    assert stats.tree_similarity(e, t.limit(0)).count() == 0


def test_kinship_in_blocks_and_of_more_samples_than_the_former_limit(spark):
    rnd = random.Random(8)
    cells = {(f"s{rnd.randrange(40)}", f"f{rnd.randrange(12)}"): rnd.choice([1.0, 2.0, -1.0, 0.0]) for _ in range(160)}
    v = spark.createDataFrame([(*k, x) for k, x in cells.items()] + [(None, "f1", 1.0), ("s1", None, 1.0), ("s2", "f20", None)], "sample_id string, feature string, value double")
    want: dict = {}
    for (a, f), x in cells.items():
        for (b, g), y in cells.items():
            if f == g and a <= b and x * y:
                want[a, b] = want.get((a, b), 0.0) + x * y
    m = len({f for _, f in cells} | {"f20"})
    for block in (4096, 7):
        got = [(r.a, r.b, r.value) for r in stats.feature_kinship(v, block=block).collect()]
        assert len(got) == len(want) and {(a, b): x for a, b, x in got} == pytest.approx({k: x / m for k, x in want.items()})
    n = 50_100
    many = spark.range(n).selectExpr("concat('s', id) AS sample_id", "concat('f', id DIV 10) AS feature", "1.0D AS value")
    r = stats.feature_kinship(many, m=2).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.max(F.col("a") > F.col("b")).alias("swapped")).first()
    assert (r.n, r.s, r.swapped) == (n // 10 * 55, n // 10 * 55 / 2, False)
    with pytest.raises(errors.LimitError):
        stats.feature_kinship(v, max_samples=5)
    assert stats.feature_kinship(v.limit(0)).count() == 0


def test_conditional_scan_query_tests_every_testable_gene(spark, tmp_path):
    from isolake.plans.analysis import s174_conditional_scan

    ids = [f"s{i:02d}" for i in range(20)]
    put = lambda name, d, schema: spark.createDataFrame(d, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    put("sample_metadata", [(s, "L01" if i % 3 else "L02", "clinical" if i % 2 else "reference", i, None) for i, s in enumerate(ids)], "sample_id string, lineage string, data_class string, registered_at int, withdrawn_at int")
    put("pilot100_manifest", [(s, "meropenem", "R" if i % 4 < 2 else "S") for i, s in enumerate(ids)], "Isolate string, Antibiotic string, AST_phenotype string")
    carriers = {"one": ids[:1], "two": ids[:2], "many": ids[:9], "all": ids}
    put("amr_determinants", [(s, g) for g, xs in carriers.items() for s in xs], "sample_id string, gene string")
    assert rows(s174_conditional_scan(spark, str(tmp_path)), "feature") == [("many",), ("two",)]
