import numpy as np
import pytest
from pyspark.sql import functions as F

from isolake import errors
from isolake.operators import locus, mixed, stats
from isolake.sources import pages, reports, sequences, tsv
from isolake.streaming import events as ev
from tests.conftest import rows


def typing(spark, *lines, samples=("a", "b")):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return reports.legacy_typing(df, spark.createDataFrame([(s,) for s in samples], "sample_id string"))


def test_legacy_typing(spark):
    got = {r.sample_id: r for r in typing(spark, "FILE\tSCHEME\tST\tx\ty", "/d/b.fna\tpa\t-\t?\t-", "a.fna\tpa\t17\t3\t4", "z.fna\tpa\t1\t1\t1").collect()}
    assert (got["a"].st, got["a"].alleles, got["a"].partial) == ("17", {"x": "3", "y": "4"}, [])
    assert (got["b"].st, got["b"].alleles, got["b"].partial, got["b"].found) == (None, {"x": "?"}, ["x"], True)
    assert [r.found for r in typing(spark, "FILE\tSCHEME\tST\tx").collect()] == [False, False]
    for bad in ((), ("FILE\tSCHEME\tx",), ("FILE\tSCHEME\tST",), ("FILE\tSCHEME\tST\tx", "a.fna\tpa\t1\t1")):
        with pytest.raises(errors.ContractError):
            typing(spark, *bad).collect()


def test_tree_projection_numbers_children_before_parents(spark):
    got = reports.project_tree("((a:1,'b,c':2)x:0.5,d);")
    assert got == [(4, None, [2, 3], None, None, False), (2, 4, [0, 1], "x", 0.5, False), (0, 2, [], "a", 1.0, True), (1, 2, [], "b,c", 2.0, True), (3, 4, [], "d", None, True)]
    t = spark.createDataFrame([("t", "(a,b);"), ("u", None)], "tree_id string, newick string")
    assert rows(reports.tree_projection(t), "tree_id", "node_id", "label") == [("t", 0, "a"), ("t", 1, "b"), ("t", 2, None)]


HIT = "sample_id string, contig string, identity double, q_lo int, q_hi int, s_lo int, s_hi int, strand int"


def measured(spark, hits, seqs, n=5):
    h = spark.createDataFrame([("s", *x) for x in hits], HIT)
    c = spark.createDataFrame([("s", k, v) for k, v in seqs.items()], "sample_id string, contig string, seq string")
    return locus.measure_locus(h, c, spark.createDataFrame([("s",)], "sample_id string"), n, 80.0).collect()[0]


def test_locus_measurement(spark):
    whole = "CCATGGCCAAACTGTAACC"
    r = measured(spark, [("k", 90.0, 1, 3, 3, 11, 1), ("k", 95.0, 2, 5, 6, 17, 1), ("p", 99.0, 1, 2, 1, 6, 1), ("k", 10.0, 1, 5, 1, 2, -1)], {"k": whole, "p": "A" * 30})
    assert (r.refused, r.contig, r.protein_stop, r.own_terminator, r.frameshift, r.identity_pct, r.coverage_pct, r.at_edge) == (None, "k", 4, True, False, 90.0, 100.0, False)
    shifted = measured(spark, [("k", 90.0, 1, 5, 3, 18, 1)], {"k": "CCATGGCCAAAACTGTAACC"})
    assert shifted.net_frame == 1 and shifted.frameshift and not shifted.own_terminator
    assert measured(spark, [("k", 90.0, 1, 5, 3, 17, 1), ("k", 90.0, 1, 5, 3, 17, -1)], {"k": whole}).refused == "mixed_strands"
    assert measured(spark, [("k", 90.0, 1, 5, 3, 17, 1), ("p", 90.0, 1, 5, 3, 17, 1)], {"k": whole, "p": whole}).refused == "ambiguous_locus"
    assert measured(spark, [("k", 90.0, 2, 5, 6, 17, 1)], {"k": whole}).refused == "frame_not_anchorable"
    assert measured(spark, [("k", 90.0, 1, 5, 3, 17, 1)], {"other": whole}).refused == "contig_missing"
    assert measured(spark, [("k", 90.0, 1, 5, 3, 99, 1)], {"k": whole}).refused == "out_of_contig"
    assert measured(spark, [], {"k": whole}).refused == "no_candidate_hit"


def test_mixed_model_equals_generalised_least_squares(spark):
    rng = np.random.default_rng(4)
    n = 60
    g = rng.integers(0, 2, (n, 200)).astype(float)
    k = (g - g.mean(0)) @ (g - g.mean(0)).T / 200
    x = rng.integers(0, 2, n).astype(float)
    y = 1.5 * x + np.linalg.cholesky(k + 1e-6 * np.eye(n)) @ rng.normal(size=n) + 0.5 * rng.normal(size=n)
    name = [f"s{i:02}" for i in range(n)]
    f = spark.createDataFrame([("x", name[i]) for i in range(n) if x[i]] + [("all", s) for s in name] + [("one", "s05"), (None, "s01")], "feature string, sample_id string")
    o = spark.createDataFrame([(name[i], float(y[i])) for i in range(n)] + [("none", None)], "sample_id string, y double")
    kin = spark.createDataFrame([(name[i], name[j], float(k[i, j])) for i in range(n) for j in range(i, n)], "a string, b string, value double")
    got = {r.feature: r for r in mixed.mixed_model(f, o, kin).collect()}
    scaled = k * n / np.trace(k)
    values, vectors = mixed.rotated(scaled)
    one = np.ones((n, 1))
    h = mixed.heritability(vectors.T @ one, vectors.T @ y, values)
    v = h * scaled + (1 - h) * np.eye(n)
    w, d = np.linalg.inv(v), np.column_stack([one, x])
    beta = np.linalg.solve(d.T @ w @ d, d.T @ w @ y)
    r = y - d @ beta
    se = np.sqrt(r @ w @ r / (n - 2) * np.linalg.inv(d.T @ w @ d)[1, 1])
    assert got["x"].beta == pytest.approx(beta[1]) and got["x"].se == pytest.approx(se) and 0 < h < 1
    assert got["all"].p_value == 1.0 and got["one"].carriers == 1
    grid = [mixed.restricted_likelihood(t, vectors.T @ one, vectors.T @ y, values) for t in np.linspace(0, 0.99, 100)]
    assert mixed.restricted_likelihood(h, vectors.T @ one, vectors.T @ y, values) >= max(grid) - 1e-9
    plain = {r.feature: r for r in mixed.mixed_model(f, o, None).collect()}
    assert plain["x"].beta == pytest.approx(np.polyfit(x, y, 1)[0])
    with pytest.raises(errors.LimitError):
        mixed.mixed_model(f, o, kin, max_samples=10)


def test_linear_model_of_more_samples_than_a_square_holds(spark):
    """Unrelated samples need no square, so no number of them is refused; covariates against least squares."""
    n = 5_200
    o = spark.range(n).selectExpr("concat('s', id) AS sample_id", "CAST(id % 7 + id % 3 AS DOUBLE) AS y", "CAST(id % 11 AS DOUBLE) AS z")
    f = spark.range(n).where("id % 3 = 0").selectExpr("'third' AS feature", "concat('s', id) AS sample_id").unionByName(o.selectExpr("'all' AS feature", "sample_id"))
    got = {r.feature: r for r in mixed.mixed_model(f, o, None, ["z"]).collect()}
    i = np.arange(n)
    x, y = np.column_stack([np.ones(n), i % 11, i % 3 == 0]).astype(float), (i % 7 + i % 3).astype(float)
    beta, [rss], *_ = np.linalg.lstsq(x, y, rcond=None)
    assert got["third"].beta == pytest.approx(beta[2]) and got["third"].se == pytest.approx(np.sqrt(rss / (n - 3) * np.linalg.inv(x.T @ x)[2, 2]))
    assert got["all"].p_value == 1.0 and got["all"].beta is None and got["third"].carriers == (n + 2) // 3


def test_factored_model_equals_the_model_of_its_kinship(spark):
    """The kinship as a product of features is never formed: same results, and no bound on samples."""
    rng = np.random.default_rng(7)
    n = 50
    w = (rng.random((n, 8)) < 0.3) * rng.integers(1, 4, (n, 8)).astype(float)
    w[0] = 0  # a sample without any factor
    name = [f"s{i:02}" for i in range(n)]
    z = rng.normal(size=n)
    x = {f"g{k}": rng.integers(0, 2, n) for k in range(4)}
    y = x["g0"] + w @ rng.normal(size=8) + z + rng.normal(size=n)
    f = spark.createDataFrame([(k, name[i]) for k, v in x.items() for i in range(n) if v[i]] + [("all", s) for s in name] + [(None, "s01"), ("g0", "nowhere")], "feature string, sample_id string")
    o = spark.createDataFrame([(name[i], float(y[i]), float(z[i])) for i in range(n)] + [("none", None, 1.0)], "sample_id string, y double, z double")
    v = spark.createDataFrame([(f"k{j}", name[i], float(w[i, j])) for i in range(n) for j in range(8)] + [("k0", "elsewhere", 5.0)], "feature string, sample_id string, value double")
    inside = v.where("sample_id <> 'elsewhere'")
    for covariates in ([], ["z"]):
        want = {r.feature: r for r in mixed.mixed_model(f, o, stats.feature_kinship(inside), covariates).collect()}
        got = {r.feature: r for r in mixed.factored_model(f, o, v, covariates).collect()}
        assert set(got) == set(want) == {*x, "all"} and got["all"].p_value == 1.0
        for k in x:
            assert [got[k].carriers, *got[k][2:]] == pytest.approx([want[k].carriers, *want[k][2:]], rel=1e-5)
    with pytest.raises(errors.LimitError):
        mixed.factored_model(f, o, v, max_factors=7)


def test_mixed_model_query_takes_more_samples_than_a_square_holds(spark, tmp_path):
    from isolake.plans.further import s162_mixed_model

    n = spark.range(5_200).selectExpr("concat('s', id) AS s", "id")
    n.selectExpr("s AS Isolate", "'meropenem' AS Antibiotic", "IF(id % 7 < 3, 'R', 'S') AS AST_phenotype").write.parquet(str(tmp_path / "pilot100_manifest.parquet"))
    n.where("id % 2 = 0").selectExpr("s AS sample_id", "IF(id % 3 = 0, 'x', 'y') AS gene").write.parquet(str(tmp_path / "amr_determinants.parquet"))
    n.where("id % 5 = 0").selectExpr("'g' AS gene", "s AS sample_id", "1 AS present").write.parquet(str(tmp_path / "gene_presence_absence.parquet"))
    assert [(r.feature, r.carriers) for r in s162_mixed_model(spark, str(tmp_path)).collect()] == [("g", 1040)]


def test_pages_and_probes(spark, tmp_path):
    base = f"file://{tmp_path}"
    pages.write_pages(spark.range(500).select((F.lit(499) - F.col("id")).alias("k")), ["k"], f"{base}/pages/a")
    assert [r.k for r in pages.read_page(spark, f"{base}/pages/a", 120, 3).collect()] == [120, 121, 122]
    assert [r.k for r in pages.read_page(spark, f"{base}/pages/a", 498, 9).collect()] == [498, 499] and pages.read_page(spark, f"{base}/pages/a", 500, 5).count() == 0
    found, probes = pages.detect(spark, [("no", None), ("gone", f"{base}/x"), ("here", f"{base}/pages")], ["a"])
    assert found == f"{base}/pages" and [p.outcome for p in probes] == ["not given", "absent", "matched"]
    found, probes = pages.detect(spark, [("here", f"{base}/pages")], ["a", "b"])
    assert found is None and probes[0].outcome == "incomplete: no b"


def test_fasta_headers_may_hold_the_sign_and_bytes_are_checked(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one > two\nAC\nGT\n>three\r\nGG\r\n")
    assert rows(sequences.read_fasta(spark, str(tmp_path / "a.fa")), "header", "seq") == [("one > two", "ACGT"), ("three", "GG")]
    (tmp_path / "b.fa").write_bytes(b">x \xff\nAC\n")
    with pytest.raises(errors.ContractError, match="UTF-8"):
        sequences.read_fasta(spark, str(tmp_path / "b.fa"))


def test_streams_of_tables_and_appended_events(spark, tmp_path):
    base = f"file://{tmp_path}"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("# x\nk\tv\n1\ta\n2\n")
    (tmp_path / "in" / "b.tsv").write_text("k\tv\n\n3\t.\n")
    ev.run_to_end(tsv.stream_tsv(spark, f"{base}/in", ["k", "v"], files_per_batch=1), f"{base}/out", f"{base}/state", "append")
    assert rows(spark.read.parquet(f"{base}/out"), "k", "v") == [("1", "a"), ("2", None), ("3", None)]
    e = spark.createDataFrame([("2026-01-01T00:00:00Z", "start", "s", "a"), (None, None, "s", None)], "t string, event string, stage string, sample string")
    ev.append_events(e, f"{base}/log")
    ev.append_events(e.limit(1), f"{base}/log")
    assert ev.parse_events(spark.read.text(f"{base}/log")).where("fault IS NULL").count() == 2
