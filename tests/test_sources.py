import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from isolake import contracts, errors
from isolake.sources import reports, sequences, tsv, variants
from isolake.streaming import events as ev
from tests.conftest import rows


def put(tmp_path, text, name="t.tsv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_strict_tsv(spark, tmp_path):
    d = tsv.read_tsv(spark, put(tmp_path, "# banner\na\tb\n\n1\t NA \n2\n# note\n3\tx\n"), required=["a"], unique=["a"])
    assert rows(d) == [("1", None), ("2", None), ("3", "x")]
    for text, match in (("", "empty"), ("a\ta\n1\t2\n", "repeated columns"), ("a\tb\n", "without rows"), ("a\n1\t2\n", "a row has 2"), ("b\n1\n", "missing columns"), ("a\n1\n1\n", "repeated keys")):
        with pytest.raises(errors.ContractError, match=match):
            tsv.read_tsv(spark, put(tmp_path, text), required=["a"], unique=["a"])
    with pytest.raises(errors.DuplicateKeyError):
        tsv.read_tsv(spark, put(tmp_path, "a\tb\n1\tx\n2\t.\n"), unique_together=["a", "b"])


def test_fasta(spark, tmp_path):
    d = sequences.read_fasta(spark, put(tmp_path, ">a one\nacg\nT n\n\n>b\n\n>c\nGG\r\n"))
    assert rows(d, "header", "seq") == [("a one", "ACGTN"), ("b", ""), ("c", "GG")]
    for text in ("", "ACG\n>a\nA\n", ">\nA\n>b\nC"):
        with pytest.raises((errors.ContractError, PySparkException)):
            sequences.read_fasta(spark, put(tmp_path, text)).collect()
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "GCX_0001.2_x.fna").write_text(">a\nACGTACGT\n")
    (folder / "empty.fna").write_text("")
    (folder / "z.fna").write_bytes(b"\x1f\x8b\x08xx")
    (folder / "no.fna").write_text("hello")
    v = {r.file.rsplit("/", 1)[1]: r.verdict for r in sequences.file_integrity(spark, str(folder), 5).collect()}
    assert v == {"GCX_0001.2_x.fna": "ok", "empty.fna": "zero_byte_file", "z.fna": "gzip", "no.fna": "not_fasta"}
    assert [r.accession for r in sequences.discover(spark, str(folder)).collect()] == ["GCX_0001.2"]
    assert contracts.distinct_siblings(spark, str(folder), 3).first().ok


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_gff_and_vcf(spark):
    g = variants.parse_gff(lines(spark, "##gff", "c1\ts\tCDS\t1\t9\t.\t+\t0\tID=x;gene=a%2Cb;gene=c%3Dd", "c1\ts\tregion\t1\t9\t.\t+\t0\tID=r", "short\tline"))
    assert rows(g, "contig", "start", "name") == [("c1", 1, "c=d")]
    gene = lines(spark, "c1\ts\tgene\t5\t9\t.\t-\t.\tlocus_tag=T1")
    assert rows(variants.gene_intervals(gene, ["T1"])) == [("T1", "c1", 5, 9, "-")]
    with pytest.raises(errors.ContractError, match="T2"):
        variants.gene_intervals(gene, ["T1", "T2"])
    v = variants.parse_vcf(lines(spark, "##x", "#CHROM", "c\t5\t.\tA\tT,G\t9\tPASS\tAC=1;AC=2;DP4=1,2,3,4\tGT:X\t1/2:7", "c\t6\t.\tA\t.\t.\t.\t.\tGT\t0/0"))
    assert rows(v, "pos", "alt", "qual", "GT", "AC", "DP4") == [(5, "G", 9.0, "1/2", "2", "1,2,3,4"), (5, "T", 9.0, "1/2", "2", "1,2,3,4")]
    with pytest.raises(PySparkException, match="no position"):
        variants.parse_vcf(lines(spark, "c\tx\t.\tA\tT\t9\tPASS\t.\tGT\t1")).collect()


def test_gene_intervals_of_many_tags(spark, tmp_path):
    from isolake.plans.more import s006_gene_intervals

    n = 100_050
    spark.range(n).select(F.col("id").alias("p_partkey"), F.lit("PROMO").alias("p_type"), F.lit("b").alias("p_brand"), F.lit(3).alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    assert s006_gene_intervals(spark, str(tmp_path)).select("locus_tag").distinct().count() == n
    gene = lines(spark, "c1\tx\tgene\t5\t9\t.\t-\t.\tID=a;locus_tag=T1")
    tags = spark.createDataFrame([("T1",), ("T2",)], "locus_tag string")
    assert rows(variants.gene_intervals(gene, tags.where("locus_tag = 'T1'"))) == [("T1", "c1", 5, 9, "-")]
    with pytest.raises(errors.ContractError, match="T2"):
        variants.gene_intervals(gene, tags)


def test_tables_of_tools(spark):
    t = lines(spark, "q\ts\t99.5\t10\t80\t1\t9\textra", "q\ts\tbad\t10\t80\t1\t9", "q\ts", "")
    assert variants.parse_table(t, variants.HIT_COLUMNS).count() == 1
    with pytest.raises(PySparkException, match="bad row"):
        variants.parse_table(t, variants.HIT_COLUMNS, strict=True).collect()
    h = variants.database_headers(lines(spark, ">VF01(gb|X) (lasB) elastase [LasB (VF0091) - Exotoxin (VFC0235)]", "ACGT"))
    assert rows(h) == [("VF01", "lasB", "Exotoxin")]
    with pytest.raises(errors.ContractError):
        reports.determinant_rows(t)
    ty = spark.createDataFrame([("a:1;b:2;c:3;d:4;e:5", "7"), ("a:1;a:-", "7"), (None, "7"), ("a:1;b:2;c:3;d:4;e:5", "-")], "alleles string, ST string")
    assert [r.status for r in reports.typing_rows(ty).collect()] == ["complete", "no_call", "no_call", "partial"]


def test_database_headers_keep_brackets_of_the_accession(spark):
    h = variants.database_headers(lines(spark, ">aac(6')-Qg1 (f1) product [X (V1) - enzyme (V2)]", ">abc(3) (f1) product [X (V1) - efflux (V2)]", ">VF01(gb|X) (lasB) elastase [LasB (VF0091) - Exotoxin (VFC0235)]"))
    assert rows(h) == [("VF01", "lasB", "Exotoxin"), ("aac(6')-Qg1", "f1", "enzyme"), ("abc(3)", "f1", "efflux")]


def test_database_headers_query_lists_every_gene(spark, tmp_path):
    from isolake.plans.more import s020_database_headers

    calls = spark.createDataFrame([("s1", "aac(6')-Qg1", "enzyme"), ("s1", "mexH4", "efflux"), ("s1", None, "efflux")], "sample_id string, gene string, mechanism string")
    calls.write.parquet(str(tmp_path / "amr_determinants.parquet"))
    assert rows(s020_database_headers(spark, str(tmp_path)), "accession", "category") == [("aac(6')-Qg1", "enzyme"), ("mexH4", "efflux")]


def test_free_text(spark):
    d = spark.createDataFrame([("1", "Mero=R, mero=r; coli=S,coli=R,x=??"), ("2", None)], "k string, t string")
    assert rows(reports.antibiogram(d, "k", "t")) == [("1", "coli", None, "ambiguous"), ("1", "mero", "R", "called"), ("1", "x", None, "invalid")]
    g = spark.createDataFrame([("1", "gyrA_T83I=POINT,mexR:W33*=ODD,plain")], "k string, t string")
    assert rows(reports.genotypes(g, "k", "t", ["POINT"])) == [("1", "gyrA", "T83I", "POINT", True), ("1", "mexR", "W33*", "ODD", False), ("1", "plain", None, None, True)]


def test_newick(spark):
    t = spark.createDataFrame([("t1", "((a:1,'b c''s':2)x:0.5,c[note]:1e-1)root;"), ("t2", None)], "tree_id string, newick string")
    n = {r.label: r for r in reports.trees(t).collect()}
    assert n["b c's"].length == 2.0 and n["a"].is_tip and not n["x"].is_tip and n["x"].parent == n["root"].node and n["c"].length == 0.1
    for bad in ("(a,b)", "(a,b;", "a,b);", "(a:x,b);"):
        with pytest.raises(errors.ContractError):
            reports.parse_newick(bad)
    deep = "(" * 5000 + "a" + ")" * 5000 + ";"
    assert len(reports.parse_newick(deep)) == 5001


def test_genotypes_of_json_arrays(spark, tmp_path):
    from isolake.plans.io import s031_genotypes

    m = spark.createDataFrame([("1", '["gyrA_T83I=POINT", "aac(4\')-Kc1; frag|ment=PARTIAL", null, "plain"]'), ("2", "mexR:W33*=HMM,x"), ("3", " . ")], "Pilot_ID string, AMR_genotypes string")
    m.write.parquet(str(tmp_path / "pilot100_manifest.parquet"))
    assert rows(s031_genotypes(spark, str(tmp_path)), "Pilot_ID", "gene", "variant", "state") == [("1", "aac(4')-Kc1; frag|ment", None, "PARTIAL"), ("1", "gyrA", "T83I", "POINT"), ("1", "plain", None, None), ("2", "mexR", "W33*", "HMM"), ("2", "x", None, None)]


def test_wide_presence(spark):
    w = spark.createDataFrame([("g", "1", "0", " ", None)], "gene string, a string, b string, c string, d string")
    assert rows(reports.wide_presence(w, "gene", ["a", "b", "c", "d"])) == [("g", "a")]


def test_event_stream_equals_its_batch_fold(spark, tmp_path):
    ok = [{"t": "x", "event": e, "stage": s, "sample": "1"} for s, e in (("a", "start"), ("a", "done"), ("b", "start"), ("b", "fail"), ("c", "start"))]
    odd = ["", "not json", json.dumps({"t": 1, "event": "start"}), json.dumps({"t": "x", "event": "boom", "stage": "a", "sample": "1"}), "[1]"]
    log = tmp_path / "log"
    log.mkdir()
    for k in range(3):
        (log / f"{k}.jsonl").write_text("\n".join([*map(json.dumps, ok), *odd]) + "\n")
    faults = {r.fault for r in ev.parse_events(spark.read.text(str(log))).collect()}
    assert faults == {None, "not_json", "wrong_fields", "unknown_event"}
    ev.run_to_end(ev.stage_fold(ev.parse_events(ev.read_event_lines(spark, str(log), 1))), str(tmp_path / "out"), str(tmp_path / "state"))
    got = ev.latest_batch(spark, str(tmp_path / "out"))
    assert rows(got) == rows(ev.stage_fold(ev.parse_events(spark.read.text(str(log)))))
    assert rows(got.select("stage", ev.badge(F.col("started"), F.col("done"), F.col("failed")))) == [("a", "completed"), ("b", "failed"), ("c", "running")]


def test_contracts(spark):
    d = spark.createDataFrame([("s1", "1", "x"), ("s2", "y", ".")], "sample_id string, n string, v string")
    c = contracts.Contract(columns=("sample_id", "n", "v"), min_rows=2, filled=("v",), key="sample_id", samples=2)
    assert contracts.enforce(d, c) is d
    bad = contracts.Contract(columns=("sample_id", "n"), min_rows=3, filled=("v",), key="sample_id", samples=3, numeric=("n",), varied=("v",))
    with pytest.raises(errors.ContractError) as e:
        contracts.enforce(d, bad, "t")
    assert all(w in str(e.value) for w in ("columns", "min_rows", "samples", "numeric n"))
