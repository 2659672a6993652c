import pytest
from pyspark.sql import functions as F

from isolake import errors
from isolake.operators import downstream, spans
from isolake.sources import annotation, sinks
from isolake.sources.growing import GrowingLines, read_from
from isolake.streaming.events import latest_batch, run_to_end
from tests.conftest import rows


def test_growing_file(spark, tmp_path):
    p = tmp_path / "log"
    assert read_from(str(p), 0, 10) == ([], 0)
    p.write_bytes(b"one\ntwo\r\npart")
    lines, at = read_from(str(p), 0, 10)
    assert lines == ["one", "two"] and at == 9
    p.write_bytes(b"one\ntwo\r\npartial\n")
    assert read_from(str(p), at, 10) == (["partial"], 17)
    assert read_from(str(p), 0, 1) == (["one"], 4)
    p.write_bytes(b"new\n")
    assert read_from(str(p), 17, 10) == (["new"], 4)
    spark.dataSource.register(GrowingLines)
    p.write_bytes(b"a\nb\na\nunfinished")
    run = lambda: run_to_end(spark.readStream.format("growing_lines").option("path", str(p)).load().groupBy("value").count(), str(tmp_path / "out"), str(tmp_path / "state"))
    run()
    assert rows(latest_batch(spark, str(tmp_path / "out"))) == [("a", 2), ("b", 1)]


def test_commented_table_and_reads_with_reasons(spark, tmp_path):
    p = tmp_path / "t"
    p.write_text("# v1\n#a,b\n1,x\n2,.\n")
    assert rows(annotation.read_commented_table(spark, str(p))) == [("1", "x"), ("2", None)]
    p.write_text("a\tb\n1\tx\n")
    assert rows(annotation.read_commented_table(spark, str(p))) == [("1", "x")]
    assert annotation.read_with_reason(spark, str(tmp_path / "no")).reason == "absent"
    assert annotation.association_table(spark, str(p), ["b"]).count() == 1
    with pytest.raises(errors.ContractError, match="missing"):
        annotation.association_table(spark, str(p), ["z"])
    bad = spark.createDataFrame([("core", "1"), ("total", "3")], "metric string, value string")
    with pytest.raises(errors.ContractError):
        annotation.checked_summary(bad, "metric", "value", "total")
    m = annotation.long_matrix(spark.createDataFrame([("s", "1", "x"), ("t", "0", None)], "sample_id string, f string, g string"))
    assert rows(m.where("not_binary"), "sample_id", "feature") == [("s", "g"), ("t", "g")]


def test_standardise_fills_what_is_missing(spark):
    d = annotation.standardise(spark.createDataFrame([("s", "x", "12"), ("t", "y", "zz")], "sample_id string, g string, start string"), {"gene_name": "g"}, "demo")
    assert rows(d, "sample_id", "gene_name", "start", "product") == [("s", "x", 12, None), ("t", "y", None, None)]


def test_spans(spark):
    c = spark.createDataFrame([("g", 10, 1), ("g", 20, 1), ("g", 30, 1), ("g", 90, 2), ("h", 5, 1), ("h", 500, 2), ("i", 1, 3)], "g string, pos long, net long")
    assert rows(spans.compensating(c, ["g"], 50), "g", "first_pos", "last_pos", "n") == [("g", 10, 30, 3)]
    assert rows(spans.compensating(c, ["g"], 70), "g", "first_pos", "last_pos") == [("g", 10, 30)]
    assert spans.depths([("a", "b"), ("b", "c"), ("a", "c")]) == {"a": 0, "b": 1, "c": 2}
    with pytest.raises(errors.ContractError):
        spans.depths([("a", "b"), ("b", "a")])
    h = spark.createDataFrame([("k", "+", 1, 60), ("k", "+", 50, 100), ("k", "-", 1, 99), ("m", "+", 1, 10)], "k string, strand string, s long, e long")
    assert rows(spans.cluster_verdict(h, ["strand"], "k", "s", "e", 100), "k", "clusters", "full", "verdict") == [("k", 2, 2, "duplicated"), ("m", 1, 0, "fragment")]


def test_control_gate_and_anchored_pairs(spark):
    r = spark.createDataFrame([("amr__x", 0.01), ("gene__y", 0.5)], "feature string, adjusted_p_value double")
    k = spark.createDataFrame([("one", "x"), ("two", "y"), ("two", "x")], "control string, member string")
    assert downstream.control_gate(r, k).count() == 2
    with pytest.raises(errors.ContractError, match="three"):
        downstream.control_gate(r, k.union(spark.createDataFrame([("three", "zz")], "control string, member string")))
    with pytest.raises(errors.LimitError):
        downstream.anchored_pairs(r, r.limit(1), 0)


def test_sinks(spark, tmp_path):
    f = spark.createDataFrame([("s1", "x", 1), ("s2", "y", 1)], "sample_id string, feature string, value int")
    sinks.write_feature_rows(f, f.select("sample_id"), str(tmp_path / "r"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "r")).collect()] == ["feature\ts1\ts2", "x\t1\t0", "y\t0\t1"]
    with pytest.raises(errors.MismatchError):
        sinks.write_layers({"a": f.select("sample_id").limit(1)}, f.select("sample_id"), str(tmp_path / "l"))
    assert sinks.provenance({"t": f}) == sinks.provenance({"t": f.orderBy(F.desc("feature"))})
    assert sinks.markdown(f.select("feature"), ["feature"], 1).splitlines()[-1] == "1 more rows"


def test_a_header_after_a_long_banner(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("".join(f"# line {k}\n" for k in range(300)) + "#id\tname\n1\tx\n2\ty\n# later, with a\ttab\n")
    assert rows(annotation.read_commented_table(spark, str(tmp_path / "t.tsv"))) == [("1", "x"), ("2", "y")]


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from types import SimpleNamespace

    from isolake import session

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(errors.ContractError, match="checkpoint"):
        session.shared_root(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=context))
