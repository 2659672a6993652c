import datetime as dt

from pyspark.sql import functions as F

from isolake.operators import orphans as O
from isolake.operators.skew import salted_join
from tests.conftest import rows

DAY = lambda d: dt.datetime(2026, 1, 1) + dt.timedelta(days=d)


def graph(spark, parents, children, grand=()):
    p = spark.createDataFrame(parents, "k string, b timestamp, e timestamp, reason string")
    c = spark.createDataFrame(children, "id long, ref string, made timestamp, period string, known boolean")
    g = spark.createDataFrame(list(grand), "id long, ref string, made timestamp")
    nodes = {"p": O.Node(p, "k", None, "b", "e"), "c": O.Node(c, "id", "made"), "g": O.Node(g, "id", "made")}
    return nodes, [O.Edge("c", "ref", "p"), O.Edge("g", "ref", "c")]


def test_reasons(spark):
    nodes, edges = graph(
        spark,
        [("A", DAY(0), None, "x"), ("A", DAY(0), None, "x"), (" B ", DAY(10), DAY(20), None), ("C", None, None, None), (None, DAY(0), None, None)],
        [
            (1, "A", DAY(0), "", True), (2, " A\n", DAY(5), "", True), (3, "B", DAY(9), "", True), (4, "B", DAY(10), "", True), (5, "B", DAY(20), "", True), (6, "b", DAY(5), "", True),
            (7, None, DAY(5), "", True), (8, "Z", None, "", True), (8, "Z", None, "", True), (9, "B", None, "", True), (10, "C", DAY(1), "", True), (11, "Z", DAY(40), "", True),
        ],
    )
    assert rows(O.direct_orphans(nodes, edges[0])) == [
        ("c", "2026-01", 3, "late"), ("c", "2026-01", 5, "deleted"), ("c", "2026-01", 6, "missing"), ("c", "2026-02", 11, "missing"), ("c", None, 8, "missing"),
    ]


def test_cascade_reports_direct_and_inherited(spark):
    nodes, edges = graph(spark, [("A", DAY(0), None, "")], [(1, "A", DAY(1), "", True), (2, "Z", DAY(1), "", True)], [(10, "1", DAY(2)), (11, "2", DAY(2)), (12, "7", DAY(2)), (13, None, DAY(2))])
    got = rows(O.cascade(nodes, edges), "table_name", "row_id", "kind", "reason")
    assert got == [("c", "2", "direct", "missing"), ("g", "11", "inherited", "c"), ("g", "12", "direct", "missing")]


def test_cascade_ends_on_cycles(spark):
    t = spark.createDataFrame([(1, 9), (2, 1), (3, 2), (4, 5), (5, 4)], "id long, up long")
    got = rows(O.cascade({"t": O.Node(t, "id")}, [O.Edge("t", "up", "t")]), "row_id", "kind")
    assert got == [("1", "direct"), ("2", "inherited"), ("3", "inherited")]


def test_a_deep_graph_is_followed_to_its_end(spark):
    """Six tables in a row, and a table that refers to itself over more rounds than are kept apart."""
    chain = {f"t{k}": O.Node(spark.createDataFrame([(k * 10 + j, str((k - 1) * 10 + j) if k else ("gone" if j == 1 else None)) for j in (1, 2)], "id long, up string"), "id") for k in range(6)}
    edges = [O.Edge(f"t{k}", "up", f"t{k - 1}" if k else "root") for k in range(6)]
    chain["root"] = O.Node(spark.createDataFrame([], "id string"), "id")
    got = rows(O.cascade(chain, edges, keep=2), "table_name", "row_id", "kind", "reason")
    assert got == [("t0", "1", "direct", "missing")] + [(f"t{k}", f"{k}1", "inherited", f"t{k - 1}") for k in range(1, 6)]


def test_a_chain_longer_than_fifty_records(spark):
    t = spark.createDataFrame([(k, k - 1) for k in range(1, 55)], "id long, up long").coalesce(1)
    got = O.cascade({"t": O.Node(t, "id")}, [O.Edge("t", "up", "t")])
    assert got.groupBy("kind").count().orderBy("kind").collect() == [("direct", 1), ("inherited", 53)]


def test_different_faults_of_one_record_are_all_reported(spark):
    nodes, edges = graph(spark, [("A", DAY(5), None, "")], [(1, "A", DAY(1), "", True), (1, "Z", DAY(40), "", True)])
    assert rows(O.cascade(nodes, edges)) == [("c", "2026-01", "1", "direct", "late"), ("c", "2026-02", "1", "direct", "missing")]


def test_empty_tables(spark):
    nodes, edges = graph(spark, [], [], [])
    assert O.direct_orphans(nodes, edges[0]).count() == 0
    assert O.cascade(nodes, edges).count() == 0


def test_a_hot_key_is_spread_and_the_join_stays_exact(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("3", 3), (None, 4)], "k string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = left.join(right, "k", how)
        got = salted_join(left, right, ["k"], how, rows_per_task=100)
        assert rows(got.select(*want.columns)) == rows(want)
    parts = salted_join(left, right, ["k"], "left", rows_per_task=100)
    assert parts.count() == left.join(right, "k", "left").count()
