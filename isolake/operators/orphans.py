"""References to records that do not exist: direct orphans, and a fixpoint cascade over the foreign-key graph.

A reference is broken if the key is not in the parent table at all (``missing``), begins to exist only after the
referring record was made (``late``), or ended at or before that moment (``deleted``). Children of orphaned records are
indirectly orphaned (``inherited``); the cascade semi-joins down the graph until a round adds nothing, so self-references
and cycles are handled. Each round works on the keys found in the round before only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isolake.operators.skew import salted_join
from isolake.session import materialise


@dataclass(frozen=True)
class Node:
    """A table of the graph. `key` names its primary key; `made_at` when a record was made (for its references);
    `begins`/`ends` the life span of its keys, where it has one."""

    df: DataFrame
    key: str
    made_at: str | None = None
    begins: str | None = None
    ends: str | None = None


@dataclass(frozen=True)
class Edge:
    """`child.column` refers to the key of `parent`."""

    child: str
    column: str
    parent: str


def ref(c: Column) -> Column:
    """A reference or key as compared: text without outer blanks."""
    return F.btrim(c.cast("string"), F.lit(" \t\r\n"))


def _keys(node: Node) -> DataFrame:
    """One row a key: a key lives from its earliest beginning to its latest end; an open end or unknown beginning is open."""
    begins = F.col(node.begins) if node.begins else F.lit(None).cast("timestamp")
    ends = F.col(node.ends) if node.ends else F.lit(None).cast("timestamp")
    return (
        node.df.select(ref(F.col(node.key)).alias("ref"), begins.alias("b"), ends.alias("e"))
        .where("ref IS NOT NULL")
        .groupBy("ref")
        .agg(F.min("b").alias("begins"), F.when(F.count("e") == F.count(F.lit(1)), F.max("e")).alias("ends"))
    )


def direct_orphans(nodes: Mapping[str, Node], edge: Edge, rows_per_task: int = 2_000_000) -> DataFrame:
    """(table_name, period, row_id, reason) of the records whose reference over `edge` is broken.

    Whole-row copies count once. A null reference is no case; a record without a moment is only ever ``missing`` and has a null period.
    """
    child, parent = nodes[edge.child], nodes[edge.parent]
    made = F.col(child.made_at) if child.made_at else F.lit(None).cast("timestamp")
    refs = child.df.select(F.col(child.key).alias("row_id"), ref(F.col(edge.column)).alias("ref"), made.alias("made_at")).where("ref IS NOT NULL")
    found = salted_join(refs, _keys(parent).withColumn("known", F.lit(True)), ["ref"], "left", rows_per_task)
    reason = (
        F.when(F.col("known").isNull(), "missing")
        .when(F.col("begins") > F.col("made_at"), "late")
        .when(F.col("ends") <= F.col("made_at"), "deleted")
    )
    return (
        found.select(F.lit(edge.child).alias("table_name"), F.date_format("made_at", "yyyy-MM").alias("period"), F.col("row_id"), reason.alias("reason"))
        .where("reason IS NOT NULL")
        .dropDuplicates()
    )


def cascade(nodes: Mapping[str, Node], edges: Sequence[Edge], rows_per_task: int = 2_000_000, keep: int = 8) -> DataFrame:
    """(table_name, period, row_id, kind, reason): every direct and inherited orphan of the graph.

    `kind` is ``direct`` (a row for each reason and period, if several references of a record break differently) or
    ``inherited`` (with the least table of an orphaned parent as reason). A record that is both is direct.

    Rounds go on until one adds nothing, however deep the graph: each adds at least one record, and no record is added twice. Every
    `keep` rounds what was found so far is written as one table, so plans stay small.
    """
    direct = None
    for e in edges:
        d = direct_orphans(nodes, e, rows_per_task).withColumn("row_id", F.col("row_id").cast("string"))
        direct = d if direct is None else direct.unionByName(d)
    direct = direct.select("table_name", "period", "row_id", F.lit("direct").alias("kind"), "reason").distinct()
    fresh = materialise(direct, "orphans")
    parts = [fresh]
    children = {e.parent for e in edges}
    while True:
        found = None
        for e in edges:
            child = nodes[e.child]
            made = F.col(child.made_at) if child.made_at else F.lit(None).cast("timestamp")
            refs = child.df.select(F.col(child.key).cast("string").alias("row_id"), ref(F.col(e.column)).alias("ref"), made.alias("made_at")).where("ref IS NOT NULL")
            gone = fresh.where(F.col("table_name") == e.parent).select(ref(F.col("row_id")).alias("ref")).distinct()
            hit = salted_join(refs, gone, ["ref"], "left_semi", rows_per_task).select(
                F.lit(e.child).alias("table_name"), F.date_format("made_at", "yyyy-MM").alias("period"), "row_id", F.lit("inherited").alias("kind"), F.lit(e.parent).alias("reason")
            )
            found = hit if found is None else found.unionByName(hit)
        found = found.groupBy("table_name", "row_id", "kind").agg(F.min("period").alias("period"), F.min("reason").alias("reason")).select(*direct.columns)
        seen = reduce(DataFrame.unionByName, parts).select("table_name", "row_id")
        fresh = materialise(found.join(seen, ["table_name", "row_id"], "left_anti").select(*direct.columns), "orphans")
        tables = {r[0] for r in fresh.select("table_name").distinct().collect()}  # at most as many as nodes
        if not tables:
            return reduce(DataFrame.unionByName, parts)
        parts.append(fresh)
        if not tables & children:  # nothing refers to what was found
            return reduce(DataFrame.unionByName, parts)
        if len(parts) > keep:
            parts = [materialise(reduce(DataFrame.unionByName, parts), "orphans")]
