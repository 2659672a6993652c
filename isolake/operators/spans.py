"""Operators over ordered alignment hits of one locus: frame changes, clusters, and longest paths of small graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isolake.errors import ContractError
from isolake.operators.joins import merged_spans


def indels(hits: DataFrame, group: Sequence[str], q_start: str = "q_start", q_end: str = "q_end", r_start: str = "r_start", r_end: str = "r_end") -> DataFrame:
    """(group..., pos, net): between consecutive hits of a group, the difference of the reference and query gaps, where not 0."""
    w = Window.partitionBy(*group).orderBy(q_start, q_end, r_start)
    lag = lambda c: F.lag(c).over(w)
    g = hits.select(*group, F.col(q_start).alias("pos"), ((F.col(q_start) - lag(q_end)) - (F.col(r_start) - lag(r_end))).alias("net"))
    return g.where("net IS NOT NULL AND net <> 0")


def compensating(changes: DataFrame, group: Sequence[str], window: int, pos: str = "pos", net: str = "net") -> DataFrame:
    """(group..., first_pos, last_pos, n): per group the first run of at least two frame changes within `window` whose sum is divisible by three.

    Runs start at each change in order; per start the shortest run counts. Changes at one position add up.
    """
    w = Window.partitionBy(*group).orderBy(pos).rangeBetween(0, window)
    run = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(net).alias("d"))).over(w))
    c = changes.groupBy(*group, pos).agg(F.sum(net).alias(net)).where(F.col(net) % 3 != 0).withColumn("__run", run)
    near = F.col("__run")
    sums = F.transform(near, lambda x, i: F.aggregate(F.slice(near, 1, i + 1), F.lit(0).cast("long"), lambda s, y: s + y["d"]))
    last = F.array_min(F.filter(F.transform(sums, lambda s, i: F.when((i >= 1) & (s % 3 == 0), i)), lambda i: i.isNotNull()))
    f = c.select(*group, F.col(pos).alias("first_pos"), F.get(near, last)["p"].alias("last_pos"), (last + 1).alias("n")).where("n IS NOT NULL")
    v = Window.partitionBy(*group).orderBy("first_pos", "last_pos")
    return f.withColumn("__rn", F.row_number().over(v)).where("__rn = 1").drop("__rn")


def cluster_verdict(hits: DataFrame, group: Sequence[str], key: str, start: str, end: str, length: int, complete: float = 0.95) -> DataFrame:
    """(key, clusters, full, verdict): hits of a key united per group (contig and strand); absent without hits, intact with one full cluster, duplicated with more, else fragment."""
    merged = merged_spans(hits, [key, *group], start, end)
    per = merged.groupBy(key, *group).agg(F.sum(F.col(end) - F.col(start) + 1).alias("__n"))
    g = per.groupBy(key).agg(F.count(F.lit(1)).alias("clusters"), F.count_if(F.col("__n") >= complete * length).alias("full"))
    return g.withColumn("verdict", F.when(F.col("full") == 1, "intact").when(F.col("full") > 1, "duplicated").otherwise("fragment"))


def depths(edges: list[tuple[str, str]]) -> dict[str, int]:
    """Longest path from a root to each node of a small acyclic graph of (before, after); a cycle is refused."""
    nodes = {n for e in edges for n in e}
    waiting = {n: sum(b == n for _, b in edges) for n in nodes}
    out, ready = {n: 0 for n in nodes}, sorted(n for n in nodes if not waiting[n])
    done = 0
    while ready:
        n = ready.pop(0)
        done += 1
        for a, b in edges:
            if a == n:
                out[b] = max(out[b], out[n] + 1)
                waiting[b] -= 1
                if not waiting[b]:
                    ready.append(b)
    if done < len(nodes):
        raise ContractError("the graph has a cycle")
    return out
