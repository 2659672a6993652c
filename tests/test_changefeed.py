import random

import pytest
from pyspark.sql import functions as F

from isolake.streaming import changefeed as cf
from tests.conftest import rows

SCHEMA = "line_no long, change_id long, op string, t string, seq int, event string, stage string, sample string"


def fold(changes):
    """Apply changes one by one in order of (instant, seq, change_id)."""
    table = {}
    seen = {}
    for at, seq, cid, op, event, key in changes:
        seen[cid] = (at, seq, cid, op, event, key)
    for at, seq, cid, op, event, key in sorted(seen.values(), key=lambda c: c[:3]):
        if op == "insert" or (op == "update" and key in table):
            table[key] = (event, cid)
        elif op == "delete":
            table.pop(key, None)
    return sorted((*k, *v) for k, v in table.items())


def written(at, form):
    s, ms = divmod(at, 1000)
    h, m, sec = s // 3600, s // 60 % 60, s % 60
    return [f"2026-01-02T{h:02}:{m:02}:{sec:02}.{ms:03}Z", f"2026-01-02 {h:02}:{m:02}:{sec:02},{ms:03}+00:00", f"20260102T{h:02}{m:02}{sec:02}.{ms:03}Z", f"2026-01-02T{h + 2:02}:{m:02}:{sec:02}.{ms:03}+0200"][form]


def random_feed(seed, n=400):
    rnd = random.Random(seed)
    changes, lines = [], []
    for cid in range(n):
        at, seq = rnd.randrange(20) * 1000 + 500, rnd.randrange(3)
        key = (rnd.choice(["a", "b"]), rnd.choice(["all", "all", "s1", "s2", "s3"]))
        op = rnd.choice(["insert", "update", "update", "delete"])
        event = rnd.choice(["start", "done", None])
        changes.append((at, seq, cid, op, event, key))
        for _ in range(rnd.choice([1, 1, 2])):
            lines.append((cid, op, written(at, rnd.randrange(4)), seq, event, *key))
    lines += [(9001, "insert", "pending", 0, "start", "a", "s9"), (9002, "insert", None, 0, "start", "a", "s9"), (9003, "insert", written(5, 0), 0, "start", None, "s9"), (9004, "insert", written(5, 0), 0, "start", "a", None), (9005, "upsert", written(5, 0), 0, "start", "a", "s9"), (9006, None, written(5, 0), 0, "x", "a", "s9")]
    rnd.shuffle(lines)
    return [(i, *x) for i, x in enumerate(lines)], fold(changes)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_and_repeats_give_the_folded_table(spark, tmp_path, seed):
    lines, want = random_feed(seed)
    path = str(tmp_path / "feed.parquet")
    spark.createDataFrame(lines, SCHEMA).withColumn("up", F.lit(1)).repartition(5).write.parquet(path)
    store = cf.ROCKSDB if seed == 1 else None
    assert rows(cf.status_table(spark, path, max_bytes_per_trigger=4000, state_store=store)) == sorted(want, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_later_runs_apply_only_what_arrived_and_output_is_idempotent(spark, tmp_path):
    lines, want = random_feed(7)
    path, out, state = (str(tmp_path / x) for x in ("feed", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for part in (lines[:200], lines[200:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        feed = cf.status_changes(spark.readStream.schema(schema).parquet(path))
        cf.run_feed(feed, cf.STATUS_KEYS, cf.STATUS_PAYLOAD, "op", cf.STATUS_VERSION, out, state, None)
    empty = cf.registers(cf.status_changes(spark.createDataFrame([], schema)), cf.STATUS_KEYS, cf.STATUS_PAYLOAD, "op", cf.STATUS_VERSION)
    read = lambda: rows(cf.read_output(spark, out, cf.STATUS_KEYS, cf.STATUS_PAYLOAD, empty.schema), "stage", "sample", "event", "change_id")
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    assert read() == sorted(want, key=key)
    # a batch written again changes nothing
    spark.read.schema(empty.schema).parquet(f"{out}/batch=0").write.parquet(f"{out}/batch=7")
    assert read() == sorted(want, key=key)


def test_empty_feed(spark, tmp_path):
    path = str(tmp_path / "e.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert cf.status_table(spark, path, state_store=None).count() == 0


def test_instants(spark):
    texts = ["2026-01-01T00:00:00Z", "2026-01-01T02:00:00+02:00", "20260101T000000Z", "2026-01-01 00:00:00.000Z", "2025-12-31T18:30:00.000-05:30", "2026-01-01T00:00Z", "2026-01-01T00:00:00"]
    bad = ["pending", "2026-13-01T00:00:00Z", "2026-01-01", "", "12:00", "2026-01-01T25:00:00Z", "20260101", None]
    df = spark.createDataFrame([(t,) for t in texts + bad], "t string").select(F.unix_micros(cf.parse_instant(F.col("t"))))
    got = [r[0] for r in df.collect()]
    assert got[: len(texts)] == [1767225600000000] * len(texts)
    assert got[len(texts) :] == [None] * len(bad)
