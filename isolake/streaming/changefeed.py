"""Rebuild a table from a change feed of inserts, updates and deletes (Structured Streaming).

The state of a key is three newest-wins registers, so it has constant size and neither repeated nor
out-of-order changes alter the outcome:

* ``up``  - the newest insert or update: its version and payload,
* ``ins`` - the version of the newest insert,
* ``del`` - the version of the newest delete (the tombstone).

A row exists iff its newest insert is newer than its tombstone; it then carries the payload of ``up``. (An
update newer than that insert replaced the payload; an update between the tombstone and the insert did
nothing, and the insert is newer than it.) The registers are maxima, so the state is a plain streaming
aggregate: partial aggregation before the shuffle absorbs hot keys, and the state store holds one small row a key.

Each micro-batch writes the upserts of the keys it touched under ``batch=<id>``, overwriting what a failed try
of the same batch may have left; readers take the newest batch per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isolake.session import is_file, new_dir, remove_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_USUAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
_EXTENDED = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?([Zz]|[+-]\d{2}(:?\d{2})?)?$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})[Tt](\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?([Zz]|[+-]\d{2}(?::?\d{2})?)?$"


def parse_instant(t: Column) -> Column:
    """ISO-8601 date and time (extended or basic form, any offset; none means UTC) as a timestamp, else null.

    Fractions beyond microseconds are cut off. A date without a time of day is no instant.
    """
    t = F.trim(t)
    basic = F.regexp_replace(t, _BASIC, "$1-$2-$3T$4:$5:$6.$7$8")
    basic = F.regexp_replace(F.regexp_replace(basic, r":\.", ":00."), r"\.(?=[Zz+\-]|$)", "")
    text = F.translate(F.when(t.rlike(_EXTENDED), t).when(t.rlike(_BASIC), basic), "tz,", "TZ.")
    text = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(?!:)", "$1:00")
    text = F.regexp_replace(F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"([+-]\d{2})$", "$1:00")
    text = F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(t.rlike(_USUAL), t).otherwise(text).try_cast("timestamp")


def registers(changes: DataFrame, keys: Sequence[str], payload: Sequence[str], op: str, version: Sequence[str]) -> DataFrame:
    """One row a key with its three registers. Works on batch and streaming frames alike."""
    v = [F.col(c) for c in version]
    up = F.struct(*[x.alias(f"v{i}") for i, x in enumerate(v)], *[F.col(p).alias(p) for p in payload])
    at = F.struct(*[x.alias(f"v{i}") for i, x in enumerate(v)])
    return changes.groupBy(*keys).agg(
        F.max(F.when(F.col(op).isin("insert", "update"), up)).alias("up"),
        F.max(F.when(F.col(op) == "insert", at)).alias("ins"),
        F.max(F.when(F.col(op) == "delete", at)).alias("del"),
    )


def existing(state: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """The rows that exist, from registers."""
    alive = F.col("ins").isNotNull() & (F.col("del").isNull() | (F.col("ins") > F.col("del")))
    return state.where(alive).select(*keys, *[F.col(f"up.{p}").alias(p) for p in payload])


def run_feed(
    feed: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    op: str,
    version: Sequence[str],
    output_path: str,
    checkpoint_path: str,
    state_store: str | None = ROCKSDB,
) -> None:
    """Apply all that has arrived on a streaming `feed`; call again with the same paths to apply what arrived since.

    `state_store` is the provider class of the session while the stream starts; None keeps the session's.
    """
    spark = feed.sparkSession

    def upsert(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{output_path}/batch={batch_id}")

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    if state_store:
        spark.conf.set(key, state_store)
    try:
        q = (
            registers(feed, keys, payload, op, version)
            .writeStream.outputMode("update")
            .foreachBatch(upsert)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
    finally:
        if state_store:
            spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def read_output(spark: SparkSession, output_path: str, keys: Sequence[str], payload: Sequence[str], schema: T.StructType) -> DataFrame:
    """The table as the newest batch of each key left it.

    The registers only ever grow, so the newest batch of a key is the one with the greatest registers and
    merging by maximum is the same as taking it; with that no batch number needs to be compared.
    """
    out = spark.read.schema(schema).parquet(output_path)
    merged = out.groupBy(*keys).agg(F.max("up").alias("up"), F.max("ins").alias("ins"), F.max("del").alias("del"))
    return existing(merged, keys, payload)


def status_changes(feed: DataFrame) -> DataFrame:
    """Valid changes of the status feed: stage, sample, op, version columns and payload.

    Rows with null or unreadable t, null stage or null sample are no changes. Changes of the same instant and
    seq are ordered by change_id, a null seq or change_id coming first; an op other than insert, update, delete has no effect.
    """
    return (
        feed.select(
            "stage",
            "sample",
            "op",
            F.unix_micros(parse_instant(F.col("t"))).alias("at"),
            F.coalesce("seq", F.lit(-(2**31))).alias("seq"),
            F.coalesce("change_id", F.lit(-(2**63))).alias("tie"),
            "event",
            "change_id",
        )
        .where(F.col("at").isNotNull() & F.col("stage").isNotNull() & F.col("sample").isNotNull() & F.col("op").isin("insert", "update", "delete"))
    )


STATUS_KEYS, STATUS_PAYLOAD, STATUS_VERSION = ("stage", "sample"), ("event", "change_id"), ("at", "seq", "tie")


def status_table(spark: SparkSession, path: str, max_bytes_per_trigger: int = 2 << 30, state_store: str | None = ROCKSDB) -> DataFrame:
    """Stream the status feed at `path` from its start and return the rows that exist after all changes.

    An empty feed gives an empty table.
    """
    schema = spark.read.parquet(path).select("change_id", "op", "t", "seq", "event", "stage", "sample").schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if is_file(spark, path):  # a stream's base path must be a folder
        parent, _, name = path.rstrip("/").rpartition("/")
        reader, path = reader.option("pathGlobFilter", name), parent
    feed = status_changes(reader.parquet(path))
    base = new_dir(spark, "changefeed")
    empty = registers(status_changes(spark.createDataFrame([], schema)), STATUS_KEYS, STATUS_PAYLOAD, "op", STATUS_VERSION)
    empty.limit(0).write.parquet(f"{base}/out/batch=-1")
    run_feed(feed, STATUS_KEYS, STATUS_PAYLOAD, "op", STATUS_VERSION, f"{base}/out", f"{base}/state", state_store)
    remove_dir(spark, f"{base}/state")
    return read_output(spark, f"{base}/out", STATUS_KEYS, STATUS_PAYLOAD, empty.schema).select("stage", "sample", "event", "change_id")
