"""Event logs as streams: JSON lines in, validation, per-stage fold, badges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "t string, event string, stage string, sample string"
EVENTS = ("start", "done", "fail")


def read_event_lines(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream of raw lines of a folder of JSON-lines files."""
    return spark.readStream.option("maxFilesPerTrigger", str(files_per_trigger)).text(path)


def parse_events(lines: DataFrame) -> DataFrame:
    """Every line with its event fields and `fault`: null, not_json, wrong_fields (not exactly the four) or unknown_event.

    Blank lines are left out; works on batches and streams.
    """
    raw = F.trim("value")
    e = F.from_json("value", EVENT_SCHEMA)
    keys = F.json_object_keys("value")
    fault = F.when(keys.isNull(), "not_json").when(F.array_sort(keys) != F.array(*[F.lit(k) for k in sorted(("t", "event", "stage", "sample"))]), "wrong_fields").when(~F.coalesce(e["event"].isin(*EVENTS), F.lit(False)), "unknown_event")
    return lines.where(raw != "").select("value", e["t"].alias("t"), e["event"].alias("event"), e["stage"].alias("stage"), e["sample"].alias("sample"), fault.alias("fault"))


def stage_fold(events: DataFrame) -> DataFrame:
    """(stage, started, done, failed, events) over valid events; repeats count again. A streaming aggregate in update or complete mode."""
    v = events.where("fault IS NULL AND stage IS NOT NULL")
    n = lambda e: F.sum((F.col("event") == e).cast("long"))
    return v.groupBy("stage").agg(n("start").alias("started"), n("done").alias("done"), n("fail").alias("failed"), F.count(F.lit(1)).alias("events"))


def badge(started: Column, done: Column, failed: Column) -> Column:
    """failed before running before completed; pending if nothing has begun."""
    return F.when(failed > 0, "failed").when(started > done + failed, "running").when(done > 0, "completed").otherwise("pending")


def run_to_end(stream: DataFrame, output: str, checkpoint: str, mode: str = "complete") -> None:
    """Run a streaming frame over all that is there; each batch replaces `output/batch=<id>`."""

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_batch(spark: SparkSession, output: str) -> DataFrame:
    """What the newest batch of a complete-mode run holds."""
    out = spark.read.parquet(output)
    return out.where(F.col("batch") == out.agg(F.max("batch")).scalar()).drop("batch")


def since(events: DataFrame, cursor: int, ring: int = 500) -> DataFrame:
    """(seq, ...) of a numbered log after a cursor, at most the newest `ring`, with `gap`: how many after the cursor are no longer held."""
    newest = events.agg(F.max("seq")).scalar()
    oldest = F.greatest(newest - ring + 1, F.lit(0))
    return events.where((F.col("seq") > cursor) & (F.col("seq") >= oldest)).withColumn("gap", F.greatest(oldest - cursor - 1, F.lit(0)))


def windowed_counts(events: DataFrame, time: str, width: str, delay: str, *keys: str) -> DataFrame:
    """Counts in tumbling windows; events later than the delay behind the newest are dropped by a stream.."""
    return events.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")


def append_events(events: DataFrame, path: str) -> None:
    """Append events (t, event, stage, sample) to a log as JSON lines; a failed append leaves nothing that readers see."""
    line = F.to_json(F.struct("t", "event", "stage", "sample"), {"ignoreNullFields": "false"})
    events.select(line.alias("value")).write.mode("append").text(path)
