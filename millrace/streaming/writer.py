"""Incremental writers. Each is safe to run again: the row written is the commit point."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import run_id
from millrace.operators import windows
from millrace.plans.entries import commit_rows, problems
from millrace.sources.store import BucketStore


def object_events(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One record per object version: repeats of an event within the watermark are dropped."""
    named = stream.withColumn("run_id", run_id(F.col("event_time"), F.col("key"), F.col("version")))
    return named.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["run_id"])


def confirm_stream(spark: SparkSession, requests: DataFrame, checks: dict[str, str], path: str, checkpoint: str, buckets: int = 64):
    """Requests to accepted rows below ``path``/rows and refusals with every reason below ``path``/refused.

    Runs over what is there and stops. Rows lie in buckets of their id, so a batch reads only the
    buckets it may repeat. A batch that is replayed finds its rows committed and adds none, and
    writes its refusals over those of its first run.
    """
    bucket = F.pmod(F.xxhash64("confirmation_id"), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = problems(batch, checks).withColumn("bucket", bucket)
        hit = [r.bucket for r in checked.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        try:
            committed = spark.read.parquet(f"{path}/rows").where(F.col("bucket").isin(hit))
        except AnalysisException:  # nothing is committed yet
            committed = None
        commit_rows(checked, committed).write.mode("append").partitionBy("bucket").parquet(f"{path}/rows")
        checked.where(F.size("problems") > 0).drop("bucket").write.mode("overwrite").parquet(f"{path}/refused/batch_id={batch_id}")

    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_stream(spark: SparkSession, stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str, buckets: int = 64):
    """Last evidence wins: each batch is put over the table of the latest row per key in a ``BucketStore`` below ``path``.

    Only the buckets a batch touches are read and replaced. To put a batch over twice changes
    nothing, so a replay after a lost commit is safe.
    """
    store = BucketStore(spark, path, keys, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        values = [c for c in batch.columns if c not in keys]
        hit, begun = store.buckets_of(batch), store.version()
        if not hit:
            return
        old = store.read(hit, begun)
        rows = batch if old is None else old.unionByName(batch)
        store.replace(windows.arg_max(rows, keys, values, order), hit, begun)
        store.vacuum()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_stream(spark: SparkSession, stream: DataFrame, key: str, at: str, path: str, checkpoint: str, buckets: int = 64):
    """A request is closed once, by its first stop event however late another comes: the earliest row of each key in a ``BucketStore``.

    Unlike a watermark, the store never forgets a key.
    """
    store = BucketStore(spark, path, [key], buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        hit, begun = store.buckets_of(batch), store.version()
        if not hit:
            return
        old = store.read(hit, begun)
        rows = batch if old is None else old.unionByName(batch)
        values = [c for c in rows.columns if c != key]
        first = rows.groupBy(key).agg(F.min_by(F.struct(*values), F.struct(at, *[c for c in values if c != at])).alias("b")).select(key, "b.*")
        store.replace(first, hit, begun)
        store.vacuum()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def transcription_state(requests: DataFrame, results: DataFrame, now: Column, bound_s: int) -> DataFrame:
    """(key, state) of each request: its result's state if one was created, else ``running`` until the bound and ``timed_out`` after it.

    Repeated requests of a key count once, the first; of its results the first created holds.
    """
    asked = requests.groupBy("key").agg(F.min("requested_at").alias("requested_at"))
    done = results.groupBy("key").agg(F.min_by("state", F.struct("created_at", "state")).alias("done"))
    age = F.unix_timestamp(now) - F.unix_timestamp("requested_at")
    return asked.join(done, "key", "left").select("key", F.coalesce("done", F.when(age > bound_s, "timed_out").otherwise("running")).alias("state"))


def windowed_counts(stream: DataFrame, at: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling event-time counts with a watermark (an extra: batch semantics elsewhere)."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count("*").alias("n"))


def drain(query, then: Callable[[], DataFrame]) -> DataFrame:
    """Wait for an available-now query and give the table it wrote."""
    query.awaitTermination()
    return then()
