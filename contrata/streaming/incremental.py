"""Incremental ingest as streams of files, and the state of retries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrata.sources import sinks

MOST_ATTEMPTS = 4


def new_files(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", **options: str) -> DataFrame:
    """A stream of the files that no run before has seen; the checkpoint remembers them."""
    return spark.readStream.format(kind).schema(schema).options(**options).load(path)


def run_once(stream: DataFrame, checkpoint: str, each) -> StreamingQuery:
    """Everything there is now, in batches, then stops; a run that is cut off goes on where it was."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upsert_into(path: str, keys: list[str], order: str):
    """K9: a batch function that keeps keyed state in numbered versions under a path: a version is complete or not there, and a batch that runs again writes the same one."""

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = None
        if number:
            before = spark.read.parquet(f"{path}/v={number - 1}")
        sinks.upsert(before, batch, keys, order).write.mode("overwrite").parquet(f"{path}/v={number}")

    return each


def attempts(state: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """K9: state after new results: attempts add up, the last status stays."""
    both = state.withColumn("__new", F.lit(0)).unionByName(results.withColumn("attempts", F.lit(1)).withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return both.groupBy(*keys).agg(F.max_by("status", "__new").alias("status"), F.sum("attempts").alias("attempts"))


def to_do(items: DataFrame, state: DataFrame, keys: list[str], retryable_only: bool = False, ignore_most: bool = False, force: bool = False) -> DataFrame:
    """items to fetch: not done, within their attempts, all if forced."""
    joined = items.join(state.select(*keys, "status", "attempts"), keys, "left")
    if force:
        return joined
    open_ = F.coalesce(F.col("status") != "done", F.lit(True))
    if retryable_only:
        open_ = open_ & (F.col("status") == "retryable")
    if not ignore_most:
        open_ = open_ & (F.coalesce("attempts", F.lit(0)) < MOST_ATTEMPTS)
    return joined.where(open_)


def sessions(events: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """Sessions of a stream with a watermark: what comes later than `late` is left out."""
    return events.withWatermark(at, late).groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """D-4 on a stream: the first row of a key, its state dropped after the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)
