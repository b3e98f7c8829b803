"""Incremental mode: what landed since the last run, once, into upserted tables or merged states."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessellar.sinks import upsert_table


def landed(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the parquet files that land in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_available(stream: DataFrame, progress: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process all that is there, batch by batch, and stop; ``progress`` remembers what is done. ``each`` must be able to repeat a batch."""
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", progress).trigger(availableNow=True).start()
    q.awaitTermination()


def upsert_stream(stream: DataFrame, path: str, progress: str, key: Sequence[str], latest: Sequence[Column]) -> None:
    """Keep ``path`` at one row per key, the latest, as rows land; repeating a batch changes nothing."""
    run_available(stream, progress, lambda batch, _: upsert_table(batch, path, key, latest))


def late_counts(stream: DataFrame, at: str, keys: Sequence[str], window: str = "1 day", delay: str = "30 days") -> DataFrame:
    """Counts per window of ``at`` and keys, rows up to ``delay`` late included."""
    t = F.col(at).cast("timestamp")
    return stream.withColumn("__t", t).withWatermark("__t", delay).groupBy(F.window("__t", window), *keys).agg(F.count(F.lit(1)).alias("n"))
