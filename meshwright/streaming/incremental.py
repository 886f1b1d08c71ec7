"""Incremental fusion: new mapping rows arrive as a stream of files; only their keys' partial rows are merged and fused again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meshwright.operators.fusion import finish, merge, partial
from meshwright.vocab import KEY, MAPPINGS


def fold(batch: DataFrame, buckets: int) -> DataFrame:
    """A batch with the bucket that its keys belong to."""
    return batch.withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int"))


def start(spark: SparkSession, source: str, folder: str, checkpoint: str, buckets: int = 64, min_confidence: float = 0.0, available_now: bool = True, files_per_batch: int | None = None) -> StreamingQuery:
    """Merge each micro-batch into ``folder/partials`` (one row per key and matcher, not the history) and rewrite only the buckets of ``folder/fused`` that it touches.

    The merge takes a batch that is repeated after a failure as one, so the result doesn't depend on restarts. Choose ``buckets`` so that a bucket's partial rows are a few files.
    """
    store, fused = f"{folder}/partials", f"{folder}/fused"
    schema = partial(spark.createDataFrame([], MAPPINGS)).withColumn("bucket", F.lit(0)).schema

    def replace(df: DataFrame, path: str) -> None:
        df.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)

    def step(batch: DataFrame, number: int) -> None:
        rows = fold(partial(batch, min_confidence), buckets).persist()
        touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
        if touched:
            try:
                known = spark.read.schema(schema).parquet(store).where(F.col("bucket").isin(touched))
            except AnalysisException:  # the first batch
                known = spark.createDataFrame([], schema)
            merged = fold(merge(rows.unionByName(known)), buckets).persist()
            merged.count()
            replace(merged, store)
            replace(fold(finish(merged), buckets), fused)
            merged.unpersist()
        rows.unpersist()

    reader = spark.readStream.schema(MAPPINGS)
    stream = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(source)
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling counts per key with a watermark; works on streams and tables."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
