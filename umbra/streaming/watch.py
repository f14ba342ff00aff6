"""Extension: a folder watched as a stream; each micro-batch is scanned, and numbered after the mapping so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from umbra.operators import detect, mapping as mp


def watch(spark: SparkSession, folder: str, state: str, checkpoint: str) -> StreamingQuery:
    """Keeps the mapping of all texts that arrive in folder under state/v=N, a whole version a batch.

    A batch that is tried again after a failure reads version N - 1 and overwrites N, so numbers do not change.
    """
    source = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    texts = source.select("path", F.col("content").cast("string").alias("text")).where(F.is_valid_utf8("text"))

    def step(batch: DataFrame, number: int) -> None:
        before = batch.sparkSession.read.parquet(f"{state}/v={number - 1}") if number else None
        mp.build(detect.scan_texts(batch), detect.ORDER, known=before).write.mode("overwrite").parquet(f"{state}/v={number}")

    return texts.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
