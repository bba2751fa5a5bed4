"""Micro-batch processing with resume and exactly-once results.

The stream's own state remembers the keys, dealt out by key, so a batch meets only the
keys that it holds and never reads what earlier batches wrote. A batch's rows go to a
partition named by the batch, which a replay overwrites. A signature of the run's
settings stands beside the checkpoint, so a checkpoint is not resumed with other settings.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def signature(settings: dict) -> str:
    """SHA-256 of the settings as canonical JSON."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, files: int = 4) -> DataFrame:
    """A stream over the files of a Parquet folder, or over one file; ``files`` at most in a batch."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())


def _guard(spark: SparkSession, path: str, sign: str) -> None:
    """Writes the signature at the first start; refuses another one at a resume. Uses the path's own file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        stream = fs.open(p)
        found = bytes(stream.readAllBytes()).decode()
        stream.close()
        if found != sign:
            raise ValueError("the checkpoint belongs to a run with other settings")
        return
    stream = fs.create(p)
    stream.write(bytearray(sign.encode()))
    stream.close()


def write_batch(target: str, batch: DataFrame, batch_id: int) -> None:
    """The batch's rows as partition ``batch_id``; a replay gives the same partition."""
    batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


def run(source: DataFrame, target: str, checkpoint: str, key: list[str], transform: Callable[[DataFrame], DataFrame], settings: dict | None = None, watermark: tuple[str, str] | None = None) -> None:
    """Processes all that the streaming ``source`` has, batch by batch, and stops; a later call goes on from there.

    Of the rows that share a key the first that comes stays. ``watermark`` (column of times,
    delay) bounds the state: keys are then forgotten after the delay.
    """
    spark = source.sparkSession
    _guard(spark, f"{checkpoint}/settings.sha256", signature(settings or {}))
    rows = transform(source.withWatermark(*watermark) if watermark else source)
    once = rows.dropDuplicatesWithinWatermark(key) if watermark else rows.dropDuplicates(key)
    once.writeStream.foreachBatch(lambda batch, batch_id: write_batch(target, batch, batch_id)).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start().awaitTermination()


def best_of_batches(spark: SparkSession, target: str, partition: list[str], order: list[str], most: int) -> DataFrame:
    """Of all batches' rows the ``most`` first of each ``partition`` by ``order`` (a name with a minus before it falls)."""
    by = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    return spark.read.parquet(target).withColumn("rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*by))).filter(F.col("rank") <= most)


def result(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(target)
