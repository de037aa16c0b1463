"""Streaming forms: the last event of each key, windowed counts, a landing folder.

Each query reads files as a stream, processes what is there and stops; run with another
trigger they go on.  Results are written by ``foreachBatch`` under the session's checkpoint
folder, never kept in the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerloom.session import shared_folder


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder as a stream of its files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_once(query: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Process all that is there and read the result back.

    Every batch is a folder of its own, written over when a batch is done again.  The result
    is the last batch of ``complete`` mode, the last row of each of ``keys`` in ``update``
    mode and all rows in ``append`` mode.
    """
    spark = query.sparkSession
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/out/_batch={number}")

    query.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{home}/log").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(StructType([*query.schema.fields, StructField("_batch", LongType())])).option("basePath", f"{home}/out").parquet(f"{home}/out/*")
    if mode == "append":
        return out.drop("_batch")
    if mode == "complete":
        return out.join(F.broadcast(out.agg(F.max("_batch").alias("_batch"))), "_batch", "left_semi").drop("_batch")  # one row
    rest = [c for c in query.columns if c not in keys]
    return out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last")).select(*keys, "_last.*").select(*query.columns)


def last_events(events: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """The last event of each key (W8) as a running aggregate of a stream or a table; state
    is one row a key."""
    return events.groupBy(key).agg(*[F.max_by(f, order).alias(f) for f in fields])


def windowed_counts(events: DataFrame, order: str, key: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts by tumbling window and key, for ``update`` mode: windows older than ``late``
    leave the state, and events that late are left out."""
    timed = events.withColumn(order, F.col(order).cast("timestamp"))  # a watermark needs a zone
    counted = timed.withWatermark(order, late).groupBy(F.window(order, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("start"), key, "n")


def landed_files(spark: SparkSession, folder: str, pattern: str, remembered: str = "30 days") -> DataFrame:
    """New files of a landing folder with their hash; equal contents are taken once as long
    as they are ``remembered``, which bounds the state."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(folder)
    hashed = files.withWatermark("modificationTime", remembered).select("modificationTime", "path", "length", F.sha2("content", 256).alias("sha256"))
    return hashed.dropDuplicatesWithinWatermark(["sha256"]).drop("modificationTime")
