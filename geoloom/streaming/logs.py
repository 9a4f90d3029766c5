"""The request-log stream: JSON files in, deduplicated against all that has landed, appended to a table by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Microseconds are kept.
TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
SCHEMA = "server_timestamp timestamp, request_id string, source_ip string, user_agent_header string, client_payload string"


def route_log_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("timestampFormat", TIMES).option("maxFilesPerTrigger", files_per_trigger).json(path)


def retained(df: DataFrame, days: int, as_of: str) -> DataFrame:
    """Rows of the last so many days."""
    return df.where(F.col("server_timestamp") >= F.expr(f"timestamp'{as_of}' - interval {days} days"))


def land(stream: DataFrame, target: str, checkpoint: str, buckets: int = 64) -> None:
    """Run the stream over all that has landed: a request_id lands once, however late; rows without one all land.

    A batch writes to a folder of its own number and looks for repeats in the batches before it, so a replay after a
    lost driver overwrites what it wrote before with the same rows. Rows land in buckets of their id, and only the ids
    in the buckets that the batch touches are read: a small batch reads a small part of what has landed.
    """
    bucket = F.pmod(F.xxhash64("request_id"), F.lit(buckets)).cast("int")  # of a null id one as well

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("bucket", bucket)
        fresh = batch.where("request_id is not null").dropDuplicates(["request_id"])
        if number:
            touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
            landed = batch.sparkSession.read.schema("request_id string, batch long, bucket int").parquet(target).where((F.col("batch") < number) & F.col("bucket").isin(touched))
            fresh = fresh.join(landed.select("bucket", "request_id"), ["bucket", "request_id"], "left_anti").select(*batch.columns)
        fresh.unionByName(batch.where("request_id is null")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
