"""Streams merged into keyed tables, batch by batch.

A table is cut into buckets by its key. A batch touches some buckets: their newest version is read, the batch is merged into
it, and the result is written as version ``number`` of those buckets, whatever the number is. Last, a manifest of the touched
buckets is written; only buckets that a manifest names exist for readers. So a batch that is replayed after a lost
driver starts from the same older versions and writes the same files again, and a reader never sees half a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class VersionedTable:
    """A keyed table of ``schema`` under ``path``; see above. ``buckets`` bounds what a manifest and a file list hold."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: str, buckets: int = 32):
        self.spark, self.path, self.key, self.schema, self.buckets = spark, path.rstrip("/"), list(key), schema, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def versions(self, before: int | None = None) -> dict[int, int]:
        """Each bucket's newest version (older than ``before``)."""
        if not self._exists(f"{self.path}/manifest"):
            return {}
        named = self.spark.read.schema("bucket int, version long").parquet(f"{self.path}/manifest")
        named = named if before is None else named.where(F.col("version") < before)
        return {r["bucket"]: r["version"] for r in named.groupBy("bucket").agg(F.max("version").alias("version")).collect()}

    def read(self, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """The table, or some of its buckets, as of the newest batch (before ``before``)."""
        newest = self.versions(before)
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(newest.items()) if buckets is None or b in buckets]
        paths = [p for p in paths if self._exists(p)]  # a bucket that a merge emptied has no folder
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def merge(self, batch: DataFrame, number: int, how: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """``how(rows of the touched buckets, batch)`` becomes version ``number`` of these buckets. Rows without a key are an error."""
        lost = F.lit(False)
        for k in self.key:
            lost = lost | F.col(k).isNull()
        batch = batch.withColumn("bucket", F.when(lost, F.raise_error(F.lit("null in a key")).cast("int")).otherwise(self.bucket()))
        touched = sorted(r["bucket"] for r in batch.select("bucket").distinct().collect())  # at most ``buckets``
        if not touched:
            return
        merged = how(self.read(touched, before=number), batch.drop("bucket"))
        merged.withColumn("bucket", self.bucket()).repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/data/version={number}")
        self.spark.createDataFrame([(b,) for b in touched], "bucket int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={number}")


def newest(key: Sequence[str], at: str, tie: Sequence[str] = ()) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """An upsert by event time: of each key the row with the greatest (``at``, ``tie``) stays, in whatever order rows come."""

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        both = old.unionByName(batch.select(*old.columns))
        first = Window.partitionBy(*key).orderBy(F.desc(at), *[F.desc(c) for c in tie])
        return both.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")

    return merge


def observed(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Keeps every distinct row ever seen, so that a late row can still part a version in two; see :func:`history`."""
    return old.unionByName(batch.select(*old.columns)).distinct()


def history(rows: DataFrame, key: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """Versions (key, values, valid_from, valid_to) of observed rows by event time.

    A row that repeats the values before it starts no version. Of rows of one instant the one with the greatest values
    counts. The order in which rows arrived doesn't matter.
    """
    by_key = Window.partitionBy(*key).orderBy(at)
    last = Window.partitionBy(*key, at).orderBy(*[F.desc_nulls_last(v) for v in values])
    one = rows.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")
    now, before = F.struct(*values), F.lag(F.struct(*values)).over(by_key)
    starts = one.withColumn("_new", before.isNull() | ~before.eqNullSafe(now)).where("_new").drop("_new")
    return starts.select(*key, *values, F.col(at).alias("valid_from"), F.lead(at).over(by_key).alias("valid_to"))


def merge_stream(stream: DataFrame, table: VersionedTable, how: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str) -> None:
    """Merge all that the stream has into ``table``."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            table.merge(batch, number, how)
        finally:
            batch.unpersist()

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
