"""Session-level helpers: shipping this package to executors and staging tables in the shared folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_staged: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


#: Spark's own setting for the bytes of a record batch on its way to a Python worker, and what it is here. Spark's 64 MB or
#: 10,000 rows are some 33 MB of documents, held several times over: by the task that writes a batch and by the worker,
#: which reads the next one while it has the last.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Record batches of ``BATCH_BYTES``, unless the session or the application has a size of its own."""
    if spark.conf.get(BATCH_SETTING, None) is None and not spark.sparkContext.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (as ``--py-files`` would)."""
    small_batches(spark)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    if not root.is_dir():  # already running from a shipped zip
        return
    target = os.path.join(tempfile.mkdtemp(prefix="geoloom-"), "geoloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` where the cluster names one.

    Only a session without that setting (tests, a laptop) gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="geoloom-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors.

    The files go with :func:`free`, or when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    _staged.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def stage_bucketed(df: DataFrame, key: str, move: bool = False, more_of: DataFrame | None = None) -> DataFrame:
    """:func:`stage` as a table bucketed by ``key``: what is joined to it by the key need not move it.

    It has as many buckets as shuffles have partitions. Every task writes a file for each bucket it has rows of; with
    ``move`` rows are shuffled first, so that a bucket is one file. Rows join those of ``more_of``, an earlier
    result of this function. The table goes when the application ends.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) if more_of is None else more_of.staged_buckets
    writer = (df.repartition(buckets, key) if move else df).write.bucketBy(buckets, key)
    if more_of is None:
        name = f"stage_{uuid.uuid4().hex}"
        path = f"{shared_dir(spark).rstrip('/')}/{name}"
        writer.option("path", path).saveAsTable(name)
        _staged.append((spark, path))
        _tables.append((spark, name))
    else:
        name = more_of.staged_in
        writer.mode("append").saveAsTable(name)
    out = spark.table(name)
    out.staged_in, out.staged_buckets = name, buckets
    return out


def free(*staged: DataFrame) -> None:
    """Remove the files of staged tables that nothing reads any more: all that came of them is itself staged."""
    for df in staged:
        _delete(df.sparkSession, df.staged_at)
        _staged.remove((df.sparkSession, df.staged_at))


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"drop table if exists {name}")


@atexit.register
def _clean() -> None:
    for drop, held in ((_drop, _tables), (_delete, _staged)):
        try:
            for spark, what in held:
                drop(spark, what)
        except Exception:  # the JVM may be gone already
            return
