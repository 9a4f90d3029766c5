"""Results that leave a job whole: built tables that swap in, ordered layers, numbered batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.operators.incremental import Counters
from geoloom.operators.order import numbered


class Protected(RuntimeError):
    """A full refresh of a table that must not be rebuilt."""


class Built:
    """A table under ``path`` in generations. Readers see the newest generation that was finished: a build writes beside it and
    swaps in by a marker, so one that fails leaves the table as it was."""

    def __init__(self, spark: SparkSession, path: str, protected: bool = False):
        self.spark, self.path, self.protected = spark, path.rstrip("/"), protected

    def _done(self) -> list[int]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/done")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []

    def exists(self) -> bool:
        return bool(self._done())

    def read(self) -> DataFrame:
        """All parts of the newest build: itself, and what was appended since."""
        done = self._done()
        if not done:
            raise FileNotFoundError(f"nothing is built at {self.path}")
        begun = self.spark.read.schema("full boolean, number int").json([f"{self.path}/done/{n}/mark" for n in done])
        start = begun.where("full").agg(F.max("number")).first()[0]  # one small mark for each build
        return self.spark.read.parquet(*[f"{self.path}/data/{n}" for n in done if n >= start])

    def _finish(self, number: int, full: bool) -> None:
        self.spark.createDataFrame([(full, number)], "full boolean, number int").coalesce(1).write.mode("overwrite").json(f"{self.path}/data-mark/{number}/mark")
        jvm = self.spark.sparkContext._jvm
        at, to = (jvm.org.apache.hadoop.fs.Path(f"{self.path}/{d}/{number}") for d in ("data-mark", "done"))
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(to.getParent())
        if not fs.rename(at, to):  # the swap: one rename
            raise OSError(f"{to} can't be made")

    def build(self, df: DataFrame) -> None:
        """Replace the table; refused where it is protected and there."""
        done = self._done()
        if self.protected and done:
            raise Protected(f"{self.path} is only ever appended to")
        number = (done[-1] if done else 0) + 1
        df.write.mode("overwrite").parquet(f"{self.path}/data/{number}")
        self._finish(number, True)

    def append(self, df: DataFrame, key: Sequence[str]) -> None:
        """Add the rows of keys that the table doesn't have; rows with a null in the key never count as new."""
        if not self.exists():
            return self.build(df)
        known = df
        for k in key:
            known = known.where(F.col(k).isNotNull())
        number = self._done()[-1] + 1
        known.join(self.read().select(*key), list(key), "left_anti").select(*df.columns).write.mode("overwrite").parquet(f"{self.path}/data/{number}")
        self._finish(number, False)


@dataclass
class Layer:
    """One export: rows, geometry kind and coordinates (nested arrays of doubles), properties, and which rows in which order."""

    rows: DataFrame
    kind: str
    coordinates: Column
    properties: Sequence[str]
    where: str | None = None
    order: Sequence[str] = ()
    limit: int | None = None
    options: dict = field(default_factory=dict)


def _finite(c: Column, depth: int) -> Column:
    """Whether all numbers of nested arrays are there and finite."""
    if depth == 0:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    return F.coalesce((F.size(c) > 0) & F.forall(c, lambda x: _finite(x, depth - 1)), F.lit(False))


def export_layers(layers: dict[str, Callable[[], Layer]], path: str) -> DataFrame:
    """Write every layer as feature texts, one a line, in its order over its files; layer, written, skipped and error of each.

    Files are dealt by ranges of the order, so reading them by name gives the order back. A limit is taken in that order.
    Rows whose coordinates aren't all finite numbers are skipped; they are counted as the layer is written. A layer
    that fails leaves the others alone and is reported with what went wrong.
    """
    report, session = [], None
    for name, make in layers.items():
        counts, error = Counters(), None
        try:
            layer = make()
            session = session or layer.rows.sparkSession
            kinds = dict(layer.rows.dtypes)
            rows = layer.rows.where(layer.where) if layer.where else layer.rows
            depth = {"Point": 1, "LineString": 2, "MultiPoint": 2, "Polygon": 3, "MultiLineString": 3, "MultiPolygon": 4}[layer.kind]
            rows = rows.withColumn("_ok", _finite(layer.coordinates, depth))
            usable = lambda df: counts.tap(df, skipped=~F.col("_ok")).where("_ok")
            value = lambda p: F.when(~F.isnan(p) & (F.abs(F.col(p)) < float("inf")), F.col(p)) if kinds[p] in ("double", "float") else F.col(p) if kinds[p] in ("int", "bigint", "boolean", "string") else F.col(p).cast("string")
            feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit(layer.kind).alias("type"), layer.coordinates.alias("coordinates")).alias("geometry"), F.struct(*[value(p).alias(p) for p in layer.properties]).alias("properties"))
            if layer.order and layer.limit is not None:
                rows = usable(rows).orderBy(*layer.order).limit(layer.limit)
            elif layer.order:  # counted behind the ranges: they are found by a job of its own that reads the rows too
                rows = usable(rows.repartitionByRange(*layer.order).sortWithinPartitions(*layer.order))
            else:
                rows = usable(rows) if layer.limit is None else usable(rows).limit(layer.limit)
            counts.tap(rows.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value")), written=F.lit(True)).write.mode("overwrite").text(f"{path}/{name}")
        except Exception as e:  # the report keeps what went wrong
            error = type(e).__name__
        seen = counts.values() if error is None else {}
        report.append((name, seen.get("written"), seen.get("skipped"), error))
    session = session or SparkSession.active()
    return session.createDataFrame(report, "layer string, written long, skipped long, error string")


def deliver(df: DataFrame, order: Sequence[str], batch_rows: int, send: Callable[[int, pa.Table], None], has: Callable[[int], bool] = lambda number: False) -> int:
    """Hand ``df`` to ``send(number, rows)`` in numbered batches of ``batch_rows`` rows of the order; how many rows that is.

    Batches are cut from a staged numbering, so a task or a job that runs again cuts the same ones. ``has(number)`` tells
    whether the receiver has a batch already: it is asked before each one, and what it has isn't sent again. Both run
    on executors, one batch in memory at a time.
    """
    marked = numbered(df, order).withColumn("number", F.floor(F.col("at") / batch_rows).cast("long"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        number = key[0].as_py()
        if not has(number):
            rows = rows.sort_by("at").drop_columns(["at", "number"])
            send(number, rows)
        return pa.table({"number": pa.array([number], pa.int64()), "n": pa.array([rows.num_rows], pa.int64())})

    sent = marked.repartition(parts, "number").groupBy("number").applyInArrow(run, "number long, n long")
    return sent.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
