"""Incremental loads: high-water marks, pending work, run statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def mark_text(ts: Column) -> Column:
    """Fixed-width text of a timestamp, so that marks compare as text."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def incremental_filter(df: DataFrame, column: str, id_column: str, mark: str, mark_id: int, also: str | None = None) -> DataFrame:
    """Rows past a (value, id) mark, in its order."""
    c = mark_text(F.col(column))
    out = df.where((c > mark) | ((c == mark) & (F.col(id_column) > mark_id)))
    return (out.where(also) if also else out).orderBy(column, id_column)


def pair_mark(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """The greatest (value, id); nulls don't count. mark: 'value|id'."""
    top = df.where(F.col(column).isNotNull()).agg(F.max(F.struct(mark_text(F.col(column)).alias("v"), F.col(id_column).alias("i"))).alias("m"))
    return top.select(F.col("m.v").alias("mark_value"), F.col("m.i").alias("mark_id"), F.concat_ws("|", "m.v", F.col("m.i").cast("string")).alias("mark"))


def parse_mark(mark: str | None, override: str | None = None) -> tuple[str, int] | None:
    """(value, id) of a stored 'value|id'. An ``override`` goes first; an empty one, like no mark at all, means a full load.

    A mark without an id, as older runs left it, resumes behind all ids of its value.
    """
    text = mark if override is None else override
    if not text:
        return None
    value, bar, number = text.rpartition("|")
    return (value, int(number)) if bar else (text, 2**63 - 1)


def resume(df: DataFrame, column: str, id_column: str, mark: str | None, override: str | None = None, also: str | None = None) -> DataFrame:
    """The rows of the next load: those past the mark, or all of them for a full load, in the order of marks."""
    at = parse_mark(mark, override)
    if at is None:
        return (df.where(also) if also else df).orderBy(column, id_column)
    return incremental_filter(df, column, id_column, *at, also)


def high_water(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("high_water"))


def skip_seen(df: DataFrame, column: str, mark: str) -> DataFrame:
    """Rows after the mark and rows without a date."""
    return df.where(F.col(column).isNull() | (F.col(column) > F.lit(mark).cast("timestamp")))


def pending(work: DataFrame, done: DataFrame, key: list[str], fresh_since: str | None = None, force: bool = False) -> DataFrame:
    """Work units that no (fresh) load covers yet; all of them when forced. ``key`` is whatever names a unit: vintage and state,
    a region, a tile. A unit with a null in its key is always pending."""
    if force:
        return work
    if fresh_since:
        done = done.where(F.col("ingested_at") >= F.lit(fresh_since).cast("timestamp"))
    return work.join(done.select(*key).distinct(), key, "left_anti")


def run_stats(log: DataFrame, default_minutes: float = 5.0) -> DataFrame:
    """Average minutes of successful runs by source and mode."""
    minutes = (F.unix_timestamp("completed_at") - F.unix_timestamp("started_at")) / 60.0
    ok = F.when(F.col("status") == "success", minutes)
    return log.groupBy("source", "mode").agg(F.round(F.coalesce(F.avg(ok), F.lit(default_minutes)), 6).alias("avg_minutes"), F.count(F.lit(1)).alias("runs"))


def last_mark(log: DataFrame) -> DataFrame:
    """The newest successful run of each data set that left a mark."""
    w = Window.partitionBy("source", "dataset_id").orderBy(F.desc("completed_at"), F.desc("run_id"))
    return log.where("status = 'success' and high_water_mark is not null").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("source", "dataset_id", "run_id", "high_water_mark")


def run_history(log: DataFrame, source: str) -> DataFrame:
    return log.where(F.col("source") == source).select("run_id", "dataset_id", "mode", "status", F.round((F.unix_timestamp("completed_at") - F.unix_timestamp("started_at")).cast("double"), 6).alias("seconds"))


class PartialLoad(RuntimeError):
    """A load broke off; ``merged`` is the target with what was staged before."""

    def __init__(self, message: str, merged: DataFrame):
        super().__init__(message)
        self.merged = merged


def merge_pages(pages: Iterable[Callable[[], DataFrame]], target: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Stage page after page, then ``merge(target, staged)``. If a page fails, what was staged is merged all the same, and
    :class:`PartialLoad` is raised with the result; the failed page and those after it are left for the next run."""
    staged = None
    for number, page in enumerate(pages):
        try:
            got = page()
        except Exception as error:
            raise PartialLoad(f"page {number}: {error}", target if staged is None else merge(target, staged)) from error
        staged = got if staged is None else staged.unionByName(got)
    return target if staged is None else merge(target, staged)


LOG = "source string, unit string, mode string, status string, rows_staged long, rows_merged long, error string, high_water_mark string, started_at timestamp, completed_at timestamp"


def run_units(spark: SparkSession, log_path: str, source: str, mode: str, units: dict[str, Callable[[], dict]]) -> DataFrame:
    """Run every unit of work and append its log entry to the table at ``log_path``, whether it succeeds or not.

    A unit returns what it knows of rows_staged, rows_merged and high_water_mark. A unit that fails leaves the others
    running; its entry says what went wrong. Returns the entries of this run.
    """
    entries = []
    for unit, work in units.items():
        began, known, error = datetime.now(timezone.utc), {}, None
        try:
            known = work() or {}
        except Exception as e:  # the entry keeps what went wrong
            error = str(e)[:500]
        finally:
            entry = (source, unit, mode, "failed" if error is not None else "success", known.get("rows_staged"), known.get("rows_merged"), error, known.get("high_water_mark"), began, datetime.now(timezone.utc))
            entries.append(entry)
            spark.createDataFrame([entry], LOG).write.mode("append").parquet(log_path)
    return spark.createDataFrame(entries, LOG)


class Counters:
    """Counts that ride on the jobs of one run: nothing is read twice to be counted.

    ``tap(df, name=condition, ...)`` counts the rows of ``df`` where each condition holds, as they pass on their way to
    wherever ``df`` is written; ``values()`` gives all counts once that has happened. Each tap's rows have to pass once: below
    a range partitioning, whose bounds are found by a job of its own, they would pass twice.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def tap(self, df: DataFrame, **counts: Column) -> DataFrame:
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long").alias(n) for n, c in counts.items()])

    def values(self) -> dict[str, int]:
        return {n: v for seen in self._seen for n, v in seen.get.items()}
