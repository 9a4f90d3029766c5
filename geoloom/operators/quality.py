"""Data-quality checks and their report. A check is one row: name, failing rows, severity, passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_checks(df: DataFrame, checks: Sequence[tuple[str, Column, str]], null_is_failure: bool = False) -> DataFrame:
    """Checks on single rows: (name, expression that must hold, severity). All are counted in one pass.

    An expression that is null passes unless ``null_is_failure``.
    """
    bad = {name: (~F.coalesce(test, F.lit(not null_is_failure))) for name, test, _ in checks}
    counted = df.agg(*[F.sum(F.when(b, 1).otherwise(0)).alias(n) for n, b in bad.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(n), F.lit(0)).alias("failures"), F.lit(s).alias("severity")) for n, _, s in checks])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def between(column: str, least: float | None = None, most: float | None = None, strict: bool = False) -> Column:
    c, tests = F.col(column), []
    if least is not None:
        tests.append(c > least if strict else c >= least)
    if most is not None:
        tests.append(c < most if strict else c <= most)
    return reduce(lambda a, b: a & b, tests)


def accepted(column: str, values: Sequence[object]) -> Column:
    return F.col(column).isin(*values)


def where(row_filter: Column, test: Column) -> Column:
    """The test for rows that pass the filter."""
    return ~F.coalesce(row_filter, F.lit(False)) | test


def unique(df: DataFrame, columns: Sequence[str], name: str, severity: str = "error") -> DataFrame:
    """Combinations that occur more than once."""
    return df.groupBy(*columns).count().where("count > 1").agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("failures"), F.lit(severity).alias("severity"))


def expect_pairs(df: DataFrame, expected: str, actual: Column, name: str) -> DataFrame:
    """Rows whose computed value is not the expected one."""
    return df.where(~F.col(expected).eqNullSafe(actual)).agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("failures"), F.lit("error").alias("severity"))


def report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("passed", F.col("failures") == 0)
