"""Joins of rows with their groups' fate, where one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, by: Column | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the columns to join them on: where there are large groups, ``keys`` and a ``salt`` that deals a large
    group's rows to tasks.

    A group is large if it holds more than half a task's even share of all rows, so at most twice as many groups as
    there are shuffle partitions are: only these groups' 64-bit hashes are broadcast. A large group gets one salt for each
    half share it holds, so all large groups together have at most four times as many salts as there are partitions.
    ``groups`` (staged) has one row for each key, with its number of rows in ``size``; ``by`` tells a group's rows apart.
    Without it rows are dealt by their place in the partition (read from files, so a repeated task deals them alike):
    that splits groups whose ids are all missing or the same.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    total = groups.agg(F.sum(size)).first()[0] or 0
    share = max(1000, total // (2 * parts))
    number = F.xxhash64(*keys)
    large = F.col(size) > share
    pieces = F.least(F.lit(parts), F.ceil(F.col(size) / share)).cast("int")
    hot = groups.where(large).groupBy(number.alias("hot")).agg(F.max(pieces).alias("pieces"))
    if hot.isEmpty():
        return rows, groups, keys
    hot = F.broadcast(hot)
    names = rows.columns
    place = F.xxhash64(F.monotonically_increasing_id() if by is None else by)
    salted = rows.withColumns({"place": place, "number": number}).join(hot, F.col("number") == F.col("hot"), "left").select(*names, F.coalesce(F.pmod("place", "pieces").cast("int"), F.lit(0)).alias("salt"))
    dealt = groups.withColumn("number", number).join(hot, F.col("number") == F.col("hot"), "left")
    dealt = dealt.select(*groups.columns, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1)).alias("salt"))
    return salted, dealt, [*keys, "salt"]
