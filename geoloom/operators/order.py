"""Places and running totals over a whole order, in two steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.session import stage


def numbered(rows: DataFrame, order: Sequence[Column | str], *sums: str) -> DataFrame:
    """``rows`` with ``at``, their place in the order (from 0), and ``before_<c>`` for each column c of ``sums``: the total
    of c over all earlier rows. Staged; the order has to tell all rows apart that differ.

    Rows are dealt out by ranges of the order and numbered within each partition; then the partitions' totals, one row
    for each shuffle partition, are summed. No group meets in one task, however many rows it holds.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = stage(dealt.withColumn("own", F.monotonically_increasing_id()))
    part = F.shiftright("own", 33)  # of monotonically_increasing_id: the partition, then the row in it
    here = F.col("own") - F.shiftleft(part, 33)
    totals = marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_part"), *[F.sum(c).alias(f"sum_{c}") for c in sums])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    base = totals.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"base_{c}") for c in ("n_part", *[f"sum_{c}" for c in sums])])
    out = marked.withColumn("part", part)
    if sums:
        within = Window.partitionBy("part").orderBy("own").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in sums})
    out = out.join(F.broadcast(base), "part").withColumns({"at": F.col("base_n_part") + here} | {f"before_{c}": F.col(f"before_{c}") + F.col(f"base_sum_{c}") for c in sums})
    return out.drop("own", "part", *base.columns)
