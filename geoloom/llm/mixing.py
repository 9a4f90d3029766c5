"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

A source's target divided by its size is the expected number of copies of each of its documents. The expected copies
are summed along the source's documents, from the smallest to the largest, a random offset is added, and a document
is emitted once for every integer that its stretch of the sum crosses. As the order is by size, the words taken miss the
target by less than the largest document of the source, and no document is taken more often than its expected copies
rounded up.

Prefix sums are taken in two steps: rows are dealt out by ranges of the whole order, numbered within each partition, and
the partitions' totals (one row for each shuffle partition) are summed. A source with a third of all rows is spread over
as many partitions as its rows need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.order import numbered
from geoloom.session import stage

#: Expected copies and offsets are whole numbers of 2**-24, so that sums over a hundred billion rows are exact.
BITS = 24
_WORD = r"[^\x20\x09-\x0D]+"


def _digits(text: Column, n: int) -> Column:
    """A number of ``n`` hexadecimal digits that is as good as random."""
    return F.conv(F.substring(F.md5(text), 1, n), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """source, source_size, n, before_n (documents of the sources before it), target. sources: source, source_size, n.

    Weights go round the sources in code-point order, null last. All sizes times ``share`` are shared out by weight;
    a target stops at ``most`` times the source's size, and the excess goes to the others by weight until none is
    above. That level is found without a loop: sources are put in the order in which they would fill up, and the first
    that isn't filled by what the earlier ones leave settles it.
    """
    placed = numbered(sources, [F.col("source").asc_nulls_last()], "n").withColumnRenamed("at", "place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    placed = placed.withColumns({"weight": weight, "room": F.col("source_size") * F.lit(float(most))}).withColumn("full", F.col("room") / F.col("weight"))
    total = placed.agg((F.sum("source_size") * F.lit(float(share))).alias("all_words"), F.sum("weight").alias("all_weight"))  # one row
    filling = numbered(placed, ["full", "place"], "room", "weight").join(F.broadcast(total))
    left, weight_left = F.col("all_words") - F.col("before_room"), F.col("all_weight") - F.col("before_weight")
    level = filling.where(left <= F.col("full") * weight_left).agg(F.min(F.struct("at", (left / weight_left).alias("level"))).alias("l")).select("l.level")  # one row
    return filling.join(F.broadcast(level)).select("source", "source_size", "n", "before_n", F.least("room", F.col("weight") * F.coalesce("level", F.lit(float("inf")))).alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix", carry: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies (and the column ``carry``) for every row of ``docs`` (doc_id, text,
    source): how often the mix takes it, and how many words that is.

    Sizes are words; a null text has 0 and is taken without effect. A null source is a source of its own. Rows that
    repeat a doc_id are decided one by one; a null doc_id is decided like any other. An empty table gives no rows, and
    where all texts are empty all targets are 0. Other columns of ``docs`` are not read, whatever their names. The same
    table gives the same result: offsets come from ``seed`` and the source's name, ties in size go by a hash of the
    doc_id.
    """
    held = [F.col(carry).alias("held")] if carry else []
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    rows = stage(docs.select("doc_id", "source", size.alias("size"), *held).withColumn("tie", _digits(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 15)))
    sources = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    targets = stage(source_targets(sources, weights, share, most))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("tie"), F.col("doc_id"), *(["held"] if carry else [])]
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * F.lit(float(1 << BITS)))).otherwise(F.lit(0)).cast("long")
    offset = _digits(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))), BITS // 4)
    rates = targets.select(F.col("source").alias("of"), "source_size", "target", "before_n", rate.alias("rate"), offset.alias("offset"))
    met = numbered(rows, order).join(rates, F.col("source").eqNullSafe(F.col("of")))
    crossed = lambda i: F.shiftright(i * F.col("rate") + F.col("offset"), BITS)
    place = F.col("at") - F.col("before_n")
    copies = crossed(place + 1) - crossed(place)
    out = met.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), *(["held"] if carry else []))
    return out.withColumnRenamed("held", carry) if carry else out


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mixed table itself: every row of ``docs`` as often as :func:`mix_plan` takes it, all its columns kept."""
    row = "row"
    while row in docs.columns:
        row += "_"
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()))
    plan = mix_plan(kept, weights, share, most, seed, carry=row).where("copies > 0").select(F.col(row).alias("num"), F.col("copies").cast("int").alias("times"))
    met = kept.join(plan, kept[row] == plan.num).withColumn(row, F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    return met.select(*[kept[c] for c in docs.columns])


ORACLE = rf"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size, ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint as tie from documents
), s as (
  select source, sum(size)::bigint as source_size, (case (row_number() over (order by encode(source) nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end)::double as weight from d group by source
), r as (
  select *, source_size * 2.0::double as room, source_size * 2.0::double / weight as filled, row_number() over (order by source_size * 2.0::double / weight, encode(source) nulls last) as k from s
), b as (
  select *, coalesce(sum(room) over (order by k rows between unbounded preceding and 1 preceding), 0) as room_before, coalesce(sum(weight) over (order by k rows between unbounded preceding and 1 preceding), 0) as weight_before,
    sum(source_size) over ()::double * 1.5::double as all_words, sum(weight) over () as all_weight from r
), l as (
  select (all_words - room_before) / (all_weight - weight_before) as level from b where all_words - room_before <= filled * (all_weight - weight_before) order by k limit 1
), t as (
  select source, source_size, least(room, weight * level) as target, ('0x' || substr(md5('mix:' || coalesce('s' || source, 'n')), 1, 6))::bigint as u from b, l
), e as (
  select d.doc_id, d.size, t.source_size, t.target, t.u, case when t.source_size > 0 then floor(t.target / t.source_size * 16777216.0::double)::bigint else 0 end as rate,
    row_number() over (partition by d.source order by d.size, d.tie, d.doc_id) as i
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target, size * (((i * rate + u) >> 24) - (((i - 1) * rate + u) >> 24)) as taken, ((i * rate + u) >> 24) - (((i - 1) * rate + u) >> 24) as copies from e
"""
