"""Exact duplicates by distributed most-significant-digit radix partitioning.

A round reads the next digit (a run of characters) of every document that still shares all digits so far with
another one, and splits its group by it. Groups of one are done; groups whose texts have ended are copies. Digits are
compared as they are, so equality needs no digest. Digits widen from round to round: most texts part within the
first, and a text of n characters needs about log2(n) rounds.

Every count is pre-aggregated before its shuffle, and a large group's rows learn its fate over salted keys, so a group
that holds a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.skew import spread
from geoloom.session import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def exact_groups(docs: DataFrame, first_digit: int = 32, widen: int = 8) -> DataFrame:
    """Rows that have a copy: doc_id, text_sha256, keep_id, group_size.

    text_sha256 only names the row's text when results are put back; it decides nothing.
    """
    # lower-casing keeps every place, so a first digit is read from the text as it is, and whole texts of copies only
    live = docs.select("doc_id", F.lit(0).cast("long").alias("gid"), F.coalesce("text", F.lit("")).alias("rest"))
    at, width, done = 0, first_digit, []
    while True:
        keyed = live.select(
            "doc_id",
            *([] if at == 0 else ["text_sha256"]),
            "gid",
            lower_ascii(F.substring("rest", 1, width)).alias("digit"),
            (F.length("rest") <= width).alias("ended"),
            "rest",
        )
        groups = stage(
            keyed.groupBy("gid", "digit", "ended")
            .agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
            .where("group_size > 1")
            .withColumn("group", F.monotonically_increasing_id())
        )
        keyed, groups, keys = spread(keyed, groups, ["gid", "digit", "ended"], "group_size")
        # a shuffle join at every size: the group table grows with the corpus
        split = keyed.join(groups.hint("merge"), keys)
        out = split.select(
            "doc_id",
            (F.sha2(lower_ascii(F.col("rest")), 256) if at == 0 else F.col("text_sha256")).alias("text_sha256"),
            F.col("group").alias("gid"),
            F.expr(f"substring(rest, {width + 1})").alias("rest"),
            "ended",
            "keep_id",
            "group_size",
        )
        out = stage(out)
        done.append(out.where("ended").select("doc_id", "text_sha256", "keep_id", "group_size"))
        live = out.where("not ended").select("doc_id", "text_sha256", "gid", "rest")
        if live.isEmpty():
            break
        at, width = at + width, width * widen
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def exact_dedup(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and the column ``carry`` of its row.

    Texts are equal when identical after lower-casing A-Z. The largest doc_id of equal texts stays. Null text is the
    empty text, so null and empty texts are copies of each other. A null doc_id is smaller than any number. Of each group
    exactly one row stays: rows that repeat both doc_id and text are each counted and returned, and one of them is kept.
    An empty table gives no rows. Other columns are not read.
    """
    more = [F.col(carry).alias("carried")] if carry else []
    docs = docs.select("doc_id", "text", *more)
    copies = exact_groups(docs).dropDuplicates(["doc_id", "text_sha256"])
    copies = copies.select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("s"), "keep_id", "group_size").hint("merge")
    found = stage(
        docs.select("doc_id", F.sha2(lower_ascii(F.col("text")), 256).alias("text_sha256"), *docs.columns[2:])
        .join(copies, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_sha256") == F.col("s")), "left")
        .select("doc_id", "text_sha256", F.when(F.col("s").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), *docs.columns[2:])
        .withColumn("row", F.monotonically_increasing_id())
    )
    kept = F.expr("doc_id <=> keep_id")
    # several rows with the id that stays: the first of them
    last = found.where(F.col("group_size") > 1).where(kept)
    ties = stage(last.groupBy("keep_id", "text_sha256").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("keep_id").alias("k"), F.col("text_sha256").alias("t"), "first"))
    if not ties.isEmpty():
        late = last.join(ties, F.col("keep_id").eqNullSafe(F.col("k")) & (F.col("text_sha256") == F.col("t"))).where("row > first").select("row", F.lit(True).alias("late"))
        found, kept = found.join(late, "row", "left"), kept & F.col("late").isNull()
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", *([F.col("carried").alias(carry)] if carry else []))


ORACLE = f"""
with t as (
  select doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as norm from documents
)
select doc_id,
       max(doc_id) over (partition by norm) as keep_id,
       cast(count(*) over (partition by norm) as bigint) as group_size,
       doc_id = max(doc_id) over (partition by norm) as kept,
       sha256(norm) as text_sha256
from t
"""
