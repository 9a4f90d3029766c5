"""Merges as set operations on tables: append, insert-ignore, upsert and slowly changing dimensions (type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.text import canonical_text, sanitize, standard_name

SCD2 = ("record_hash", "valid_from", "valid_to")


def append(target: DataFrame, staged: DataFrame) -> DataFrame:
    return target.unionByName(staged)


def first_of_batch(staged: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key of a batch: the first by ``order``."""
    return staged.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")


def insert_ignore(target: DataFrame, staged: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Existing rows stay; of a new key the first row of the batch goes in."""
    fresh = staged.join(target.select(*key), list(key), "left_anti")
    return target.unionByName(first_of_batch(fresh, key, order).select(*target.columns))


def upsert(target: DataFrame, staged: DataFrame, key: Sequence[str], update: Sequence[str] | None = None, dedupe_order: Sequence[str | Column] | None = None) -> DataFrame:
    """Update the named columns (all but the key, by default) of known keys, insert the rest: one full-outer join.

    A key twice in the batch is an error unless ``dedupe_order`` says which row comes first.
    """
    update = [c for c in target.columns if c not in key] if update is None else list(update)
    if dedupe_order is not None:
        staged = first_of_batch(staged, key, dedupe_order)
    else:
        twice = Window.partitionBy(*key)
        staged = staged.withColumn("_n", F.count(F.lit(1)).over(twice)).withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.lit("a key occurs twice in the batch")).cast("long")).otherwise(F.col("_n")))
        staged = staged.where("_n = 1").drop("_n")
    s = staged.select(*[F.col(c).alias(f"s_{c}") for c in target.columns], F.lit(True).alias("_in"))
    t = target.withColumn("_old", F.lit(True))
    both = t.join(s, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"s_{k}") for k in key]), "full_outer")
    new = F.col("_in").isNotNull()
    out = []
    for c in target.columns:
        if c in key:
            out.append(F.coalesce(c, f"s_{c}").alias(c))
        elif c in update:
            out.append(F.when(new, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_old").isNull(), F.col(f"s_{c}")).otherwise(F.col(c)).alias(c))
    return both.select(*out)


def record_hash(df: DataFrame, exclude: Sequence[str]) -> Column:
    """md5 over the '|'-joined text of all columns but the excluded, in name order; null and '' are alike."""
    kinds = dict(df.dtypes)
    return F.md5(F.concat_ws("|", *[canonical_text(F.col(c), kinds[c]) for c in sorted(df.columns) if c not in exclude]))


def scd2_start(rows: DataFrame, key: Sequence[str], at: str, exclude: Sequence[str] = ()) -> DataFrame:
    """A first load: every row current from ``at``."""
    h = record_hash(rows, [*key, *exclude])
    return rows.select("*", h.alias("record_hash"), F.lit(at).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))


def scd2_merge(target: DataFrame, staged: DataFrame, key: Sequence[str], as_of: str, exclude: Sequence[str] = (), invalidate_missing: bool = False, reopen_reverted: bool = False, dedupe_order: Sequence[str | Column] | None = None) -> DataFrame:
    """The history after a batch: changed current rows are closed at ``as_of``, unseen (key, hash) pairs inserted.

    A value that returns after a change is closed but, because its (key, hash) is known, not inserted again unless
    ``reopen_reverted``. Two values of one key in a batch both become current unless ``dedupe_order`` names the first.
    A null key is an error. ``invalidate_missing`` also closes current rows whose key the batch lacks.
    """
    if not key and invalidate_missing:
        raise ValueError("closing missing rows needs a key")
    at = F.lit(as_of).cast("timestamp")
    if dedupe_order is not None:
        staged = first_of_batch(staged, key, dedupe_order)
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    batch = staged.withColumn("record_hash", F.when(bad, F.raise_error(F.lit("null in an entity key"))).otherwise(record_hash(staged, [*key, *exclude])))
    batch = batch.dropDuplicates([*key, "record_hash"])
    # of a key only the number of its hashes travels; whether a row's own hash is among them is asked by (key, hash)
    counts = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("_values"))
    own = batch.select(*key, "record_hash", F.lit(1).alias("_own"))
    met = target.join(counts, list(key), "left").join(own, [*key, "record_hash"], "left")
    changed = F.col("_values").isNotNull() & (F.col("_values") > F.coalesce("_own", F.lit(0)))
    if invalidate_missing:
        changed = changed | F.col("_values").isNull()
    closed = met.withColumn("valid_to", F.when(F.col("valid_to").isNull() & changed, at).otherwise(F.col("valid_to"))).select(*target.columns)
    known = closed.where("valid_to is null") if reopen_reverted else target
    fresh = batch.join(known.select(*key, "record_hash"), [*key, "record_hash"], "left_anti")
    fresh = fresh.withColumns({"valid_from": at, "valid_to": F.lit(None).cast("timestamp")}).select(*target.columns)
    return closed.unionByName(fresh)


def merge_counts(before: DataFrame, after: DataFrame, staged: DataFrame) -> DataFrame:
    """staged, merged (inserted) and invalidated (closed) rows of a merge, in one row."""
    closed = lambda df: F.sum(F.when(F.col("valid_to").isNotNull(), 1).otherwise(0))
    b = before.agg(F.count(F.lit(1)).alias("n0"), closed(before).alias("c0"))
    a = after.agg(F.count(F.lit(1)).alias("n1"), closed(after).alias("c1"))
    s = staged.agg(F.count(F.lit(1)).alias("staged"))
    # one row each: a join of scalars
    return s.join(F.broadcast(b)).join(F.broadcast(a)).select("staged", (F.col("n1") - F.col("n0")).alias("merged"), (F.col("c1") - F.col("c0")).alias("invalidated"))


def current(df: DataFrame) -> DataFrame:
    return df.where("valid_to is null")


def as_of(df: DataFrame, at: str) -> DataFrame:
    """The versions valid at an instant."""
    t = F.lit(at).cast("timestamp")
    return df.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def align_to_target(df: DataFrame, columns: dict[str, str], on_extra: str = "drop") -> DataFrame:
    """Exactly the target's columns: missing ones null, extra ones dropped (or an error)."""
    extra = sorted(set(df.columns) - set(columns))
    if extra and on_extra == "error":
        raise ValueError(f"columns not in the target: {extra}")
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def sanitize_text(df: DataFrame) -> DataFrame:
    return df.select(*[(sanitize(F.col(c)).alias(c) if t == "string" else F.col(c)) for c, t in df.dtypes])


def staging_select(df: DataFrame, names: dict[str, str], keep: Sequence[str] = (), rest: bool = False) -> DataFrame:
    """Current rows, with columns renamed by map and some passed through. ``rest``: the others come too, under standard names."""
    df = current(df) if "valid_to" in df.columns else df
    others = [F.col(f"`{c}`").alias(standard_name(c)) for c in df.columns if rest and c not in names and c not in keep]
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()], *keep, *others)


def conform(parts: Sequence[DataFrame], catalog: dict[str, str], ingested_at: str) -> DataFrame:
    """Vintages with differing columns as one table: catalog order and types, missing columns null, audit columns last."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cast = [(F.col(c).try_cast(t) if c in whole.columns else F.lit(None).cast(t)).alias(c) for c, t in catalog.items()]
    return whole.select(*cast, F.lit(ingested_at).cast("timestamp").alias("ingested_at"))
