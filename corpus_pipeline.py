"""The corpus pipeline: toxicity, exact copies, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.exact_dedup import exact_dedup
from geoloom.llm.near_dedup import near_dedup
from geoloom.llm.packing import pack
from geoloom.llm.substring_dedup import remove_repeats
from geoloom.llm.toxicity import fit, toxicity
from geoloom.operators.order import numbered
from geoloom.session import ship_package, stage


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def _numbered(docs: DataFrame, many: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart: the doc_id, or a row number where ids repeat or are missing."""
    row = _free(docs, "row")
    if many.isEmpty():
        return docs.withColumn(row, F.col("doc_id").cast("long")), row
    return stage(docs.withColumn(row, F.monotonically_increasing_id())), row


def _repeated(docs: DataFrame) -> DataFrame:
    """doc_ids of several rows, and null."""
    return stage(docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias("many")))


def _without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose number is not in ``gone`` (num)."""
    gone = stage(gone.distinct())
    return docs.join(gone, docs[row] == gone.num, "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. The model learns from labelled documents among ``docs``.

    A null or empty text has a score like any other. Rows that repeat an id, or have none, are decided one by
    one. Other columns come back as they were, whatever their names; an empty table stays empty.
    """
    ship_package(spark)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    docs, row = _numbered(docs, _repeated(docs))
    return _without(docs, row, toxicity(docs, model, carry=row).where("predicted = 1").select(F.col(row).alias("num")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row with the largest doc_id stays (a null id is smaller than any)."""
    ship_package(spark)
    docs, row = _numbered(docs, _repeated(docs))
    return _without(docs, row, exact_dedup(docs, carry=row).where("not kept").select(F.col(row).alias("num")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays; rows whose id repeats or is missing
    come after all others."""
    ship_package(spark)
    many = _repeated(docs)
    docs, row = _numbered(docs, many)
    if not many.isEmpty():
        # places in the order of ids, not sums of ids: they fit whatever the ids are
        docs = docs.withColumnRenamed(row, _free(docs, "was"))
        was = docs.columns[-1]
        plain = many.where("many is not null")
        ids = docs.select(F.col("doc_id").cast("long").alias("of"), F.col(was).alias("num"))
        late = F.col("of").isNull() | F.col("many").isNotNull()
        ids = ids.join(plain.select(F.col("many").cast("long").alias("many")), F.col("of") == F.col("many"), "left").select("num", late.alias("late"), "of")
        ids = stage(numbered(ids, ["late", F.col("of").asc_nulls_last(), "num"]).select("num", "at"))
        docs = stage(docs.join(ids, docs[was] == ids.num).select(*[docs[c] for c in docs.columns if c != was], ids["at"].alias(row)))
    decided = near_dedup(docs.select(F.col(row).alias("doc_id"), "text"))
    return _without(docs, row, decided.where("not kept").select(F.col("doc_id").alias("num")))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document with a smaller id has go; untouched texts stay as they are.

    A null text has no words and stays null. Rows that repeat an id and a text are cut alike. A cut text has its words
    joined by one space, and n_chars follows it; other columns come back as they were. An empty table stays empty.
    """
    ship_package(spark)
    cut = remove_repeats(docs).where("n_removed > 0").select(F.col("doc_id").alias("cut_id"), F.col("mark").alias("cut_mark"), F.col("kept_text").alias("cut_text"))
    cut = stage(cut.dropDuplicates(["cut_id", "cut_mark"]))
    columns = docs.columns
    joined = docs.join(cut, (docs.doc_id == cut.cut_id) & (F.xxhash64(docs.text.cast("string")) == cut.cut_mark), "left")
    was = cut.cut_id.isNotNull()
    changed = {"text": F.when(was, cut.cut_text).otherwise(docs.text)}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(was, F.length(cut.cut_text).cast(docs.schema["n_chars"].dataType)).otherwise(docs.n_chars)
    return joined.select(*[changed[c].alias(c) if c in changed else docs[c] for c in columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left: rows as :func:`geoloom.llm.packing.pack` gives them, not documents.

    A null text is packed as an empty one. Rows that repeat an id are packed one by one; an empty table gives no rows.
    """
    ship_package(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack_documents),
]

#: Learned scores and tokenizers are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
