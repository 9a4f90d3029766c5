"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.byte_bpe import round_trip
from geoloom.llm.exact_dedup import ORACLE as EXACT_SQL
from geoloom.llm.exact_dedup import exact_dedup
from geoloom.llm.hard_negatives import ORACLE as NEGATIVES_SQL
from geoloom.llm.hard_negatives import hard_negatives
from geoloom.llm.license_scan import license_scan
from geoloom.llm.lm_score import lm_score
from geoloom.llm.mixing import ORACLE as MIXING_SQL
from geoloom.llm.mixing import mix_plan
from geoloom.llm.near_dedup import ORACLE as NEAR_SQL
from geoloom.llm.near_dedup import near_dedup
from geoloom.llm.packing import pack
from geoloom.llm.prefix_trie import ORACLE as TRIE_SQL
from geoloom.llm.prefix_trie import conversation_trie
from geoloom.llm.substring_dedup import ORACLE as SUBSTRING_SQL
from geoloom.llm.substring_dedup import substring_dedup
from geoloom.llm.token_counts import token_counts
from geoloom.llm.toxicity import fit, toxicity
from geoloom.llm.vector_topk import ORACLE as TOPK_SQL
from geoloom.llm.vector_topk import vector_topk
from geoloom.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, _table(spark, sf_dir, "labels")))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


def op9_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk(_table(spark, sf_dir, "embeddings"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_token_counts, op2_license_scan, op3_exact_dedup, op4_packing, op5_toxicity, op6_byte_bpe, op7_lm_score, op8_substring_dedup, op9_vector_topk, op10_near_dedup, op11_prefix_trie, op12_hard_negatives, op13_mixing)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": EXACT_SQL, "op8_substring_dedup": SUBSTRING_SQL, "op9_vector_topk": TOPK_SQL, "op10_near_dedup": NEAR_SQL, "op11_prefix_trie": TRIE_SQL, "op12_hard_negatives": NEGATIVES_SQL, "op13_mixing": MIXING_SQL}
