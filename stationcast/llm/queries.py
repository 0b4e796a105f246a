"""The training-data queries: each applies one operator, with production
parameters, to its whole table; ORACLE holds DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationcast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.secrets import digest
    return digest(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from stationcast.llm.token_counts import digest
    return digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.quality import digest
    return digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.language_id import digest
    return digest(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.line_dedup import digest
    return digest(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.mixing import digest
    return digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.fingerprints import digest
    return digest(table(spark, sf_dir, "documents"))


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.repeats import digest
    return digest(table(spark, sf_dir, "documents"))


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.near_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.decontamination import digest
    return digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.parity_join import jaccard_classes
    return jaccard_classes(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.prefix_trie import trie
    return trie(table(spark, sf_dir, "conversations"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationcast.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))


def _oracles() -> None:
    from stationcast.llm import decontamination, line_dedup, mixing, prefix_trie
    ORACLE.update(op12_prefix_trie=prefix_trie.ORACLE_SQL, op2_line_dedup=line_dedup.ORACLE_SQL, op8_mixing=mixing.ORACLE_SQL, op9_decontamination=decontamination.ORACLE_SQL)


_oracles()
