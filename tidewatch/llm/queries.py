"""One query for each corpus operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, licenses, materialise, packing, secrets, sharding, simhash, substrings, toxicity, vectors
from tidewatch.llm.common import fewer_files
from tidewatch.llm.oracles import ORACLES

#: Where the vocabulary of op8 is; it travels to the executors with the tasks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), [1.0] * 8)


def op8_materialise(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """With the public vocabulary in the file ``vocabulary``, which the driver reads; without it this fails."""
    return materialise.materialise(_table(spark, sf_dir, "documents"), materialise.RankTokenizer.from_file(vocabulary))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def _named(operator: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    # shards are wide rows
    return operator if operator is op8_materialise else lambda spark, sf_dir: fewer_files(operator(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _named(f) for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
