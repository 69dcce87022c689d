"""Raw documents to packed token sequences, in five written stages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.llm import packing, pii, quality, simhash, toxicity
from gramlark.llm.common import table
from gramlark.llm.queries import tokenizer_path
from gramlark.session import stage_root


def _where(docs: DataFrame, keep: Column) -> DataFrame:
    """The rows where ``keep`` holds, worked out once; columns of any name stay as they are."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(whole, keep.alias("keep")).where("keep").select("doc.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic."""
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _where(docs, ~toxicity.predict(docs, chain)["toxic"])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more by the boosted trees."""
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _where(docs, quality.predict(docs, forest)["score"] >= 0.3)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest ``doc_id`` of every group of SimHash fingerprints linked by at most 2 differing bits."""
    return simhash.first_of_groups(docs, width=3, distance=2)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of 4096 tokens."""
    return packing.pack(packing.tokenised_pieces(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("personal data", redact),
    ("packing", pack),
]

# trained classifiers, context scores and a tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{stage_root(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
