"""The corpus pipeline: quality rules, language identification, near duplicates, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that ``run`` writes as Parquet to the shared folder and
reads again for the next. All but the last return the columns of documents. Nulls, empty texts, repeated rows and
empty tables have the results that the operators state: documents without words fail the quality rules, texts
without a sure language are rejected, and of near duplicates the smallest doc_id stays.
"""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import bpe, language_id, mixing, near_dup, quality_rules
from siltworks.session import stored

#: A text of which no language has this share is rejected.
LEAST_SHARE = 0.5
#: Words of a shingle, and the similarity in percent from which documents are near duplicates.
SHINGLE, SIMILAR = 5, 80
WEIGHTS = (5, 2, 1)
#: No stage's result can be written as SQL: sketches, a learned model, MinHash and a vocabulary decide.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is learned from all labelled documents that are left."""
    model = language_id.collect_model(language_id.learn(docs))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    found = language_id.identify(whole, model, text="doc.text")
    return found.filter(~language_id.unsure(LEAST_SHARE)).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs, width=SHINGLE, percent=SIMILAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the sources' weights are those of the numbered query."""
    return mixing.mix(docs, WEIGHTS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each copy, and the digest of the text that they decode to."""
    path = importlib.import_module("public_tokenizers").path("word_bpe_49k.json")
    # Stored, so that a task has one Python worker and not one for each direction.
    encoded = stored(bpe.encode(docs, path, keep=["doc_id", "lang", "source"]), "encoded")
    tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return bpe.decode(encoded, path).select("doc_id", "lang", "source", tokens, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("language identification", language),
    ("near duplicates", near_duplicates),
    ("mixing", mixture),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
