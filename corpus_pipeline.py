"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; what it returns is written as Parquet and read again as
the next one's documents. All but the last return the columns of documents.

1. toxicity: documents whose toxicity score is at least 0.7 go.
2. language: documents without a letter, or whose language stays unclear, go.
3. near duplicates: one document of each class stays.
4. mixing: sources are mixed to their target shares; a document that is
   taken twice is there twice, one that is taken in part has that part.
5. packing: pieces of sequences of 2048 tokens.

The models of the first two stages are learned from the documents that the
stage is given and the labels, lang included. Edge cases are those of the
operators; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import langid, mixing, neardup, packing, toxicity
from lakeward.llm.common import fresh_path, table, take

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: How far a document's best language must be above the next one, in one-versus-rest scores (-1 to 1).
LEAST_LANGUAGE_MARGIN = 0.05


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = take(docs, *COLUMNS)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_unclear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = take(docs, *COLUMNS)
    return langid.keep_known(docs, langid.learn(docs), LEAST_LANGUAGE_MARGIN)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unclear_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the learned stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = fresh_path(spark, f"stage-{number}-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
