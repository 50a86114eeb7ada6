"""A corpus pipeline over ``documents``.

Five stages, in this order. Each works on all that the one before kept, is written
as Parquet to the shared folder and reread as the next one's documents.

1. toxicity: documents that score 0.3 or more are rejected.
2. near_dedup: of every group of near duplicates (five-word shingles, similarity
   0.8) the document with the least id stays.
3. substring_dedup: words covered by 50-word windows that start in a document with a
   smaller id are cut out of the texts; ``n_chars`` follows.
4. mixing: the sources are mixed to their target weights; a document comes as often
   as the mix takes it.
5. sentencepiece: texts are encoded, decoded again and compared; the ids are compared
   with the sentencepiece library's.

SQL cannot express the learnt first stage, so there is no ``ORACLE_SQL``; the stages
are tested against brute force on small fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import mixing, near_dedup, substring_dedup, tokenise, toxicity
from ledgerspark.llm.common import written

REJECT_FROM = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.below(docs, model, REJECT_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = substring_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = tokenise.encode(docs.select("doc_id", "lang", "source", "text"), decoded=False)
    return rows.select("doc_id", "lang", "source", "n_tokens", "n_byte_tokens", "round_trip", "parity", "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode_texts),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
