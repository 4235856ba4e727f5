"""A corpus from raw documents to packed sequences, in stages that each call one operator of ``kestrel.llm``.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame that is written as Parquet and read again as the next one's
docs.  All but the last return the columns of ``documents``.  ``n_chars`` follows
the text where a stage changes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import chained_passages, compression_quality, packing, pareto_mix, simhash
from kestrel.llm.common import table
from kestrel.llm.queries import tokenizer
from kestrel.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    return compression_quality.keep_good(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")), 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that another document keeps."""
    cut = chained_passages.cut_passages(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return pareto_mix.repeat_rows(docs, weights=(5, 2, 1), share=1.5, max_copies=2)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of at most 4096 tokens."""
    return packing.pack(packing.token_pieces(docs, tokenizer("word_bpe_49k.json"), 4096, 1), 4096)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mixture", mixture), ("sequences", sequences)]

#: Compressed sizes, XXH64 fingerprints and token ids have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written under the checkpoint folder, which executors share."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
