"""A training corpus from raw documents: good texts, each once, mixed to weights and packed into sequences.

Each stage takes the session, the documents its predecessor kept, and the folder of the input tables. All but the last
return the columns of ``documents``; the last returns the pieces of the packed sequences with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from vitalgauge.llm.common import table
from vitalgauge.llm.exact_dedup import DigestIndex, first_of_equal_texts
from vitalgauge.llm.mixing import mixed_documents
from vitalgauge.llm.packing import packed_pieces
from vitalgauge.llm.quality import fit_quality, good_documents
from vitalgauge.llm.simhash import one_of_each_group
from vitalgauge.sources.shared import share, use_local_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, which learns from the labels of these documents, takes for good."""
    return good_documents(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id; against a new index, as the corpus starts here."""
    return first_of_equal_texts(docs, DigestIndex.open(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints hang together the one with the smallest id."""
    return one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    return packed_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_words=False)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

#: Compression, fingerprints and tokens are beyond SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next."""
    use_local_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = share(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
