"""A corpus made ready for training, in five stages.

Each stage works on what the one before has kept: documents in no known language go, one document of each group of
near-duplicates stays, passages that an earlier document has too are cut out, sources are mixed to their weights (documents
may then come several times), and what is left is packed into sequences. Stages are written to the shared folder
and read again, so a lost executor costs at most the stage it worked on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import chaining, langid, mixing, packing, simhash
from millrace.llm.queries import TOKENIZER
from millrace.session import load
from millrace.sources.staging import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.in_a_language(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs, width=3, scan=True)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chaining.without_shared(docs, scan=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs, weights=[5, 2, 1], epochs=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), size=1024, added=True)


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("substring_dedup", substring_dedup),
          ("mix_sources", mix_sources), ("pack", pack)]

#: SQL can say none of the first three stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that stay."""
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
