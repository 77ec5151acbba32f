"""From raw documents to packed training sequences in five stages.

Each stage takes the documents that the one before it kept, written as Parquet and read again; all but the
last return the columns of ``documents``:

1. language: documents without a letter, or far less likely in their language than its own texts are, go;
2. exact: of texts equal but for ASCII blanks the one with most code points (then smallest doc_id) stays;
3. near: of every class of near-duplicates (weighted Jaccard similarity of five-word shingles of 0.8 or
   more) one document stays;
4. mix: documents are taken as often as the mix of sources to target weights takes their words;
5. pack: sequences of at most 4096 tokens, one row per piece of a document.

Null texts go in the first stage (which keeps everything where no row has a language to learn from); null sources are a source of their own; ties and repeated rows are settled
as the operators' docstrings say; an empty table passes every stage; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skytally.llm import common
from skytally.llm.op1_dartminhash import keep_one_of_each
from skytally.llm.op2_mixing import mixed_documents
from skytally.llm.op6_packing import packed_documents
from skytally.llm.op7_language import keep_identified
from skytally.llm.op10_exact_dedup import keep_first


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(spark, docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: SQL can't express language identification, signatures' classes or tokenizing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        before = common.scratch_mark()
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.materialize(docs, f"pipeline-{name}")
            # what the stage wrote on the way, and what it read, is no longer needed
            common.drop_scratch(spark, max(0, before - (k > 0)), (f"pipeline-{name}",))
    return docs
