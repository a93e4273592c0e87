"""A training-data pipeline: quality rules, line dedup, near-dedup, mixing, BPE ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of docs. Line dedup edits texts (and n_chars) and keeps
every row; the near-dedup stage takes shingles of five words and keeps one
document of each group; mixing repeats or leaves out rows to meet the target
weights; the last stage has a row of ids for each row that is left.

Defined cases: a null or empty text has no words, so the quality rules drop it;
what line dedup empties later stays as an empty text with no ids; of equal rows
and of rows in one near-dedup group one stays, the smallest id, and two unlike
texts under one id both stay; rows without an id pass near-dedup whole; a null
source is a source; very long texts go
through whole; empty documents give empty results at every stage; other columns
are kept up to mixing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, line_dedup, minhash, mixing, quality
from weftline.llm.common import table
from weftline.llm.queries import vocabulary
from weftline.scratch import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy rejects go."""
    return quality.filter_docs(docs, quality.STANDARD)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines go from all texts but the first; every row stays."""
    out = line_dedup.dedup(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_one(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources meet their target weights."""
    return mixing.emit(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every row that is left."""
    return bpe.encode(docs.select("doc_id", "source", "text"), vocabulary("word_bpe_49k.json")).select("doc_id", "source", F.col("bpe_n").alias("n_tokens"), F.col("bpe_ids").alias("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("minhash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("bpe", encode_bpe),
]

#: Near-duplicate components and BPE ids have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage-" + name.replace(" ", "-"))
    return docs
