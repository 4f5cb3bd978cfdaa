"""The corpus pipeline: documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.functions.names import column
from stratalake.llm import jaccard, packing, substrings, toxicity
from stratalake.llm.common import bounded_batches, written
from stratalake.operators.dedup import unorderable


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from the labels of the documents given. A null or
    empty text is scored like any other; repeated rows stay or go together."""
    bounded_batches(spark)
    model = toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.toxicity(model, F.col("text")) < toxicity.THRESHOLD)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest id; documents without an id all stay. Rows that share an id are one
    document: each of its texts (null and empty ones too) stays once, like or unlike, in the row with the least values of the
    other columns, maps and other values without an order by their JSON."""
    kept = jaccard.components(docs).filter("doc_id = component_id").select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi")
    order = [F.to_json(column(c)) if unorderable(docs.schema[c].dataType) else column(c) for c in others]
    least = F.min_by(F.struct(*map(column, others)), F.struct(*order)) if others else F.lit(None)
    once = own.groupBy("doc_id", "text").agg(least.alias("least"))
    once = once.select("doc_id", "text", *(F.col("least").getField(c).alias(c) for c in others))
    return once.unionByName(docs.filter("doc_id is null")).select(*map(column, docs.columns))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has; ``n_chars`` is that of the text left. Null and
    empty texts stay as they are; rows without an id and repeated rows are treated as ``drop_repeated_passages`` says."""
    bounded_batches(spark)
    left = substrings.drop_repeated_passages(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents that are left; a null or empty text is one token, repeated rows are packed each."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", keep_harmless),
    ("near-duplicates", keep_one_of_each_group),
    ("substrings", cut_repeated_passages),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
