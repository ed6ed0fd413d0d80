"""A training corpus from documents, in five stages of strataloom.llm.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet in the shared folder and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import line_dedup, mixing, packing, quality, simhash
from strataloom.session import release, settle


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (a score of 0.7 or more).

    Rows are judged one by one, so repeated rows share a fate; null and empty texts get the bias's score; a null id teaches
    nothing. An empty table gives an empty one.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, out="__score").where("__score >= 0.7").drop("__score")


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 20 words or more; those of which no word is left go.

    Null and empty texts stay. Rows that repeat an id and a text are one document and keep their lines; a null id comes
    before all others. An empty table gives an empty one.
    """
    out = line_dedup.dedup_lines(docs, min_words=20).where("n_removed_lines = 0 or text rlike '[^\\\\s]'")
    return out.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies (five-word shingles, similarity 0.8), once.

    A null id comes last. Texts without words link to nothing and stay, repeated rows once. An empty table gives an empty one.
    """
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mixture, with the tokens of four fifths of the input; no document more than twice.

    Null languages and sources count as ''; null and empty texts have no tokens and are taken where the order puts them.
    Repeated rows are taken one by one. An empty table gives an empty one.
    """
    return mixing.mix_sources(docs, mixing.source_domain(), share=0.8, weights=mixing.WEIGHTS, max_epochs=2).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens. Null and empty texts are an end id alone, every row is packed, a null id stays null."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good_quality), ("lines", fresh_lines), ("near_copies", one_of_each), ("mixing", mixed), ("packing", packed)]

#: No stage but mixing is within SQL's reach; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage wrote on its way is deleted once its result is written, and its input too."""
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(spark, lambda stage=stage, docs=before: stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
