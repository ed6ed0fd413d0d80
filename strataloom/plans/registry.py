"""The register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its oracle SQL if it has one."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paper_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chunks: a source is a document, its rows in id order are its chunks."""
    pos = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    return table(spark, sf_dir, "documents").select(F.col("source").alias("filename"), F.lit(1).alias("document_version"), pos.cast("long").alias("chunk_pos"), F.col("doc_id").alias("chunk_id"), "text", "lang")


def meeting_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chunks, each turn tagged with its role."""
    said = F.concat(F.lit("["), "role", F.lit("] "), "text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", said.alias("text"))


PAPER_SQL = "select source as filename, 1 as document_version, row_number() over (partition by source order by doc_id) - 1 as chunk_pos, doc_id as chunk_id, text, lang from documents"
MEETING_SQL = "select conv_id, turn, role, '[' || role || '] ' || text as text from conversations"
SPACE = r"[\t-\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
