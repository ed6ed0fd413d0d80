"""Queries and oracle SQL of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from strataloom.llm import exact_dedup, line_dedup, media, mixing, neighbours, packing, quality, simhash, token_counts, warc
from strataloom.session import materialize


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.digest(table(spark, sf_dir, "documents"))


def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_media(spark, sf_dir):
    stored = materialize(media.encode_media(table(spark, sf_dir, "documents")), "media")
    return media.read_media(stored)


def op6_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op7_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op1_warc": op1_warc, "op2_exact_dedup": op2_exact_dedup, "op3_simhash": op3_simhash, "op4_mixing": op4_mixing, "op5_media": op5_media, "op6_neighbours": op6_neighbours, "op7_quality": op7_quality, "op8_packing": op8_packing, "op9_line_dedup": op9_line_dedup, "op10_token_counts": op10_token_counts}
ORACLE: dict[str, str] = {"op1_warc": warc.SQL, "op4_mixing": mixing.SQL}
