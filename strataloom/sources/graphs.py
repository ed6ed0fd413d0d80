"""Graphs as files, and chunk files of other producers for benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.functions import text as tx

GRAPH = "method string, doc string, nodes array<struct<id:string,type:string>>, relationships array<struct<source:string,target:string,type:string,properties:map<string,string>>>"
NATIVE = "text string, index long, chunk_index long, doc_id string, source_path string"


def dump(nodes: DataFrame, edges: DataFrame, method: str, path: str) -> None:
    """One JSON object per document: nodes (doc_id, id, label) and edges (doc_id, src, dst, type, props)."""
    n = nodes.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("id", F.col("label").alias("type")))).alias("nodes"))
    r = edges.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), "type", F.col("props").alias("properties"))).alias("relationships"))
    n.join(r, "doc_id", "left").select(F.lit(method).alias("method"), F.col("doc_id").alias("doc"), "nodes", "relationships").write.json(path)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of dumped graphs, ids in canonical form, relation of relates_to edges beside the type."""
    g = spark.read.schema(GRAPH).option("multiLine", False).json(path)
    nodes = g.select("method", "doc", F.explode("nodes").alias("n")).select("method", "doc", tx.canonical_id(F.col("n.id")).alias("id"), F.col("n.type").alias("label"))
    r = g.select("method", "doc", F.explode("relationships").alias("r"))
    edges = r.select("method", "doc", tx.canonical_id(F.col("r.source")).alias("src"), tx.canonical_id(F.col("r.target")).alias("dst"), "r.type", F.coalesce(F.col("r.properties")["relation"], F.lower("r.type")).alias("relation"))
    return nodes, edges


def native_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, index, text) of .jsonl files and of .json files with a chunks array, markup stripped and short ones left out.

    The index is index, else chunk_index, else the position in the file.
    """
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = whole.where("file like '%.jsonl'").select("file", F.posexplode(F.split("value", "\r?\n")).alias("at", "line")).where(F.trim("line") != "").select("file", "at", F.from_json("line", NATIVE).alias("c"))
    packed = whole.where("file like '%.json'").select("file", F.posexplode(F.from_json("value", f"chunks array<struct<{NATIVE.replace(' string', ':string').replace(' long', ':long')}>>")["chunks"]).alias("at", "c"))
    rows = lines.unionByName(packed)
    place = F.row_number().over(Window.partitionBy("file").orderBy("at")) - 1
    out = rows.select("file", F.coalesce("c.index", "c.chunk_index", place.cast("long")).alias("index"), tx.strip_markup(F.col("c.text")).alias("text"))
    return out.where(F.length("text") >= 15)
