"""Structural edges between chunks, documents and nodes, and counts over the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def part_of(chunks: DataFrame, documents: DataFrame, keys=("filename", "document_version")) -> DataFrame:
    return chunks.join(documents.select(*keys), [*keys]).select("chunk_id", *keys)


def next_edges(chunks: DataFrame, keys, position: str = "chunk_pos", ident: str = "chunk_id") -> DataFrame:
    """(src, dst) where dst's position is src's plus one in the same document. Repeated positions link to every match."""
    a = chunks.where(F.col(position).isNotNull()).select(*keys, F.col(position).alias("p"), F.col(ident).alias("src"))
    b = chunks.where(F.col(position).isNotNull()).select(*keys, (F.col(position) - 1).alias("p"), F.col(ident).alias("dst"))
    return a.join(b, [*keys, "p"]).select(*keys, "src", "dst")


def mentions(chunk_nodes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(chunk_id, label, id) of the nodes with an id that a chunk named, operational labels left out."""
    known = nodes.where(~F.col("label").isin("Chunk", "Document")).select("id", "label")
    return chunk_nodes.select("chunk_id", "id").distinct().join(known, "id").select("chunk_id", "label", "id").distinct()


def precedes(documents: DataFrame, series: str, date: str, ident: str, existing: DataFrame | None = None) -> DataFrame:
    """(src, dst) from each document of a series to the next by date (ties by id); ``existing`` edges stay as well."""
    ahead = F.lead(ident).over(Window.partitionBy(series).orderBy(date, ident))
    out = documents.where(F.col(series).isNotNull() & F.col(date).isNotNull()).select(F.col(ident).alias("src"), ahead.alias("dst")).where("dst is not null")
    return out if existing is None else out.union(existing.select("src", "dst")).distinct()


def singletons(nodes: DataFrame, edges: DataFrame, ident: str, least: int = 2) -> DataFrame:
    """Nodes with fewer than ``least`` distinct edges, those with none included."""
    n = edges.select(ident, "other").distinct().groupBy(ident).agg(F.count(F.lit(1)).alias("n"))
    return nodes.select(ident).join(n, ident, "left").select(ident, F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") < least)


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """n_nodes, n_labels, n_edges, n_edge_types, and the edges as an undirected pattern sees them (loops once)."""
    n = nodes.agg(F.count(F.lit(1)).alias("n_nodes"), F.countDistinct("label").alias("n_labels"))
    e = edges.agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("type").alias("n_edge_types"), F.sum(F.when((F.col("src") == F.col("dst")) & (F.col("src_label") == F.col("dst_label")), 1).otherwise(2)).alias("n_edges_undirected"))
    return n.crossJoin(e)  # one row each


def untyped(topics: DataFrame, typed: DataFrame, key: str) -> DataFrame:
    """total, untyped and percent of topics without a type edge."""
    rows = topics.select(key).join(typed.select(key).distinct().withColumn("has", F.lit(1)), key, "left")
    total, none = F.count(F.lit(1)), F.count_if(F.col("has").isNull())
    return rows.agg(total.alias("total"), none.alias("untyped"), F.when(total > 0, 100.0 * none / total).otherwise(0.0).alias("percent"))


def simple_digraph(edges: DataFrame, order: Column | None = None) -> DataFrame:
    """One edge for each ordered pair of nodes; of parallel edges the last in ``order`` (type, if not given) stays."""
    by = F.col("type") if order is None else order
    return edges.groupBy("src", "dst").agg(F.max_by("type", by).alias("type"))


def first_metadata(sources: DataFrame, doc: str, order: list[str], columns: list[str]) -> DataFrame:
    """Per document the first non-null value of each column, in order."""
    pos = F.struct(*order)
    return sources.groupBy(doc).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), pos)).alias(c) for c in columns))


def stamp_created(old: DataFrame | None, new: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """``new`` with created_at: the stored one if there is one."""
    if old is None:
        return new.withColumn("created_at", now)
    kept = old.select(*keys, F.col("created_at").alias("__old"))
    return new.join(kept, keys, "left").withColumn("created_at", F.coalesce("__old", now)).drop("__old")
