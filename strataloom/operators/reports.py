"""Small reports over what is stored: names, communities, queues, claims, outcomes and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filenames(chunks: DataFrame) -> DataFrame:
    """Distinct file names, in order."""
    return chunks.where("filename is not null").select("filename").distinct().orderBy("filename")


def community_count(metrics: DataFrame, kind: str = "leiden") -> DataFrame:
    """One row: the number of distinct communities, exact; nodes without one don't count."""
    return metrics.agg(F.countDistinct(f"community_{kind}").alias("n_communities"))


def stored_value(graph_metrics: DataFrame, name: str) -> float | None:
    """A stored measure of the graph by name, None if it was never stored."""
    row = graph_metrics.where(F.col("name") == name).select("value").first()
    return row[0] if row else None


def queue_counts(pending: DataFrame) -> DataFrame:
    """Pending uploads by kind."""
    return pending.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"))


def description_checks(descriptions: DataFrame, most: int = 20) -> DataFrame:
    """Topics and types with several descriptions: how many and from how many sources, the fullest ``most`` of them."""
    n = descriptions.where("topic is not null and type is not null").groupBy("topic", "type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source").alias("n_sources"))
    return n.where("n > 1").orderBy(F.desc("n"), "topic", "type").limit(most)


def outcome_stats(records: DataFrame) -> DataFrame:
    """Clusters by outcome, with how many came from the cache."""
    return records.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cached")).alias("n_cached"))


def skipped_chunks(chunks: DataFrame) -> DataFrame:
    """Per document: chunks, and those that extraction skips."""
    return chunks.groupBy("filename").agg(F.count(F.lit(1)).alias("n_chunks"), F.count_if(~F.coalesce(F.col("eligible"), F.lit(True))).alias("n_skipped"))


def ledger_listing(ledger: DataFrame) -> DataFrame:
    """Built documents, the latest first."""
    return ledger.select("doc_id", "doc_type", "source_file", "n_chunks", "built_at").orderBy(F.desc("built_at"), "doc_id")


def progress_listing(progress: DataFrame) -> DataFrame:
    """Per document in progress: chunks done, and when the last one was."""
    return progress.groupBy("filename", "document_version").agg(F.count(F.lit(1)).alias("n_done"), F.max("done_at").alias("last_done")).orderBy("filename", "document_version")


def adjacency(edges: DataFrame) -> DataFrame:
    """(src, targets): of each node with edges out the map from targets to edge type; of parallel edges the last type."""
    one = edges.groupBy("src", "dst").agg(F.max("type").alias("type"))
    return one.groupBy("src").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("dst", "type")))).alias("targets"))


def from_adjacency(rows: DataFrame) -> DataFrame:
    """(src, dst, type) of adjacency rows."""
    return rows.select("src", F.explode("targets").alias("dst", "type"))


def known_relationships(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends are both among the nodes."""
    ids = nodes.select("id").distinct()
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def smoke(spark) -> DataFrame:
    """One row, 1, from an executor: the engine answers."""
    return spark.range(1).select((F.col("id") + 1).alias("ok"))
