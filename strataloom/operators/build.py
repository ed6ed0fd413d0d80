"""The build: chunks to raw graphs (a stateless model map), to sanitized graphs, to upserts of the stored graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom import models
from strataloom.functions import text as tx
from strataloom.operators import ledger
from strataloom.operators import sanitize as sz
from strataloom.session import materialize
from strataloom.sources import chunks as ch
from strataloom.sources.tables import SnapshotTable, keep_first, upsert

RAW = f"doc_id string, document_version int, chunk_pos long, {models.GRAPH}"
NODES = "label string, id string, props map<string,string>, created_at timestamp"
EDGES = "src_label string, src string, type string, dst_label string, dst string, props map<string,string>"


def extract(chunks: DataFrame, client: models.Completer, paper_only: bool = False, attempts: int = models.ATTEMPTS, sleep=None) -> DataFrame:
    """Raw graphs (doc_id, chunk_pos, nodes, relationships, error, attempts) of the eligible chunks (filename, source, source_kind,
    chunk_pos, text). Calls are spread by chunk; write the result before sanitizing, so that no retry repeats them."""
    rows = chunks.where("eligible").withColumn("key", F.concat_ws("\x1f", "filename", F.col("chunk_pos").cast("string")))
    rows = rows.withColumn("prompt", models.extraction_prompt(F.col("text"), F.col("source"), ch.source_format(F.col("source_kind"), F.col("filename")), paper_only))
    more = {} if sleep is None else {"sleep": sleep}
    said = models.ask(rows.repartition("key"), client, "key", "prompt", attempts, **more)
    graph = said.withColumn("g", tx.salvage_json(F.col("reply"), models.GRAPH))
    out = rows.select("key", F.col("filename").alias("doc_id"), "chunk_pos").join(graph, "key")
    failed = F.col("g.nodes").isNull()
    return out.select("doc_id", "chunk_pos", "g.nodes", "g.relationships", F.when(failed, F.coalesce("error", F.lit("no graph in the reply"))).alias("error"), "attempts")


def sanitized(raw: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sanitized (nodes, edges) of raw graphs; ``documents``: doc_id, source_name, source_kind."""
    nodes, edges = sz.explode_graphs(raw.where("nodes is not null").withColumn("relationships", F.coalesce("relationships", F.array().cast(raw.schema["relationships"].dataType))))
    docs = documents.select("doc_id", "source_name", ch.expected_domain(F.col("source_kind")).alias("domain"))
    return sz.sanitize(nodes, edges, docs)


def producer_metadata(documents: DataFrame) -> DataFrame:
    """(id, date_raw, year) of sources whose producer gave a date; it overrules what the text told, unchecked."""
    return documents.where("date is not null").select(tx.canonical_id(F.col("source_name")).alias("id"), F.col("date").alias("date_raw"), F.left("date", F.lit(4)).alias("year"))


def store_nodes(stored: DataFrame, nodes: DataFrame, now: Column) -> DataFrame:
    """Stored nodes after a run: by (label, id), the first writer's properties stay; sources gather what is told of them."""
    first = nodes.groupBy("label", "id").agg(F.min_by("props", F.struct("doc_id", "chunk_pos", "node_pos")).alias("first"), F.max_by("props", F.struct("doc_id", "chunk_pos", "node_pos")).alias("last"))
    new = first.select("label", "id", F.when(F.col("label") == "Source", F.col("last")).otherwise(F.col("first")).alias("props"), now.alias("created_at"))
    merged = lambda was, got, here: F.when(was.isNull(), got).when(here & (F.col("label") == "Source"), F.map_concat(F.map_filter(was, lambda k, v: ~F.array_contains(F.map_keys(got), k)), got)).otherwise(was)
    return upsert(stored, new, ["label", "id"], {"props": merged, "created_at": keep_first})


def store_edges(stored: DataFrame, edges: DataFrame) -> DataFrame:
    """Stored edges after a run: by end and type (upper case), the first writer's properties stay."""
    new = edges.withColumn("type", F.upper("type")).groupBy("src_label", "src", "type", "dst_label", "dst").agg(F.min_by("props", F.struct("doc_id", "chunk_pos", "edge_pos")).alias("props"))
    return upsert(stored, new, ["src_label", "src", "type", "dst_label", "dst"], {"props": keep_first})


def set_properties(stored: DataFrame, told: DataFrame) -> DataFrame:
    """Stored sources with the given keys set (nulls left out); unknown ids are ignored."""
    given = F.map_filter(F.map_from_arrays(F.array(*(F.lit(c) for c in told.columns if c != "id")), F.array(*(F.col(c).cast("string") for c in told.columns if c != "id"))), lambda k, v: v.isNotNull())
    new = told.select("id", F.lit("Source").alias("label"), given.alias("__set"))
    rows = stored.join(new, ["label", "id"], "left")
    props = F.when(F.col("__set").isNotNull(), F.map_concat(F.map_filter("props", lambda k, v: ~F.array_contains(F.map_keys("__set"), k)), "__set")).otherwise(F.col("props"))
    return rows.withColumn("props", props).select(stored.columns)


def chunk_identity(chunks: DataFrame, by_text: bool = True) -> DataFrame:
    """Chunks with chunk_id: the MD5 of the text (equal texts are one chunk, the last one's fields win), or the position."""
    if not by_text:
        return chunks.withColumn("chunk_id", F.md5(F.concat_ws("\x1f", "filename", F.col("document_version").cast("string"), F.col("chunk_pos").cast("string"))))
    nth = F.row_number().over(Window.partitionBy("chunk_id").orderBy(F.desc("filename"), F.desc("chunk_pos")))
    return chunks.withColumn("chunk_id", F.md5("text")).withColumn("nth", nth).where("nth = 1").drop("nth")


def descriptions(nodes: DataFrame) -> DataFrame:
    """(id, source, topic, type, text) of stored description nodes."""
    p = F.col("props")
    return nodes.where("label = 'Description'").select("id", p["source_id"].alias("source"), p["topicName"].alias("topic"), p["typeName"].alias("type"), p["text"].alias("text"))


def extract_resumable(
    chunks: DataFrame, digests: DataFrame, raw: SnapshotTable, progress: SnapshotTable, client: models.Completer, now: Column, waves: int = 8, rebuild: bool = False, **options,
) -> DataFrame:
    """Extract the chunks that aren't done and commit them in ``waves``; returns the raw graphs of all chunks so far.

    ``chunks``: filename, document_version, chunk_pos, chunk_key, eligible, text, source, source_kind; ``digests``: filename,
    document_version, digest. A run that is broken off has lost its last wave only. Chunks that aren't eligible are marked
    done first; of the others only those whose reply held a graph, and only once it is stored. Progress of a document whose
    digest has changed doesn't count. Rules that depend on what came before (slots of sources, near-duplicate topics, first
    metadata) are no state of their own here: they are computed from the stored raw graphs, so a resumed build gives what
    an unbroken one gives. ``rebuild`` forgets all progress of these documents first.
    """
    if rebuild:
        progress.publish(ledger.clear(progress.read(), digests))
    keys = ["filename", "document_version"]
    state = materialize(ledger.split_chunks(chunks, progress.read(), digests), "build-chunks")
    fresh = state.groupBy(*keys).agg(F.bool_or(F.col("todo") == "done").alias("known")).where("not known").select(*keys)
    stale = raw.read().withColumnRenamed("doc_id", "filename").join(fresh, keys, "left_semi")  # of a changed document, or none
    if not stale.isEmpty():
        raw.publish(raw.read().join(fresh.withColumnRenamed("filename", "doc_id"), ["doc_id", "document_version"], "left_anti"))

    def mark(rows: DataFrame) -> None:
        done = rows.join(digests.select(*keys, "digest"), keys).select(*keys, "digest", "chunk_key", now.alias("done_at"))
        progress.publish(ledger.mark_done(progress.read(), done.dropDuplicates([*keys, "chunk_key"])))

    mark(state.where("todo = 'skip'"))
    todo = state.where("todo = 'extract'")
    for k in range(waves):
        some = todo.where(F.pmod(F.xxhash64(*keys, "chunk_key"), F.lit(waves)) == k)
        if some.isEmpty():
            continue
        told = materialize(extract(some, client, **options).where("error is null"), "build-wave")
        versions = some.select(F.col("filename").alias("doc_id"), "document_version", "chunk_pos", "chunk_key").distinct()
        got = materialize(told.join(versions, ["doc_id", "chunk_pos"]), "build-wave")
        raw.publish(upsert(raw.read(), got.select("doc_id", "document_version", "chunk_pos", "nodes", "relationships"), ["doc_id", "document_version", "chunk_pos"]))
        mark(got.withColumnRenamed("doc_id", "filename"))
    return raw.read()


def has_source_counts(edges: DataFrame) -> DataFrame:
    """(doc_id, src, n): sources linked so far by node of a document, which the cap on sources counts."""
    return edges.where(F.lower("type") == "has_source").groupBy("doc_id", "src").agg(F.countDistinct("dst").cast("int").alias("n"))
