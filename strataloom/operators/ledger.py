"""Which documents are built, which chunks of a document are done, and the state of uploads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.sources.tables import keep_first, upsert

LEDGER = "doc_id string, digest string, doc_type string, source_file string, n_chunks long, built_at timestamp"
PROGRESS = "filename string, document_version int, digest string, chunk_key string, done_at timestamp"
STATE = "filename string, document_version int, digest string, has_source map<string,int>, topics map<string,string>, source_meta map<string,map<string,string>>"
UPLOADS = "id long, doc_type string, doc_id string, owner string, storage_path string, sha256 string, n_chunks long, status string, error string, uploaded_at timestamp, downloaded_at timestamp, built_at timestamp"


def content_digest(chunks: DataFrame, keys: list[str], ident: str, text: str) -> DataFrame:
    """SHA-256 over (id NUL text NUL) of a document's chunks, sorted by id as text."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(ident).cast("string").alias("i"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(parts, lambda p: F.concat(p["i"], F.lit("\0"), p["t"], F.lit("\0"))), "")
    return chunks.groupBy(*keys).agg(F.sha2(joined, 256).alias("digest"), F.count(F.lit(1)).alias("n_chunks"))


def pending(digests: DataFrame, ledger: DataFrame, rebuild: bool = False, limit: int | None = None, order: tuple = ("doc_id",)) -> DataFrame:
    """Documents whose (doc_id, digest) isn't recorded; all of them on a rebuild."""
    out = digests if rebuild else digests.join(ledger.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti")
    return out.orderBy(*order).limit(limit) if limit is not None else out


def stale(ledger: DataFrame, stored: DataFrame) -> DataFrame:
    """Entries whose document isn't in the graph."""
    return ledger.join(stored.select("doc_id").distinct(), "doc_id", "left_anti")


def reconciled(ledger: DataFrame, stored: DataFrame) -> DataFrame:
    return ledger.join(stored.select("doc_id").distinct(), "doc_id", "left_semi")


def record(ledger: DataFrame, built: DataFrame) -> DataFrame:
    return upsert(ledger, built, ["doc_id"])


def lookup(ledger: DataFrame, ids: DataFrame) -> DataFrame:
    """The entries of some documents."""
    return ledger.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")


def forget(ledger: DataFrame, ids: DataFrame) -> DataFrame:
    return ledger.join(ids.select("doc_id").distinct(), "doc_id", "left_anti")


def split_chunks(chunks: DataFrame, progress: DataFrame, digests: DataFrame) -> DataFrame:
    """Chunks with ``todo``: done, skip (not eligible) or extract. Progress counts only while the digest is the same, or
    either digest is empty."""
    same = (F.col("p.digest") == F.col("d.digest")) | (F.coalesce(F.col("p.digest"), F.lit("")) == "") | (F.coalesce(F.col("d.digest"), F.lit("")) == "")
    keys = ["filename", "document_version"]
    valid = progress.alias("p").join(digests.alias("d"), keys).where(same).select(*keys, "p.chunk_key").distinct().withColumn("done", F.lit(True))
    out = chunks.join(valid, [*keys, "chunk_key"], "left")
    return out.withColumn("todo", F.when(F.col("done"), "done").when(F.col("eligible"), "extract").otherwise("skip")).drop("done")


def mark_done(progress: DataFrame, done: DataFrame) -> DataFrame:
    return upsert(progress, done, ["filename", "document_version", "chunk_key"], {"done_at": keep_first})


def clear(progress: DataFrame, documents: DataFrame) -> DataFrame:
    return progress.join(documents.select("filename", "document_version").distinct(), ["filename", "document_version"], "left_anti")


def uploads_pending(uploads: DataFrame, limit: int | None = None) -> DataFrame:
    """The oldest pending uploads of both queues: each queue's oldest, then the oldest of those. Without a limit all, unsorted."""
    ready = uploads.where("status = 'pending'")
    if limit is None:
        return ready.where(F.col("doc_type").isin("paper", "meeting"))
    each = [ready.where(F.col("doc_type") == kind).orderBy("uploaded_at", "id").limit(limit) for kind in ("paper", "meeting")]
    return each[0].unionByName(each[1]).orderBy("uploaded_at", "id").limit(limit)


def transition(uploads: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Apply outcomes (id, status, error): pending becomes downloaded or failed, and only downloaded becomes built.

    Outcomes are never broadcast: with their errors they may be a thousand times what their plan's size says.
    """
    new = outcomes.select("id", F.col("status").alias("__to"), F.left(F.col("error"), F.lit(4000)).alias("__error")).hint("merge")
    rows = uploads.join(new, "id", "left")
    to = F.col("__to")
    ok = to.isNotNull() & F.when(to == "built", F.col("status") == "downloaded").otherwise(F.col("status") == "pending")
    stamp = lambda c, s: F.when(ok & (to == s), now).otherwise(F.col(c)).alias(c)
    changed = {"downloaded_at": stamp("downloaded_at", "downloaded"), "built_at": stamp("built_at", "built"), "status": F.when(ok, to).otherwise(F.col("status")).alias("status")}
    changed["error"] = F.when(ok, F.col("__error")).otherwise(F.col("error")).alias("error")
    return rows.select(*(changed.get(c, F.col(c)) for c in uploads.columns))


def new_uploads(uploads: DataFrame, offered: DataFrame) -> DataFrame:
    """Offered rows that aren't in the manifest yet, once each."""
    key = ["doc_type", "doc_id", "sha256"]
    return offered.dropDuplicates(key).join(uploads.select(*key), key, "left_anti")
