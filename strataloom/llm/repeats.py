"""Shared by the exact dedups: find later copies of keyed runs over the whole corpus, and bring spans back to documents.

A document is a distinct (doc_id, CRC-32 of its text); rows that repeat both are one document with one result. A place
is (doc_id, crc, start), and a run is a later copy when an equal run stands at a smaller place.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.blocks import fresh
from strataloom.session import bound_batches

NO_ID = -(2**63)  # stands for a null doc_id; sorts first
SPANS = "doc_id long, crc long, spans binary"


def keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """doc_id (long, no nulls), crc and the text's UTF-8 bytes (null: empty)."""
    bound_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.crc32(body).alias("crc"), body.alias("text"))


def crc_of(text: bytes) -> int:
    return zlib.crc32(text)


def volume(docs: DataFrame, text: str) -> int:
    """Bytes of all texts; sizes shards so that each fits a task."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def free_shuffles(df: DataFrame) -> None:
    """Let Spark drop the shuffle files of queries whose results are written."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def order_runs(k1, k2, doc, crc, start) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key and place, index within the order of each run's first, later-copy flag), all in sorted order."""
    order = np.lexsort((start, crc, doc, k2, k1))
    a, b = k1[order], k2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    d, c, s = doc[order], crc[order], start[order]
    return order, first, (d != d[first]) | (c != c[first]) | (s != s[first])


def span_rows(doc, crc, start, end) -> Iterator[pa.RecordBatch]:
    """One row per document: its spans [start, end) as pairs of unsigned 32-bit numbers, touching ones merged."""
    if not len(doc):
        return
    order = np.lexsort((start, crc, doc))
    d, c, s, e = doc[order], crc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (c[1:] != c[:-1])
    block = np.cumsum(new) - 1
    lift = block * (1 << 40)  # documents never touch each other
    reach = np.maximum.accumulate(e + lift)
    head = np.ones(len(d), bool)
    head[1:] = (s + lift)[1:] > reach[:-1]
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(d)) - 1
    pairs = np.stack([s[at], reach[last] - lift[last]], axis=1).astype("<u4")
    owner = block[at]
    cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    ends = np.append(cut[1:], len(at))
    rows = np.flatnonzero(new)
    for i in range(0, len(cut), 20_000):
        blobs = [pairs[a:b].tobytes() for a, b in zip(cut[i : i + 20_000].tolist(), ends[i : i + 20_000].tolist(), strict=True)]
        r = rows[i : i + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(d[r], pa.int64()), pa.array(c[r], pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "crc", "spans"])


def union(blobs: list[bytes] | None) -> list[tuple[int, int]]:
    """Maximal spans of a document from its lists of spans."""
    if not blobs:
        return []
    pairs = np.frombuffer(b"".join(blobs), "<u4").reshape(-1, 2).astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    at = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > reach[:-1]]))
    return list(zip(pairs[at, 0].tolist(), reach[np.append(at[1:], len(pairs)) - 1].tolist(), strict=True))


def with_spans(docs: DataFrame, id_col: str, text: str, out: str, *spans: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with an array column ``out`` of the document's lists of spans (null: none)."""
    d, c, key, crc = (fresh(n, [*docs.columns, out]) for n in ("__doc", "__crc", "__id", "__c"))
    found = spans[0]
    for more in spans[1:]:
        found = found.unionByName(more)
    found = found.groupBy("doc_id", "crc").agg(F.collect_list("spans").alias(out))
    found = found.withColumnsRenamed({"doc_id": d, "crc": c})
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    marked = docs.withColumns({key: F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), crc: F.crc32(body)})
    # the same join at every size: a broadcast would only serve inputs with few repeats
    return marked.join(found.hint("merge"), (F.col(key) == F.col(d)) & (F.col(crc) == F.col(c)), "left").drop(d, c, key, crc)
