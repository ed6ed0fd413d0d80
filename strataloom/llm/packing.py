"""Packing by Karmarkar-Karp multiway differencing.

Documents are tokenized in one map; only piece descriptions (no ids) are written on. Runs of ``window`` ids are
sequences by themselves; what is left of each document is cut to at most ``max_piece`` ids and packed in blocks of
bounded size: partial partitions of one piece a window are merged, always the two with the largest imbalance, largest part
on smallest part, until one is left; the number of windows rises whenever a part exceeds the window.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.llm.pieces import ids_cache, word_pieces
from strataloom.session import bound_batches, materialize


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp in its balanced form: ``sizes`` in k parts, as lists of indices.

    In descending order every k items begin a partial partition. Always the two partitions with the largest imbalance
    (largest part less smallest) are merged, largest part on smallest.
    """
    order = np.argsort(-np.asarray(sizes, np.int64), kind="stable")
    rows = -(-len(order) // k)
    items = np.append(order, np.full(rows * k - len(order), -1)).reshape(rows, k)
    sums = np.where(items < 0, 0, np.asarray(sizes, np.int64)[items])
    heap = [(int(s[-1] - s[0]), i, s, row[:, None]) for i, (s, row) in enumerate(zip(sums, items, strict=True))]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a, of_a = heapq.heappop(heap)
        _, _, b, of_b = heap[0]
        both = a + b[::-1]
        down = np.argsort(-both, kind="stable")
        both = both[down]
        heapq.heapreplace(heap, (int(both[-1] - both[0]), tie, both, np.concatenate([of_a, of_b[::-1]], axis=1)[down]))
        tie += 1
    return [[x for x in part if x >= 0] for part in heap[0][3].tolist()] if heap else []


def pack_sizes(sizes: list[int], window: int) -> list[list[int]]:
    """Items (each at most ``window``) by window, in as few windows as differencing fits."""
    k = max(1, -(-sum(sizes) // window))
    while sizes:
        parts = [p for p in differencing(sizes, k) if p]
        if max(sum(sizes[i] for i in p) for p in parts) <= window:
            return parts
        k += max(1, k // 500)
    return []


def cuts(n: int, window: int, max_piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: whole windows, then near-equal pieces of the rest."""
    out = [(s, window) for s in range(0, n - window + 1, window)]
    at, rest = len(out) * window, n % window
    for i in range(m := -(-rest // max_piece)):
        size = rest // m + (i < rest % m)
        out.append((at, size))
        at += size
    return out


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1,
    max_piece: int = 512, block_pieces: int = 4096, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A document's ids are the word tokenizer's, without special tokens, then ``end_id``. Null and empty texts are the
    end id alone. Each row of ``docs`` is a document, so repeated rows are packed as often as they occur; null ids stay
    null; other columns, whatever their names, are ignored; an empty table gives no pieces. Very long texts are taken whole
    and cut into windows. Pieces of equal length are packed in the order of ids, nulls last. Sequences are filled without
    gaps from offset 0.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    bound_batches(docs.sparkSession)
    last = int(end_id).to_bytes(4, "little")
    fields = [rows.schema["doc_id"].__class__("doc_id", rows.schema["doc_id"].dataType)]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids

    def describe(batches):
        get = ids_cache(tokenizer).__getitem__
        for b in batches:
            whose, out = [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                ids = b"".join(map(get, word_pieces(t or ""))) + last
                n = len(ids) // 4
                for start, size in cuts(n, window, max_piece):
                    part = ids[4 * start : 4 * (start + size)]
                    whose.append(i)
                    out.append((start, size, zlib.crc32(part), n, part))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            arrays = [b.column("doc_id").take(pa.array(whose, pa.int32())), *(pa.array(c, pa.int64()) for c in cols[:4])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols[4], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    pieces = materialize(rows.mapInArrow(describe, T.StructType(fields)), "pieces")
    small = pieces.where(F.col("length") < window).count()
    block_rows = block_pieces * 8

    def fill(batches):
        seq, held, part = TaskContext.get().partitionId() << 36, [], 0

        def packed(rows):
            nonlocal seq
            rows = pa.Table.from_batches(rows).sort_by([("length", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
            size = rows.column("length").to_numpy()
            sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            rest = np.flatnonzero(size < window)
            full = np.flatnonzero(size == window)
            sequence[full] = seq + np.arange(len(full))
            seq += len(full)
            blocks = max(1, round(len(rest) / block_pieces))
            for block in (rest[i::blocks] for i in range(blocks)):
                for items in pack_sizes(size[block].tolist(), window):
                    at = block[items]
                    sequence[at], offset[at] = seq, np.cumsum(size[at]) - size[at]
                    seq += 1
            return rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).to_batches()

        for b in batches:
            held.append(b)
            part += len(b)
            if part >= block_rows:
                yield from packed(held)
                held, part = [], 0
        if part:
            yield from packed(held)

    whole = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return pieces.coalesce(max(1, small // (4 * block_pieces))).mapInArrow(fill, whole)
