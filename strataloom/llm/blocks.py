"""Shuffles of packed columns: many small values travel as few large rows, and each shard is handled with numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame

BLOB = "shard int, blob binary"


def pack_columns(*cols: np.ndarray) -> bytes:
    """Columns of one length as bytes; integers that rise slowly compress well as differences."""
    raw = b"".join(np.ascontiguousarray(c).tobytes() for c in cols)
    return len(cols[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack_columns(blob: bytes, *kinds: str) -> list[np.ndarray]:
    n, raw, at, out = int.from_bytes(blob[:8], "little"), zstandard.ZstdDecompressor().decompress(blob[8:]), 0, []
    for k in kinds:
        size = np.dtype(k).itemsize * n
        out.append(np.frombuffer(raw, k, n, at))
        at += size
    return out


def fresh(name: str, columns) -> str:
    """``name``, or with underscores after it, so that no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (the splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard of well-mixed unsigned 64-bit keys, by their high bits."""
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def deal(shard: np.ndarray, cols: list[np.ndarray]) -> pa.RecordBatch:
    """Rows by shard, in their order within a shard."""
    order = np.argsort(shard, kind="stable")
    ids, starts = np.unique(shard[order], return_index=True)
    ends = [*starts[1:].tolist(), len(shard)][: len(starts)]
    blobs = [pack_columns(*(c[order[s:e]] for c in cols)) for s, e in zip(starts.tolist(), ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def slices(batches, column: str, most: int = 1 << 23):
    """The rows of Arrow batches in slices of about ``most`` bytes in ``column``, one row at least."""
    for b in batches:
        size = pa.compute.fill_null(pa.compute.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // most)) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b)], strict=True):
            yield b.slice(s, e - s)


def gather(blobs: DataFrame, shards: int, fn: Callable[[list[bytes]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """Apply ``fn`` to all blobs of each shard. Shards are sized by the caller so that one fits a task."""

    def run(batches):
        held: list[bytes] = []
        at = None
        for b in batches:
            for shard, blob in zip(b.column("shard").to_pylist(), b.column("blob").to_pylist(), strict=True):
                if shard != at and held:
                    yield from fn(held)
                    held = []
                at = shard
                held.append(blob)
        if held:
            yield from fn(held)

    return blobs.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values in a sorted array."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return starts, np.diff(np.append(starts, len(key)))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node linked to it) over the edges a-b, for nodes that are not the smallest themselves."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, low = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while True:
        m = np.minimum(low[u], low[v])
        before = low.copy()
        np.minimum.at(low, low[u], m)
        np.minimum.at(low, low[v], m)
        while (low[low] != low).any():
            low = low[low]
        if (low == before).all():
            break
    keep = low != np.arange(len(ids))
    return ids[keep], ids[low[keep]]
