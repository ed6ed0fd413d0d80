"""Exact substring dedup with suffix arrays by induced sorting.

Removed is every byte covered by a ``length``-byte string that also starts at an earlier place of the corpus (smaller
doc_id, or same document and smaller start). Three steps, none of which sends the whole text's suffixes anywhere:

1. Map. Each window of ``length`` bytes is owned by its leftmost gram of smallest hash, which depends on the window alone.
   Neighbouring windows with one owner form a snippet, within which no two windows are equal. Only (owner, snippet hash,
   place) is dealt, by owner, so equal windows meet in one shard; copies of a whole snippet within a batch are settled at
   once and never dealt. Owners that a sample finds common (a passage that a good share of all documents holds) would
   overfill their shard: their windows are owned, each by itself, by their own hash. This moves work and changes no result.
2. Shard. Copies of a whole snippet are later copies as they stand. Owners with several different snippets (the edges of
   repeated passages, mostly) need their bytes compared; those snippets are asked for.
3. Compare. The asked-for snippets of a shard are one text, whose suffix array is made by induced sorting and cut where
   the permuted common prefix is below ``length``: a class of equal windows, of which all but the earliest go. Snippets of
   an owner with over ``hot`` of them are dealt as single windows by the windows' own hash instead, so no owner is too large.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.llm.blocks import BLOB, deal, fresh, gather, mix, pack_columns, runs, shard_of, slices, unpack_columns
from strataloom.llm.repeats import SPANS, free_shuffles, keyed, order_runs, span_rows, union, volume, with_spans
from strataloom.llm.suffix_array import permuted_lcp, suffix_array
from strataloom.session import materialize

_CHUNK = 1 << 18
_GROUP = 1 << 22
_PLACE_BITS = 20  # a buffer holds less than two chunks and an overlap
_KINDS = ("u8", "u8", "i8", "u4", "u4", "i4")
_RNG = np.random.default_rng(20240229)
_LETTERS = _RNG.integers(0, 2**64, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i up to n."""
    size = 1 << max(12, n.bit_length())
    if (base, size) not in _POWERS:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            p[1:] = np.uint64(b)
            out.append(np.multiply.accumulate(p))
        _POWERS[base, size] = (out[0], out[1])
    return _POWERS[base, size]


class Rolling:
    """Hashes of any substrings of a text, by polynomial prefix sums."""

    def __init__(self, text: np.ndarray, which: int):
        self.up, self.down = _powers(_BASES[which], len(text) + 1)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_LETTERS[which][text] * self.up[: len(text)], out=self.sums[1:])

    def all_of(self, size: int) -> np.ndarray:
        d = self.sums[size:] - self.sums[:-size]
        return mix(d * self.down[: len(d)])

    def at(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[start + size] - self.sums[start]) * self.down[start] + np.asarray(size, np.uint64))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each window of ``width``."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[: len(h) - size], h[size:])
        size *= 2
    return h if size == width else np.minimum(h[: len(h) - (width - size)], h[width - size :])


def snippets(text: np.ndarray, ends: np.ndarray, length: int, gram: int, common: np.ndarray | None = None):
    """(owner, hash, start, number of windows) of the snippets of documents that end at ``ends`` in one buffer.

    Snippets of owners in ``common`` (ascending) come as single windows, owned by their hashes.
    """
    n = len(text)
    empty = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < length:
        return empty
    grams = Rolling(text, 0).all_of(gram)
    bits = np.uint64(_PLACE_BITS)  # the same in every buffer, so that ties of the upper bits fall alike
    place = np.arange(len(grams), dtype=np.uint64)
    least = _least((grams >> bits << bits) | place, length - gram + 1)
    owner = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)  # place of the leftmost least gram
    change = np.zeros(n + 1, np.int32)
    begins = np.concatenate([[0], ends[:-1]])
    np.add.at(change, begins, 1)
    np.add.at(change, np.maximum(ends - length + 1, begins), -1)
    valid = np.cumsum(change[: len(owner)]) > 0
    head = valid.copy()
    head[1:] &= (owner[1:] != owner[:-1]) | ~valid[:-1]
    at_doc = np.zeros(n + 1, bool)
    at_doc[begins] = True
    head |= valid & at_doc[: len(head)]
    start = np.flatnonzero(head)
    if not len(start):
        return empty
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | head[1:]
    size = np.flatnonzero(stop) + 1 - start
    own, body = grams[owner[start]], Rolling(text, 1)
    if common is not None and len(common):
        split = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
        if split.any():
            n = size[split]
            each = np.repeat(start[split], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            window = Rolling(text, 0).at(each, length)
            own = np.concatenate([own[~split], window])
            start, size = np.concatenate([start[~split], each]), np.concatenate([size[~split], np.ones(len(each), np.int64)])
    return own, body.at(start, size + length - 1), start, size


def _buffers(batch, length: int):
    """Groups of documents as (buffer, ends, document index, offset of the buffer's piece); long texts come in
    pieces that overlap by length - 1 bytes."""
    texts, held, size = batch.column("text"), [], 0

    def put(parts):
        buf = np.frombuffer(b"".join(p[1] for p in parts), np.uint8)
        return buf, np.cumsum([len(p[1]) for p in parts]), np.array([p[0] for p in parts]), np.array([p[2] for p in parts])

    for i in range(len(texts)):
        t = texts[i].as_py()
        if len(t) < length:
            continue
        for off in range(0, max(1, len(t) - length + 1), _CHUNK):
            part = t[off : off + _CHUNK + length - 1]
            held.append((i, part, off))
            size += len(part)
            if size >= _CHUNK:
                yield put(held)
                held, size = [], 0
    if held:
        yield put(held)


def _place(ends, index, offset, start):
    """(document index, start within the document) of places in a buffer."""
    k = np.searchsorted(ends, start, "right")
    return index[k], start - np.concatenate([[0], ends[:-1]])[k] + offset[k]


def _joined(doc, crc, start, size):
    """Runs of windows (document, start, number), those that follow each other as one."""
    order = np.lexsort((start, crc, doc))
    doc, crc, start, size = doc[order], crc[order], start[order], size[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1]) | (start[1:] != start[:-1] + size[:-1])
    at = np.flatnonzero(head)
    return doc[at], crc[at], start[at], np.add.reduceat(size, at).astype(size.dtype)


def common_owners(base: DataFrame, length: int, gram: int, rows: int, share: float = 1 / 64, partitions: int = 64) -> np.ndarray:
    """Owners in at least a ``share`` of a sample of some ``rows`` documents (and in 16), ascending; bounded by the sample.

    The sample is the head of some partitions, of which only that is read.
    """
    parts = base.rdd.getNumPartitions()
    stride = max(1, -(-parts // partitions))
    each = max(1, rows // -(-parts // stride))

    def peek(batches):
        if TaskContext.get().partitionId() % stride:
            return
        left, seen = each, []
        for b in batches:
            b = b.slice(0, left)
            for buf, ends, index, offset in _buffers(b, length):
                own, _, start, _ = snippets(buf, ends, length, gram)
                seen.append(np.unique(np.stack([own, _place(ends, index, offset, start)[0].astype(np.uint64)]), axis=1)[0])
            left -= len(b)
            if left <= 0:
                break
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(seen).tobytes() if seen else b""], pa.binary())], ["owners"])

    got = [np.frombuffer(r.owners, np.uint64) for r in base.mapInArrow(peek, "owners binary").collect()]
    own, n = np.unique(np.concatenate(got or [np.zeros(0, np.uint64)]), return_counts=True)
    return own[n >= max(16, rows * share)]


def later_bytes(docs: DataFrame, id_col: str, text: str, length: int = 100, gram: int = 50, shard_bytes: int = 160_000_000, hot: int = 20_000, sample: int = 8_192) -> tuple[DataFrame, DataFrame]:
    """Spans of bytes to remove from each document, in two parts. ``sample`` bounds the documents looked at for common owners."""
    bytes_ = volume(docs, text)
    shards = max(1, -(-bytes_ * 16 // shard_bytes))
    base = keyed(docs, id_col, text)
    rows = min(sample, docs.count() // 50)
    common = common_owners(base, length, gram, rows) if rows >= 64 else np.zeros(0, np.uint64)

    def emit(batches):
        for b in slices(batches, "text"):
            ids, crcs = b.column("doc_id").to_numpy(), b.column("crc").to_numpy().astype(np.uint32)
            held, size = [], 0
            for buf, ends, index, offset in _buffers(b, length):
                own, h, start, n = snippets(buf, ends, length, gram, common)
                i, s = _place(ends, index, offset, start)
                held.append((own, h, ids[i], crcs[i], s.astype(np.uint32), n.astype(np.int32)))
                size += len(buf)
                if size >= _GROUP:
                    yield from dealt(held)
                    held, size = [], 0
            if held:
                yield from dealt(held)

    def dealt(held):
        cols = [np.concatenate(c) for c in zip(*held, strict=True)]
        order, head, late = order_runs(*cols[:5])
        gone = order[late]
        keep = np.sort(order[~late & (head == np.arange(len(head)))])
        yield deal(shard_of(mix(cols[0][keep]), shards), [c[keep] for c in cols])  # owners are least hashes, so not spread by themselves
        if len(gone):  # settled: marked by a negative size
            doc, crc, start, size = _joined(*(c[gone] for c in cols[2:6]))
            zero = np.zeros(len(doc), np.uint64)
            yield deal(shard_of(mix(doc.view(np.uint64)), shards), [zero, zero, doc, crc, start, -size])

    def decide(blobs):
        cols = [np.concatenate(c) for c in zip(*(unpack_columns(x, *_KINDS) for x in blobs), strict=True)]
        done = cols[5] < 0
        gone = [[c[done] for c in cols[2:5]] + [-cols[5][done]]]
        cols = [c[~done] for c in cols]
        order, head, late = order_runs(*cols[:5])
        gone.append([c[order[late]] for c in cols[2:6]])
        doc, crc, start, size = (np.concatenate(c) for c in zip(*gone, strict=True))
        for rb in span_rows(doc, crc.astype(np.int64), start.astype(np.int64), start.astype(np.int64) + size + length - 1):
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.nulls(len(rb), pa.binary())], [*rb.schema.names, "ask"])
        first = order[~late & (head == np.arange(len(head)))]
        own = cols[0][first]
        at, n = runs(own)
        many = np.repeat(n > 1, n)
        is_hot = np.repeat(n > hot, n)[many]
        first = first[many]
        ask = first[np.lexsort((cols[4][first], cols[3][first], cols[2][first]))]
        hot_of = np.zeros(len(cols[0]), np.uint8)
        hot_of[first] = is_hot
        doc, crc = cols[2][ask], cols[3][ask]
        cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1])])) if len(ask) else []
        ends = np.append(cut[1:], len(ask))[: len(cut)]
        rows = [(int(doc[a]), int(crc[a]), pack_columns(cols[4][ask[a:e]], cols[5][ask[a:e]].astype(np.uint32), cols[0][ask[a:e]], hot_of[ask[a:e]])) for a, e in zip(cut, ends, strict=True)]
        if rows:
            d, c, blob = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(c, pa.int64()), pa.nulls(len(d), pa.binary()), pa.array(blob, pa.binary())], ["doc_id", "crc", "spans", "ask"])

    decided = materialize(gather(base.mapInArrow(emit, BLOB), shards, decide, SPANS + ", ask binary"), "substrings")
    free_shuffles(docs)
    asked = decided.where("ask is not null").groupBy("doc_id", "crc").agg(F.collect_list("ask").alias("ask"))
    asked = asked.withColumnsRenamed({"doc_id": "a_doc", "crc": "a_crc"})
    texts = base.join(asked.hint("merge"), (F.col("doc_id") == F.col("a_doc")) & (F.col("crc") == F.col("a_crc"))).drop("a_doc", "a_crc")
    compare_shards = max(1, -(-bytes_ // 6_000_000))

    def extract(batches):
        for b in slices(batches, "text"):
            own, place, parts = [], [], []
            ids, crcs = b.column("doc_id").to_pylist(), b.column("crc").to_pylist()
            for i, (t, asks) in enumerate(zip(b.column("text").to_pylist(), b.column("ask").to_pylist(), strict=True)):
                start, size, owner, is_hot = (np.concatenate(c) for c in zip(*(unpack_columns(a, "u4", "u4", "u8", "u1") for a in asks), strict=True))
                for s, n, o, h in zip(start.tolist(), size.tolist(), owner.tolist(), is_hot.tolist(), strict=True):
                    for s_, n_ in ((s + k, 1) for k in range(n)) if h else ((s, n),):
                        part = t[s_ : s_ + n_ + length - 1]
                        parts.append(part)
                        own.append(int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little") if h else o)
                        place.append((ids[i], crcs[i], s_, n_))
            if not parts:
                continue
            shard = shard_of(mix(np.array(own, np.uint64)), compare_shards)
            at = np.array(place, np.int64)
            for k in np.unique(shard).tolist():
                mine = np.flatnonzero(shard == k)
                body = np.frombuffer(b"".join(parts[i] for i in mine), np.uint8)
                blob = pack_columns(*at[mine].T)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(blob).to_bytes(8, "little") + blob + pack_columns(body)], pa.binary())], ["shard", "blob"])

    def compare(blobs):
        heads, bodies = [], []
        for x in blobs:
            n = int.from_bytes(x[:8], "little")
            heads.append(unpack_columns(x[8 : 8 + n], "i8", "i8", "i8", "i8"))
            bodies.append(unpack_columns(x[8 + n :], "u1")[0])
        doc, crc, start, n = (np.concatenate(c) for c in zip(*heads, strict=True))
        late = _later_windows(np.concatenate(bodies), doc, crc, start, n, length)
        if late is not None:
            i, s = late
            yield from span_rows(doc[i], crc[i], s, s + length)

    compared = materialize(gather(texts.mapInArrow(extract, BLOB), compare_shards, compare, SPANS), "substrings-compared")
    free_shuffles(docs)
    return decided.where("spans is not null").select("doc_id", "crc", "spans"), compared


def _later_windows(body, doc, crc, start, n, length):
    """(snippet, start in its document) of windows that equal one at an earlier place."""
    size = n + length - 1
    at = np.cumsum(size) - size
    parted = np.zeros(len(body) + len(size) + 1, np.int64)  # snippets, each after a separating 1; then the final 0
    where = np.arange(len(body)) + np.repeat(np.arange(1, len(size) + 1), size)
    parted[where] = body.astype(np.int64) + 2
    parted[at + np.arange(len(size))] = 1
    sa = suffix_array(parted)
    lcp = permuted_lcp(parted, sa, length)
    cls = np.cumsum(lcp[sa] < length)
    begin = at + np.arange(1, len(size) + 1)
    owner = np.full(len(parted), -1, np.int64)
    k = np.repeat(np.arange(len(size)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pos = begin[k] + within
    owner[pos] = np.arange(len(pos))
    window = owner[sa]
    keep = window >= 0
    cls, window = cls[keep], window[keep]
    i, s = k[window], start[k[window]] + within[window]
    order = np.lexsort((s, crc[i], doc[i], cls))
    cls, i, s = cls[order], i[order], s[order]
    first = np.maximum.accumulate(np.where(np.concatenate([[True], cls[1:] != cls[:-1]]), np.arange(len(cls)), 0))
    late = (doc[i] != doc[i[first]]) | (crc[i] != crc[i[first]]) | (s != s[first])
    return (i[late], s[late]) if late.any() else None


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """All rows and columns of ``docs``, with n_bytes, n_removed, n_spans, removed (start/end pairs) and kept (binary).

    Null texts count as empty; ids may be null and then come first; rows with the same doc_id and text are one document
    and do not remove each other; very long texts are read whole; existing columns of the new names are replaced, others
    keep their values whatever their names; an empty table gives an empty result.
    """
    new = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("removed", T.ArrayType(T.ArrayType(T.LongType()))), ("kept", T.BinaryType())]
    base = docs.drop(*(n for n, _ in new))
    schema = T.StructType([*base.schema.fields, *(T.StructField(n, t) for n, t in new)])
    columns, names, spans_col = base.columns, schema.names, fresh("__spans", base.columns)

    def apply(batches):
        for b in slices(batches, text):
            out = []
            for t, spans in zip(b.column(text).cast(pa.binary()).to_pylist(), b.column(spans_col).to_pylist(), strict=True):
                t = t or b""
                gone, kept, at = union(spans), [], 0
                for s, e in gone:
                    kept.append(t[at:s])
                    at = e
                out.append((len(t), sum(e - s for s, e in gone), len(gone), gone, b"".join([*kept, t[at:]])))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            arrays = [pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array([[list(x) for x in c] for c in cols[3]], pa.list_(pa.list_(pa.int64()))), pa.array(cols[4], pa.binary())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *arrays], names)

    return with_spans(base, id_col, text, spans_col, *later_bytes(base, id_col, text, length)).mapInArrow(apply, schema)


def digest(docs: DataFrame) -> DataFrame:
    out = dedup_substrings(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
