"""Approximate nearest neighbours by a hash-prefix forest (LSH Forest, Bawa, Condie and Ganesan 2005).

Rows are dealt to shards of bounded size, and each shard holds ``trees`` sorted arrays of long hash strings. A string's
letters are cross-polytope hashes (Andoni et al. 2015): the axis, with its sign, nearest to a randomly turned vector, where
vectors are centred and, if their lengths differ, have the component that turns the largest inner product into the nearest
vector. A query descends every array to its longest matching prefix, then all arrays ascend together, one bit at a time,
until the ranges that share the prefix hold ``budget`` entries; what they hold is scored exactly. The budget does not grow
with the shard. Queries come in blocks, each block to every shard, so neither side is ever whole in one place; the best of
all shards are ranked by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.blocks import BLOB, gather, mix

AXES = 64  # at most so many axes to a letter
_PART = 1024  # queries searched at once


def usable(vectors: DataFrame, id_col: str, column: str) -> DataFrame:
    """(vec_id, v) of vectors that take part: an id, no nulls or non-finite components, not zero, of the commonest length.

    Rows that repeat an id are one: of different vectors the smallest, component by component, counts.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).where("vec_id is not null")
    rows = rows.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    size = rows.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size(v) == (size.d if size else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


class Forest:
    """The sorted hash strings of one shard's distinct vectors."""

    def __init__(self, x: np.ndarray, centre: np.ndarray, reach: float, trees: int, seed: int):
        self.trees, self.seed, self.centre, self.reach = trees, seed, centre, reach
        self.axes = min(AXES, x.shape[1] + 1)
        self.letter = (2 * self.axes - 1).bit_length()
        self.letters = max(2, 32 // self.letter)
        self.bits = self.letter * self.letters
        codes = self.strings(np.column_stack([x, np.sqrt(np.maximum(reach - (x * x).sum(axis=1), 0.0))]))
        self.order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        self.codes = np.take_along_axis(codes, self.order, 1)

    def strings(self, rows: np.ndarray) -> np.ndarray:
        """(trees, rows) hash strings. A tree begins with two letters of its own and goes on with those of the next trees."""
        rng, y = np.random.default_rng(self.seed), (rows - self.centre).astype(np.float32)
        own = np.empty((2 * self.trees, len(y)), np.uint8)
        at = np.arange(len(y))
        for k in range(2 * self.trees):
            turn = np.linalg.qr(rng.standard_normal((y.shape[1], self.axes)))[0].astype(np.float32)
            z = y @ turn
            near = np.abs(z).argmax(axis=1)
            own[k] = 2 * near + (z[at, near] > 0)
        out = np.zeros((self.trees, len(y)), np.uint32 if self.bits <= 32 else np.uint64)
        for k in range(self.letters):
            out = out << out.dtype.type(self.letter) | own[(2 * np.arange(self.trees) + k) % (2 * self.trees)]
        return out

    def candidates(self, queries: np.ndarray, budget: int, least: int = 21):
        """For each query, the places of its candidates among the shard's vectors, ``least`` of them if there are so many."""
        for q, c in zip(queries, self._found(queries, budget), strict=True):
            more = budget
            while len(c) < min(least, len(self.codes[0])):  # a tight group held the budget in many trees
                more *= 4
                c = next(self._found(q[None, :], more))
            yield c

    def _found(self, queries: np.ndarray, budget: int):
        n = len(self.codes[0])
        unit = queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True)) * np.sqrt(self.reach)
        codes = self.strings(np.column_stack([unit, np.zeros(len(queries))])).astype(np.uint64)
        low, high = np.zeros((2, self.trees, len(queries)), np.int64)
        todo, depth = np.arange(len(queries)), self.bits
        while len(todo):  # from the longest prefix up, the same length in all trees
            step = np.uint64(self.bits - depth)
            head = codes[:, todo] >> step
            first, past = head << step, ((head + np.uint64(1)) << step) - np.uint64(1)
            for t in range(self.trees):
                low[t, todo] = np.searchsorted(self.codes[t], first[t].astype(self.codes.dtype), "left")
                high[t, todo] = np.searchsorted(self.codes[t], past[t].astype(self.codes.dtype), "right")
            held = (high[:, todo] - low[:, todo]).sum(axis=0)
            todo = todo[held < min(budget, n * self.trees)]
            if not depth:
                break
            if len(todo):  # skip lengths that can't do: a bit less at most doubles what even strings would hold
                guess = int(np.log2(max(1.0, budget / max(1, held.max())))) // 2
                depth = max(0, depth - max(1, guess))
        size = high - low
        order = self.order.ravel()
        for i in range(len(queries)):
            k = size[:, i]
            at = np.repeat(low[:, i] + np.arange(self.trees) * n - (np.cumsum(k) - k), k) + np.arange(k.sum())
            mask = np.zeros(n, bool)
            mask[order[at]] = True
            yield np.flatnonzero(mask)


def _best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, forest_of, budget: int, k: int):
    """(query, vec_id, score) of the k best candidates of a shard, ties to smaller ids."""
    distinct, of = np.unique(x, axis=0, return_inverse=True)
    of = of.ravel()
    by = np.lexsort((ids, of))
    starts = np.searchsorted(of[by], np.arange(len(distinct)))
    ends = np.append(starts[1:], len(by))
    small = distinct.astype(np.float32)
    forest = forest_of(distinct)
    slack = 1e-5 * float(np.abs(distinct).max() * np.abs(queries).max()) * x.shape[1] + 1e-12
    for at in range(0, len(queries), _PART):
        q = queries[at : at + _PART]
        for i, c in enumerate(forest.candidates(q, budget, k + 1)):
            rough = small[c] @ q[i].astype(np.float32)
            if len(c) > k + 1:
                c = c[rough >= np.partition(rough, -(k + 1))[-(k + 1)] - slack]
            score = (distinct[c] * q[i]).sum(axis=1)
            order = np.argsort(-score, kind="stable")
            got, floor = [], None
            for j in order.tolist():
                if floor is not None and score[j] < floor:
                    break
                mine = ids[by[starts[c[j]] : ends[c[j]]]]
                mine = mine[mine != query_ids[at + i]]
                mine = mine[np.append(True, mine[1:] != mine[:-1])][:k] if len(mine) else mine
                got.extend((score[j], int(v)) for v in mine.tolist())
                if len(got) >= k:
                    floor = score[j]
            got.sort(key=lambda g: (-g[0], g[1]))
            for s, v in got[:k]:
                yield int(query_ids[at + i]), v, float(s)


def nearest(
    vectors: DataFrame, is_query, id_col: str = "vec_id", column: str = "embedding", k: int = 20, trees: int = 576, budget: int = 2_600,
    shard_rows: int = 65_536, block_rows: int = 16_384, sample_rows: int = 2_000, seed: int = 3,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each row for which ``is_query`` holds.

    ``budget`` is what the prefix ranges of all trees must hold in sum, in each shard; ``sample_rows`` bounds the rows from
    which the centre is taken, and every usable row is indexed. Unusable vectors (see ``usable``; rows without an id, and
    vectors of another length than most, among them) take no part, neither as queries nor as candidates. Equal scores go to
    smaller ids. With k or fewer candidates all are returned (those with no shared prefix too, as the trees ascend to the
    root). Other columns, whatever their names, are ignored. An empty table gives an empty result.
    """
    rows = usable(vectors, id_col, column)
    length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    count, reach = rows.agg(F.count(F.lit(1)), F.max(length2)).first()
    queries = rows.where(is_query(F.col("vec_id"))).count() if count else 0
    out = "query_id long, vec_id long, score double"
    if not queries:
        found = rows.sparkSession.createDataFrame([], out)
        return found.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    sample = np.array([r.v for r in rows.limit(sample_rows).collect()])
    sample = np.column_stack([sample, np.sqrt(np.maximum(reach - (sample * sample).sum(axis=1), 0.0))])
    centre = sample.mean(axis=0)
    size = sample.shape[1] - 1
    shards, blocks = -(-count // shard_rows), -(-queries // block_rows)

    def emit(batches):
        for b in batches:
            ids, ask = b.column("vec_id").to_numpy(), b.column("ask").to_numpy(zero_copy_only=False)
            x = b.column("v").flatten().to_numpy().reshape(len(ids), size)
            h = mix(ids.view(np.uint64) + np.uint64(seed))
            keys, blobs = [], []

            def put(key, kind, rows, ids=ids, x=x, keys=keys, blobs=blobs):
                keys.append(key)
                blobs.append(kind + len(rows).to_bytes(8, "little") + ids[rows].tobytes() + x[rows].tobytes())

            mine, block = h % np.uint64(shards), (h >> np.uint64(40)) % np.uint64(blocks)
            for s in np.unique(mine).tolist():
                part = np.flatnonzero(mine == s)
                for q in range(blocks):
                    put(s * blocks + q, b"x", part)
            for q in np.unique(block[ask]).tolist():
                part = np.flatnonzero(ask & (block == q))
                for s in range(shards):
                    put(s * blocks + q, b"q", part)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])

    def search(blobs):
        side = {b"x": ([], []), b"q": ([], [])}
        for blob in blobs:
            n = int.from_bytes(blob[1:9], "little")
            ids, vs = side[blob[:1]]
            ids.append(np.frombuffer(blob, np.int64, n, 9))
            vs.append(np.frombuffer(blob, np.float64, n * size, 9 + 8 * n).reshape(n, size))
        if not side[b"q"][0] or not side[b"x"][0]:
            return
        (ids, x), (qi, q) = ((np.concatenate(i), np.concatenate(v)) for i, v in side.values())
        got = list(_best(ids, x, qi, q, lambda d: Forest(d, centre, reach, trees, seed), budget, k))
        a, b, c = zip(*got, strict=True) if got else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], ["query_id", "vec_id", "score"])

    asked = rows.withColumn("ask", is_query(F.col("vec_id"))).select("vec_id", "v", "ask")
    found = gather(asked.mapInArrow(emit, BLOB), shards * blocks, search, out)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
