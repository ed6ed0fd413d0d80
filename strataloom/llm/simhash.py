"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints within 3 bits share a variant: those of even weight emit themselves and all variants two
bits away, those of odd weight all variants one bit away, so every emitted variant has even weight. A variant's
bucket can hold at most 2,081 distinct fingerprints whatever the data, and all of its odd members lie within two
bits of each other and within three of its even members. A star around one odd member (or around the variant itself)
therefore holds only true links and loses no connection, so no bucket ever yields all its pairs.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.blocks import BLOB, deal, forest, fresh, gather, mix, pack_columns, runs, shard_of, slices, unpack_columns
from strataloom.operators.components import connected_components
from strataloom.session import bound_batches, materialize

SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of the shingles of a text, repeats included; of the whole sequence if it has fewer words; none for none."""
    w = text.lower().split()  # on bytes: A-Z only, and white space 09-0D and 20
    if not w:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
    h = xxhash.xxh64_intdigest
    return np.array([h(g, SEED) for g in grams], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """64 bits: those set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    lanes = hashes.view(np.uint8).reshape(n, 8)
    if n < 2000:
        ones = np.add.reduce(np.unpackbits(lanes, axis=1, bitorder="little"), axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text: str, words: int) -> DataFrame:
    """(doc_id, fp) per row."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def run(batches):
        for b in batches:
            fps = [majority(shingle_hashes(t or b"", words)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long")


#: Variants of even weight: no flip and all pairs of flips for even fingerprints, all single flips for odd ones.
_ONE = np.uint64(1) << np.arange(64, dtype=np.uint64)
_PAIRS = np.array([int(_ONE[i] | _ONE[j]) for i, j in combinations(range(64), 2)], np.uint64)
FLIPS = np.concatenate([np.zeros(1, np.uint64), _PAIRS, _ONE])
_EVEN, _ODD = np.arange(1 + len(_PAIRS), dtype=np.uint16), np.arange(1 + len(_PAIRS), len(FLIPS), dtype=np.uint16)


def variants(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(variant, code of its flips) of each fingerprint; variant ^ FLIPS[code] is the fingerprint."""
    odd = (np.bitwise_count(fp) & 1).astype(bool)
    even_z, odd_z = fp[~odd][:, None] ^ FLIPS[_EVEN], fp[odd][:, None] ^ FLIPS[_ODD]
    codes = np.concatenate([np.tile(_EVEN, len(even_z)), np.tile(_ODD, len(odd_z))])
    return np.concatenate([even_z.ravel(), odd_z.ravel()]), codes


def star_edges(z: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of all buckets, as stars."""
    order = np.argsort(z)
    z, code = z[order], code[order]
    start, n = runs(z)
    many = n > 1
    start, n = start[many], n[many]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    bucket, c = np.repeat(np.arange(len(n)), n), code[at]
    fp = z[at] ^ FLIPS[c]
    rank = np.where(c >= _ODD[0], 0, np.where(c == 0, 1, 2))  # an odd member, the variant itself, others
    best = np.lexsort((fp, rank, bucket))
    first = best[np.cumsum(n) - n]
    centre, has = fp[first][bucket], rank[first][bucket] < 2
    good = has & (centre != fp) & (np.bitwise_count(centre ^ fp) <= 3)
    return centre[good], fp[good]


def ball_links(distinct: DataFrame, variants_per_shard: int = 3_000_000) -> DataFrame:
    """Links (src, dst) that connect all distinct fingerprints within three bits of each other.

    Every fingerprint emits its variants. One travels as the place of its fingerprint in a list and the code of its flips,
    a byte or two each once compressed, as a fingerprint has several variants in most shards.
    """
    rows = materialize(distinct, "simhash-distinct")
    count = rows.count()
    shards = max(1, -(-count * 1041 // variants_per_shard))
    spread = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, count // 20_000))

    def emit(batches):
        for b in batches:
            fps = b.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fps), 512):
                yield _dealt_variants(fps[i : i + 512], shards)

    def link(blobs):
        z, code = (np.concatenate(c) for c in zip(*map(_shard_variants, blobs), strict=True))
        order = np.sort(z)
        shared = order[1:][order[1:] == order[:-1]]
        if len(shared):
            shared = shared[np.concatenate([[True], shared[1:] != shared[:-1]])]
            at = np.minimum(np.searchsorted(shared, z), len(shared) - 1)
            met = shared[at] == z
            a, b = forest(*star_edges(z[met], code[met]))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["src", "dst"])

    return gather(spread.mapInArrow(emit, BLOB), shards, link, "src long, dst long")


def _dealt_variants(fps: np.ndarray, shards: int) -> pa.RecordBatch:
    """All variants of some fingerprints, by shard: those fingerprints that have any in it, and a pair of numbers each."""
    odd = (np.bitwise_count(fps) & 1).astype(bool)
    fps = np.concatenate([fps[~odd], fps[odd]])
    z, code = variants(fps)
    owner = np.repeat(np.arange(len(fps), dtype=np.uint16), np.where(np.arange(len(fps)) < (~odd).sum(), len(_EVEN), len(_ODD)))
    to = shard_of(mix(z), shards)
    order = np.argsort(to.astype(np.uint16) if shards < 1 << 16 else to, kind="stable")
    ids, starts = np.unique(to[order], return_index=True)
    blobs = []
    for at in np.split(order, starts[1:]):
        who, c = owner[at], code[at]
        new = np.concatenate([[True], who[1:] != who[:-1]])
        head = pack_columns(fps[who[new]])
        blobs.append(len(head).to_bytes(8, "little") + head + pack_columns(new, np.diff(c, prepend=c[:1] * 0)))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _shard_variants(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(variant, code) of what _dealt_variants sent to a shard."""
    n = int.from_bytes(blob[:8], "little")
    (fps,) = unpack_columns(blob[8 : 8 + n], "u8")
    new, step = unpack_columns(blob[8 + n :], "?", "u2")
    code = np.cumsum(step, dtype=np.uint16)
    return fps[np.cumsum(new) - 1] ^ FLIPS[code], code


def contracted(links: DataFrame, most: int = 250_000) -> DataFrame:
    """The links (materialized) as one forest per ``most`` of them. Shards each span a large group of copies with a tree of
    their own; this keeps the edge list near the number of nodes, whatever the number of shards."""
    parts = max(1, -(-links.count() // most))

    def span(batches):
        rows = [b for b in batches if len(b)]
        a, b = (np.concatenate([r.column(c).to_numpy() for r in rows] or [np.zeros(0, np.int64)]) for c in ("src", "dst"))
        x, y = forest(a, b) if len(a) else (a, b)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["src", "dst"])

    return materialize(links.coalesce(parts).mapInArrow(span, "src long, dst long"), "simhash-forest")


def _by_component(rows: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """``rows`` (doc_id and key) with component_id, the smallest doc_id among the rows that links connect."""
    first = rows.groupBy(key).agg(F.min("doc_id").alias("first"))
    part = materialize(connected_components(contracted(links)), "simhash-components").withColumnRenamed("id", key)
    lowest = first.join(part, key).groupBy("component").agg(F.min("first").alias("low"))
    found = first.join(part, key, "left").join(lowest, "component", "left").select(key, F.coalesce("low", "first").alias("component_id"))
    return rows.join(found, key, "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row: fingerprints within 3 bits are linked, components are transitive.

    Null and empty texts, and texts of white space, have fingerprint zero and link like any other. Repeated rows each
    get a row. A null doc_id gets the component's smallest other id (null if there is none). Other columns are
    ignored; an empty table gives an empty result. Long texts are read whole.
    """
    rows = materialize(fingerprints(docs, id_col, text, words), "simhash")
    links = materialize(ball_links(rows.select("fp").distinct()), "simhash-links")
    return _by_component(rows, links, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _bands(similarity: float, rows: int, recall: float) -> int:
    """Number of bands of ``rows`` least values, so that sets at ``similarity`` share one with probability ``recall``."""
    return ceil(log(1 - recall) / log(1 - similarity**rows))


def exact_links(sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """Spanning links of all pairs of sets (of distinct hashes) whose Jaccard similarity is at least ``similarity``.

    Each newly reached set is counted against all others by the places of its hashes; those reached are not reached again.
    """
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, name = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(name, kind="stable")
    start, n = runs(name[order])
    at, names = owner[order], np.split(name, np.cumsum(size)[:-1])
    free, us, vs = np.ones(len(sets), bool), [], []
    for root in range(len(sets)):
        queue = [root] if free[root] else []
        free[root] = False
        while queue and free.any():
            x = queue.pop()
            few = names[x][n[names[x]] > 1]
            k = n[few]
            places = np.repeat(start[few], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            both = np.bincount(at[places], minlength=len(sets))
            hit = np.flatnonzero(free & (both / (size + size[x] - both) >= similarity)).tolist()
            us += [x] * len(hit)
            vs += hit
            queue += hit
            free[hit] = False
    return us, vs


def _candidate_links(texts: DataFrame, words: int, rows: int, bands: int, shards: int) -> DataFrame:
    """Links (src, dst) between the nodes of ``texts`` (node, text) that share a band of least hashes, as stars."""
    rng = np.random.default_rng(SEED)
    flip, odd = (rng.integers(0, 2**64, (bands * rows, 1), dtype=np.uint64) for _ in range(2))
    odd |= np.uint64(1)

    def emit(batches):
        for b in batches:
            z, at = [], []
            for node, t in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), strict=True):
                h = np.unique(shingle_hashes(t, words))
                least = ((h ^ flip) * odd).min(axis=1).reshape(bands, rows)
                key = np.arange(bands, dtype=np.uint64)
                for k in range(rows):
                    key = mix(key + least[:, k])
                z.append(key)
                at.append(np.full(bands, node, np.int64))
            if z:
                z, at = np.concatenate(z), np.concatenate(at)
                order = np.lexsort((at, z))
                z, at = z[order], at[order]
                start, n = runs(z)
                first = np.repeat(at[start], n)
                a, b = forest(first[first != at], at[first != at])
                # of a band one node goes on, and what it stands for as links, each under a key of its own
                link = mix(a.view(np.uint64) ^ mix(b.view(np.uint64)))
                z, at = np.concatenate([z[start], link, link]), np.concatenate([at[start], a, b])
                yield deal(shard_of(z, shards), [z, at])

    def link(blobs):
        z, node = (np.concatenate(c) for c in zip(*(unpack_columns(x, "u8", "i8") for x in blobs), strict=True))
        order = np.argsort(z)
        z, node = z[order], node[order]
        start, n = runs(z)
        first = np.repeat(node[start], n)
        a, b = forest(first[first != node], node[first != node])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    return gather(texts.mapInArrow(emit, BLOB), shards, link, "src long, dst long")


def _verified(members: DataFrame, words: int, similarity: float, per_shard: int = 8 << 20) -> DataFrame:
    """Links (src, dst) of ``members`` (node, component, text) whose shingle sets are as similar, within each component."""
    shards = max(1, -(-(members.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // per_shard))

    def emit(batches):
        for whole in batches:
            for b in slices(pa.Table.from_batches([whole]).to_batches(), "text"):
                part, node = (b.column(c).to_numpy() for c in ("component", "node"))
                sets = [np.unique(shingle_hashes(t, words)) for t in b.column("text").to_pylist()]
                size = np.array([len(s) for s in sets])
                to = shard_of(mix(part.view(np.uint64)), shards)
                yield deal(np.repeat(to, size), [np.repeat(part, size), np.repeat(node, size), np.concatenate(sets)])

    def link(blobs):
        part, node, h = (np.concatenate(c) for c in zip(*(unpack_columns(x, "i8", "i8", "u8") for x in blobs), strict=True))
        order = np.lexsort((h, node, part))
        part, node, h = part[order], node[order], h[order]
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (part[1:] != part[:-1]) | (h[1:] != h[:-1])])
        part, node, h = part[new], node[new], h[new]  # a text may come once a task
        src, dst = [], []
        for s, m in zip(*(x.tolist() for x in runs(part)), strict=True):
            at, size = (x.tolist() for x in runs(node[s : s + m]))
            u, v = exact_links([h[s + a : s + a + k] for a, k in zip(at, size, strict=True)], similarity)
            ids = node[s : s + m][at]
            src.append(ids[u])
            dst.append(ids[v])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (src, dst)], ["src", "dst"])

    return gather(members.mapInArrow(emit, BLOB), shards, link, "src long, dst long")


def _copy_groups(docs: DataFrame, id_col: str, text: str, words: int, similarity: float, recall: float, band: int, per_shard: int) -> tuple[DataFrame, DataFrame]:
    """(rows with doc_id and node, exact links between nodes); a node is a text by its hash, null without words."""
    bound_batches(docs.sparkSession)
    worded = F.coalesce(F.col(text).cast("string").rlike("[^\\t-\\r ]"), F.lit(False))
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), F.when(worded, F.xxhash64(text)).alias("node")), "copies-rows")
    texts = docs.where(worded).select(F.xxhash64(text).alias("node"), F.col(text).cast("binary").alias("text"))
    prints = materialize(fingerprints(_once(texts), "node", "text", words).withColumnRenamed("doc_id", "node"), "copies-fingerprints")
    ball = materialize(ball_links(prints.select("fp").distinct(), 1_000_000), "copies-ball")
    first = prints.groupBy("fp").agg(F.min("node").alias("first"))
    same = prints.join(first, "fp").where("node <> first").select(F.col("node").alias("src"), F.col("first").alias("dst"))
    near = ball.join(first.toDF("src", "a"), "src").join(first.toDF("dst", "b"), "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    bands = _bands(similarity, band, recall)
    shards = max(1, -(-rows.where("node is not null").count() * bands // per_shard))
    met = _candidate_links(_once(texts), words, band, bands, shards)
    links = materialize(same.unionByName(near).unionByName(met), "copies-candidates")
    parts = materialize(connected_components(contracted(links)), "copies-groups").withColumnRenamed("id", "node")
    members = materialize(_once(texts).join(parts, "node"), "copies-members")
    return rows, materialize(_verified(members, words, similarity), "copies-links")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, recall: float = 0.999,
    band: int = 5, per_shard: int = 1_200_000,
) -> DataFrame:
    """(doc_id, component_id) per row: texts whose sets of word shingles have a Jaccard similarity of at least
    ``similarity`` are linked, components are transitive.

    Candidates are SimHash fingerprints within three bits, found by ball hashing as in near_duplicates. A pair at 0.8 differs
    in some ten of 64 bits, which no ball reaches, so candidates also are texts that share a band of ``band`` least hashes;
    the number of bands gives a pair at ``similarity`` the chance ``recall`` to meet, whatever the number of texts, and more
    similar pairs a higher one. The texts of each component of candidates then meet in one task, where all their pairs are
    compared exactly, so no link is below ``similarity``. Nulls, empty texts and repeated rows are handled as in
    near_duplicates, but texts without words link to nothing.
    """
    rows, sure = _copy_groups(docs, id_col, text, words, similarity, recall, band, per_shard)
    blank = rows.where("node is null").select("doc_id", F.col("doc_id").alias("component_id"))
    return _by_component(rows.where("node is not null"), sure, "node").select("doc_id", "component_id").unionByName(blank)


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, recall: float = 0.999,
    band: int = 5, per_shard: int = 1_200_000,
) -> DataFrame:
    """One row of ``docs``, whole, of each group that near_copies finds: that of the smallest id, a null id coming last, and
    of the smallest text hash among rows that share the id. Rows that repeat an id and a text count once. Texts without
    words (null, empty, blank) link to nothing, so each of them stays. An empty table gives an empty result.
    """
    rows, sure = _copy_groups(docs, id_col, text, words, similarity, recall, band, per_shard)
    a, b = fresh("__stays", docs.columns), fresh("__node", docs.columns)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    first = rows.where("node is not null").groupBy("node").agg(F.min(place).alias("place"))
    part = materialize(connected_components(contracted(sure)), "copies-components").toDF("node", "component")
    stays = first.join(part, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("place").alias("place"))
    stays = materialize(stays.select(F.col("place.doc_id").alias(a), F.col("place.node").alias(b)), "copies-stay")
    worded = F.coalesce(F.col(text).cast("string").rlike("[^\\t-\\r ]"), F.lit(False))
    kept = docs.where(worded).join(stays, F.col(id_col).eqNullSafe(F.col(a)) & (F.xxhash64(text) == F.col(b)), "left_semi")
    return kept.unionByName(docs.where(~worded)).dropDuplicates([id_col, text])


def _once(texts: DataFrame) -> DataFrame:
    """Each node once a task."""

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            keep = [i for i, x in enumerate(b.column("node").to_pylist()) if not (x in seen or seen.add(x))]
            yield b.take(pa.array(keep, pa.int64()))

    return texts.mapInArrow(run, "node long, text binary")
