"""Quality classifier: naive Bayes support vectors (Wang and Manning 2012).

A text's features are indicators of n-grams: byte trigrams, words and word pairs, and one to three word shapes in a row
(case, length, closing marks, whether the word was just said), hashed to ``BINS``. Indicators are scaled by the log-count
ratio of the two classes, counted over all labelled rows, and a linear hinge-loss model is fitted to a bounded sample of
them by dual coordinate descent (Hsieh et al. 2008). Margins become scores by a logistic curve fitted to margins of folds
left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.llm.blocks import mix, slices
from strataloom.llm.exact_dedup import Rolling
from strataloom.session import bound_batches, materialize

BINS = 1 << 18
_SPACE, _LOWER, _UPPER, _DIGIT = 0, 1, 2, 3
_CLASS = np.full(256, _LOWER, np.uint8)  # bytes past ASCII are parts of letters, mostly
for _c in range(128):
    _CLASS[_c] = _SPACE if chr(_c).isspace() or _c == 0 else _LOWER if chr(_c).islower() else _UPPER if chr(_c).isupper() else _DIGIT if chr(_c).isdigit() else _c | 128
_M = np.uint64(0x9E3779B97F4A7C15)


def _gram(h: np.ndarray, size: int, family: int) -> np.ndarray:
    """Bins of the n-grams of ``size`` neighbouring hashes."""
    if len(h) < size:
        return np.zeros(0, np.int64)
    out = h[: len(h) - size + 1]
    for i in range(1, size):
        out = mix(out * _M + h[i : len(h) - size + 1 + i])
    return (mix(out + np.uint64(family * 16 + size)) & np.uint64(BINS - 1)).astype(np.int64)


def features(text: bytes, seen: np.ndarray) -> np.ndarray:
    """Ascending bins of the n-grams that a text holds. ``seen`` is scratch space: BINS flags, all off before and after."""
    b = np.frombuffer(text, np.uint8)
    kind = _CLASS[b]
    edge = np.diff(np.concatenate([[0], (kind != _SPACE).view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(start):
        size = end - start
        word = Rolling(b, 1).at(start, size)
        upper = np.concatenate([[0], np.cumsum(kind == _UPPER)])
        ups = upper[end] - upper[start]
        mark = lambda k: np.where(size > k, kind[np.maximum(end - 1 - k, 0)], 0).astype(np.uint64)
        said = np.zeros(len(word), np.uint64)
        for back in (1, 2, 3):
            said[back:] |= (word[back:] == word[:-back]).astype(np.uint64) << np.uint64(back - 1)
        case = np.where(ups == 0, 0, np.where(2 * ups > size, 2, 1)).astype(np.uint64)
        shape = case | said << np.uint64(2) | np.minimum(size // 3, 6).astype(np.uint64) << np.uint64(6)
        for k in range(3):
            shape = shape | mark(k) << np.uint64(10 + 8 * k)
        shape |= kind[start].astype(np.uint64) << np.uint64(34)
        for at in (_gram(word, 1, 1), _gram(word, 2, 1), *(_gram(mix(shape), n, 2) for n in (1, 2, 3))):
            seen[at] = True
    if len(b) >= 3:
        c = b.astype(np.uint64)
        seen[(mix(c[:-2] << np.uint64(16) | c[1:-1] << np.uint64(8) | c[2:]) & np.uint64(BINS - 1)).astype(np.int64)] = True
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


def _margin_rows(rows: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    return np.array([weight[x].sum() / np.sqrt(max(len(x), 1)) for x in rows])


def _ratio(bad: np.ndarray, good: np.ndarray, smooth: float) -> np.ndarray:
    """Log-count ratios of the classes; 0 for indicators that no teaching row has."""
    p, q = good + smooth, bad + smooth
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[good + bad == 0] = 0.0
    return ratio


def _descend(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Weights of the hinge-loss model over scaled indicators, with the bias last, by dual coordinate descent."""
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(len(ratio) + 1), np.zeros(len(rows))
    norm = [float(ratio[x] @ ratio[x]) / max(len(x), 1) + 1.0 for x in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x = rows[i]
            v = ratio[x] / np.sqrt(max(len(x), 1))
            g = y[i] * (float(w[x] @ v) + w[-1]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                w[x] += (new - alpha[i]) * y[i] * v
                w[-1] += (new - alpha[i]) * y[i]
                alpha[i] = new
    w[:-1] *= ratio  # from now on a plain indicator's weight
    return w


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to labels (Platt 1999), by Newton's method."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        v, d = p * (1 - p) + 1e-9, p - target
        h = np.array([[(v * margin * margin).sum() + 1e-6, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, np.array([(d * margin).sum(), d.sum()]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, most_broadcast: int = 1_000_000) -> DataFrame:
    """(id, text, y) of rows that may teach: labelled, and with crc32(id as text) mod 4 other than 2."""
    known = labels.where(F.col(label).isNotNull() & (F.crc32(F.col(id_col).cast("string")) % 4 != 2))
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    if labels.limit(most_broadcast + 1).count() <= most_broadcast:
        known = F.broadcast(known)  # at most 16 MB; larger label tables are joined by a shuffle
    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("text")).join(known, "id")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = 6_000, fit_bytes: int = 256 << 20, epochs: int = 12, cost: float = 1.0, smooth: float = 0.1) -> dict:
    """A model: weights of BINS indicators and the bias, and the slope and offset of the score.

    Log-count ratios are counted over all teaching rows; the hinge-loss model is fitted to ``fit_rows`` of them, taken
    evenly by a hash of the id, and to fewer of them, by a hash of their features, where those would fill over ``fit_bytes``
    on the driver. ``smooth`` is added to every count; 0.1 has the least loss in cross-validation over teaching
    rows (of 1, 0.5, 0.25 and 0.1, at 305 and at 2,990 rows). Of several labels of an id the mean counts, a tie as 1. Without rows of both classes the model scores every text the share of label 1, or 0.5.
    """
    bound_batches(docs.sparkSession)
    rows = labelled(docs, labels, id_col, text, label)
    n = rows.count()
    share = min(1.0, fit_rows / max(n, 1)) * 1.1

    def count(batches):
        seen, ones, held, sample = np.zeros(BINS, bool), np.zeros((2, BINS), np.uint32), [0, 0], []
        for b in slices(batches, "text"):
            for t, y, take in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), b.column("take").to_pylist(), strict=True):
                x = features(t or b"", seen)
                ones[y, x] += 1
                held[y] += 1
                if take:
                    sample.append((y, x.astype("<i4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([h for h in held], pa.int64()), pa.array([ones[0].tobytes(), ones[1].tobytes()], pa.binary())], ["y", "n", "blob"])
        for i in range(0, len(sample), 500):
            part = sample[i : i + 500]
            yield pa.RecordBatch.from_arrays([pa.array([2 + y for y, _ in part], pa.int32()), pa.nulls(len(part), pa.int64()), pa.array([x for _, x in part], pa.binary())], ["y", "n", "blob"])

    def add(batches):
        ones, held = {}, {}
        for b in batches:
            for y, k, blob in zip(b.column("y").to_pylist(), b.column("n").to_pylist(), b.column("blob").to_pylist(), strict=True):
                if y < 2:
                    ones[y] = ones.get(y, 0) + np.frombuffer(blob, np.uint64 if len(blob) == 8 * BINS else np.uint32).astype(np.uint64)
                    held[y] = held.get(y, 0) + k
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.nulls(1, pa.int64()), pa.array([blob], pa.binary())], ["y", "n", "blob"])
        for y, c in ones.items():
            yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([held[y]], pa.int64()), pa.array([c.tobytes()], pa.binary())], ["y", "n", "blob"])

    kind = "y int, n long, blob binary"
    counted = materialize(rows.withColumn("take", F.xxhash64("id", F.lit(7)) % 1_000_000 < int(share * 2_000_000) - 1_000_000).select("text", "y", "take").mapInArrow(count, kind), "quality-counts")
    parts = counted.where("y < 2").repartition(16).mapInArrow(add, kind).repartition(2, "y").mapInArrow(add, kind).collect()
    sampled = counted.where("y >= 2")
    size = sampled.agg(F.sum(F.octet_length("blob"))).first()[0] or 0
    if size > fit_bytes:
        sampled = sampled.where(F.pmod(F.xxhash64("blob"), F.lit(1_000_000)) < int(fit_bytes / size * 1_000_000))
    sample = sampled.limit(2 * fit_rows).collect()
    return model_of({r.y: (r.n, np.frombuffer(r.blob, np.uint64)) for r in parts}, [(r.y - 2, np.frombuffer(r.blob, "<i4")) for r in sample], epochs, cost, smooth)


def model_of(counts: dict, sample: list, epochs: int, cost: float, smooth: float) -> dict:
    n = [counts.get(c, (0, None))[0] for c in (0, 1)]
    weight = np.zeros(BINS + 1, np.float32)
    sample.sort(key=lambda s: (s[0], s[1].tobytes()))  # whatever order the rows came in
    y = np.array([1.0 if c else -1.0 for c, _ in sample])
    if not min(n) or len(set(y.tolist())) < 2:
        share = n[1] / sum(n) if sum(n) else 0.5
        return {"weight": weight, "slope": 0.0, "offset": float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))}
    bad, good = (counts[c][1].astype(np.float64) for c in (0, 1))
    rows = [x for _, x in sample]
    balance = cost * np.where(y > 0, min(1.0, n[0] / n[1]), min(1.0, n[1] / n[0]))
    fold = np.arange(len(rows)) % 4
    left = np.zeros(len(rows))
    for f in range(4):
        inside, out = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        gone = np.zeros((2, BINS))  # what the fold counts for in the ratios goes too
        for i in out:
            gone[int(y[i] > 0), rows[i]] += 1
        w = _descend([rows[i] for i in inside], _ratio(bad - gone[0], good - gone[1], smooth), y[inside], balance[inside], epochs, f)
        left[out] = _margin_rows([rows[i] for i in out], w[:-1]) + w[-1]
    slope, offset = _curve(left, y)
    w = _descend(rows, _ratio(bad, good, smooth), y, balance, epochs, 9)
    return {"weight": w.astype(np.float32), "slope": slope, "offset": offset}


def score(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``, from 0 to 1; higher is likelier of label 1. Null and empty texts get the bias's score."""
    bound_batches(docs.sparkSession)
    base = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast((model["weight"], model["slope"], model["offset"]))  # BINS floats
    columns = base.columns

    def run(batches):
        weight, slope, offset = shared.value
        seen, bias = np.zeros(BINS, bool), float(weight[-1])
        for b in slices(batches, text):
            margin = np.zeros(len(b))
            for i, t in enumerate(b.column(text).cast(pa.binary()).to_pylist()):
                x = features(t or b"", seen)
                margin[i] = float(weight[x].sum(dtype=np.float64)) / np.sqrt(max(len(x), 1)) + bias
            s = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(s)], [*columns, out])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(out, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row. Repeated rows each get a row; a null id is not held out.

    Equal texts have equal scores. Null and empty texts get the bias's score, very long texts are read whole, other columns
    of either table are ignored whatever their names, and an empty table gives an empty result.
    """
    model = fit(docs, labels, id_col, text)
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
