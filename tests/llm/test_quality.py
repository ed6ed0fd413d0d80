import random
import zlib

import numpy as np

from strataloom.llm import quality

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert len(got) == docs.count()
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert np.mean([s >= 0.7 for s in good]) > 0.97 and np.mean([s >= 0.7 for s in bad]) < 0.2


def test_labels_of_held_out_rows_are_never_used(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    kept = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
    a, b = (quality.fit(docs, x, fit_rows=200) for x in (labels, kept))
    assert (a["weight"] == b["weight"]).all() and a["slope"] == b["slope"]


def test_odd_tables(spark):
    schema = "doc_id long, text string, score double, y int, id string"
    docs = spark.createDataFrame([(1, None, 0.0, 1, ""), (2, "", 0.0, 1, ""), (None, "x " * 50000, 0.0, 1, ""), (2, "", 0.0, 1, "")], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(1, 9)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    got = quality.quality(docs, ones).collect()
    assert len(got) == 4 and all(r.score > 0.9 for r in got)
    assert quality.quality(docs.limit(0), ones).count() == 0


def test_features_are_indicators_of_the_text_alone():
    seen = np.zeros(quality.BINS, bool)
    rnd = random.Random(0)
    for _ in range(50):
        t = " ".join(rnd.choices(["Alpha", "beta!!", "x", "99", "é"], k=rnd.randint(0, 9))).encode()
        a = quality.features(t, seen)
        assert not seen.any() and (np.diff(a) > 0).all()
        assert (quality.features(t, seen) == a).all()
    assert len(quality.features(b"", seen)) == len(quality.features(b" \n", seen)) == 0


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 8)) + (100 if i % 2 else 0) for i in range(200)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(200)])
    w = quality._descend(rows, np.ones(150), y, np.ones(200), 10, 0)
    margin = quality._margin_rows(rows, w[:-1]) + w[-1]
    assert (np.sign(margin) == y).all()


def test_weights_are_those_of_a_plain_version(spark):
    """Ratios, hinge-loss weights and scores computed anew, from sets and dictionaries."""
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices(["good", "fine", "well"] if i % 2 else ["bad", "junk", "$$"], k=rnd.randint(3, 9)) + ["the", "a"]), i % 2) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, epochs=3)
    seen = np.zeros(quality.BINS, bool)
    teach = [(set(quality.features(t.encode(), seen).tolist()), y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    count = [{}, {}]
    for x, y in teach:
        for f in x:
            count[y][f] = count[y].get(f, 0) + 1
    total = [sum(c.values()) + 0.1 * quality.BINS for c in count]
    ratio = {f: np.log((count[1].get(f, 0) + 0.1) / total[1]) - np.log((count[0].get(f, 0) + 0.1) / total[0]) for f in {*count[0], *count[1]}}
    n = [sum(y == c for _, y in teach) for c in (0, 1)]
    cost = {1: min(1.0, n[0] / n[1]), 0: min(1.0, n[1] / n[0])}
    order = sorted(teach, key=lambda s: (s[1], np.array(sorted(s[0]), "<i4").tobytes()))
    w, bias, alpha, rng = dict.fromkeys(ratio, 0.0), 0.0, [0.0] * len(order), np.random.default_rng(9)
    for _ in range(3):
        for i in rng.permutation(len(order)):
            x, y = order[i]
            sign, norm = (1 if y else -1), sum(ratio[f] ** 2 for f in x) / len(x) + 1
            g = sign * (sum(w[f] * ratio[f] for f in x) / len(x) ** 0.5 + bias) - 1
            new = min(max(alpha[i] - g / norm, 0.0), cost[y])
            for f in x:
                w[f] += (new - alpha[i]) * sign * ratio[f] / len(x) ** 0.5
            bias += (new - alpha[i]) * sign
            alpha[i] = new
    assert abs(float(model["weight"][-1]) - bias) < 1e-5
    assert max(abs(float(model["weight"][f]) - w[f] * ratio[f]) for f in w) < 1e-5


def test_what_is_fitted_is_bounded_in_bytes(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    seen, real = [], quality.model_of
    monkeypatch.setattr(quality, "model_of", lambda counts, sample, *more: seen.append(sum(x.nbytes for _, x in sample)) or real(counts, sample, *more))
    quality.fit(docs, labels, fit_bytes=200_000)
    quality.fit(docs, labels)
    assert 0 < seen[0] < 300_000 < seen[1]
