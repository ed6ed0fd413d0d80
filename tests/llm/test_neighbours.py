import os

import numpy as np
import pyarrow.parquet as pq
import pytest

from strataloom.llm import neighbours


def exact(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float64)
    out = {}
    for q in ok:
        if q % 5 == 0:
            out[q] = sorted(((-float((ok[i] * ok[q]).sum()), i) for i in ok if i != q))[:k]
    return out


@pytest.mark.parametrize("shard_rows, block_rows", [(65536, 16384), (200, 40)])
def test_recall_and_scores(spark, shard_rows, block_rows):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(8) * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(2000 + i, rows[3][1]) for i in range(60)]  # a group of copies: ties go to smaller ids
    rows += [(5000, None), (5001, [0.0] * 8), (5002, [1.0] * 7 + [None]), (5003, [float("nan")] * 8), (5005, [1.0, 2.0]), (None, [1.0] * 8), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in neighbours.nearest(df, lambda i: i % 5 == 0, shard_rows=shard_rows, block_rows=block_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    want = exact(rows, 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        assert got[q] == sorted(got[q])
        hits += len({i for _, i in got[q]} & {i for _, i in best})
    assert hits >= 0.93 * 20 * len(want)


def test_few_candidates_come_whole(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 1.0]), (2, [-1.0, 0.0]), (3, [0.5, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in neighbours.nearest(df, lambda i: i == 0, budget=99).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 3, 0.5), (0, 3, 2, -1.0)]
    assert neighbours.nearest(df.limit(0), lambda i: i == 0).count() == 0
    assert neighbours.nearest(df, lambda i: i == 9).count() == 0


def test_large_ids_and_repeated_ids(spark):
    big = 2**53
    rows = [(big, [1.0, 0.0]), (big + 1, [1.0, 0.0]), (big + 2, [0.0, 1.0]), (7, [1.0, 1.0]), (7, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, score int")
    got = [tuple(r) for r in neighbours.nearest(df, lambda i: i >= big).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got if r[0] == big] == [(big, 1, big + 1), (big, 2, 7), (big, 3, big + 2)]
    assert [r[:3] for r in got if r[0] == big + 1] == [(big + 1, 1, big), (big + 1, 2, 7), (big + 1, 3, big + 2)]
    assert {r[3] for r in got if r[2] == 7} == {0.5}  # of the vectors of one id, the smallest


@pytest.mark.parametrize("table, most", [("sf0.1", 1.0), ("check_l", 0.06)])
def test_share_scored_and_recall(table, most):
    t = pq.read_table(f"/root/testdata/{table}/embeddings.parquet") if os.path.exists(f"/root/testdata/{table}") else None
    if t is None:
        pytest.skip("no such table")
    ids, x = t.column("vec_id").to_numpy(), np.array(t.column("embedding").to_pylist(), np.float64)
    asks = np.flatnonzero(ids % 20 == 0)[:200]
    forest = neighbours.Forest(x, np.append(x[:2000].mean(axis=0), 0.0), float((x * x).sum(axis=1).max()), 576, 3)
    scored, hits = 0, 0
    for i, c in zip(asks.tolist(), forest.candidates(x[asks], 2_600), strict=True):
        score = x @ x[i]
        score[i] = -np.inf
        scored += len(c)
        hits += len(set(np.argsort(-score)[:20].tolist()) & set(c.tolist()))
    recall, share = hits / 20 / len(asks), scored / len(asks) / len(x)
    print(f"{table}: recall {recall:.3f}, share scored {share:.4f}")
    assert recall >= 0.9 and share <= most
