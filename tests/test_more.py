import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.config import Settings
from strataloom.operators import analytics, ledger
from strataloom.plans import catalogue
from strataloom.plans.conflict_queries import similar_texts
from strataloom.sources import graphs
from strataloom.streaming import handoff


def test_settings():
    s = Settings.from_env({"STRATALOOM_KNN": "4", "STRATALOOM_SIMILARITY_FLOOR": "", "STRATALOOM_EMBED_WITH_TOPIC": "yes", "STRATALOOM_SWEEP_SECONDS": "0"})
    assert (s.knn, s.similarity_floor, s.embed_with_topic, s.sweep_seconds) == (4, None, True, 10**9)
    assert Settings.from_env({}) == Settings()
    with pytest.raises(ValueError):
        Settings.from_env({"STRATALOOM_KNN": "many"})


def test_measures_fail_alone(spark, monkeypatch):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")

    def broken(e, v):
        raise RuntimeError("no luck")

    monkeypatch.setitem(analytics.MEASURES, "closeness", broken)
    m, errors = analytics.node_metrics(e, analytics.nodes_of(e), ("closeness", "community_louvain", "community_leiden"))
    assert set(errors) == {"closeness"} and m.columns == ["id", "community_louvain", "community_leiden"] and m.count() == 3
    assert {r.name for r in analytics.graph_metrics(e, m).collect()} == {"modularity_louvain", "modularity_leiden"}
    with pytest.raises(NotImplementedError):
        analytics.graph_metrics(e, m.select("id"))


def test_graph_files(spark, tmp_path):
    nodes = spark.createDataFrame([("d", "deep_nets", "Topic"), ("d", "other", "Topic")], "doc_id string, id string, label string")
    edges = spark.createDataFrame([("d", "deep_nets", "other", "relates_to", {"relation": "uses"})], "doc_id string, src string, dst string, type string, props map<string,string>")
    graphs.dump(nodes, edges, "m", str(tmp_path / "g"))
    n, e = graphs.load(spark, str(tmp_path / "g"))
    assert {r.id for r in n.collect()} == {"Deep Nets", "Other"}
    assert [(r.src, r.dst, r.relation) for r in e.collect()] == [("Deep Nets", "Other", "uses")]


def test_native_chunks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(x) for x in ({"text": "<b>long enough</b> text", "index": 7}, {"text": "also long enough text", "chunk_index": 3}, {"text": "no index but long enough"}, {"text": "<p>short</p>"})))
    (tmp_path / "b.json").write_text(json.dumps({"chunks": [{"text": "packed and long enough"}]}))
    got = sorted((r.file[-7:], r["index"], r.text) for r in graphs.native_chunks(spark, str(tmp_path)).collect())
    assert got == [("/b.json", 0, "packed and long enough"), ("a.jsonl", 2, "no index but long enough"), ("a.jsonl", 3, "also long enough text"), ("a.jsonl", 7, "long enough text")]


def test_offers(spark):
    files = spark.createDataFrame([("p", bytearray(b"x"), "d", 1, True), ("q", bytearray(b"y"), "e", 1, True)], "path string, content binary, doc_id string, n_chunks long, ok boolean")
    empty = spark.createDataFrame([], ledger.UPLOADS)
    rows = handoff.offer(files, empty, "inbox/", "paper").orderBy("doc_id").collect()
    assert [r.storage_path for r in rows] == ["inbox/d__2d711642.jsonl", "inbox/e__a1fce436.jsonl"]
    known = empty.unionByName(spark.createDataFrame(rows[:1]).withColumn("id", F.lit(1)), allowMissingColumns=True)
    assert [r.doc_id for r in handoff.offer(files, known, "inbox", "paper").collect()] == ["e"]
    with pytest.raises(ValueError):
        handoff.offer(files.withColumn("ok", F.col("doc_id") == "d"), empty, "inbox", "paper")


def test_similar_texts_are_all_pairs(spark):
    """Long texts, and edits among the first words, count like any other."""
    rng = random.Random(4)
    rows = []
    for n in (2, 12, 12, 60, 60, 400, 1500):
        w = [f"w{rng.randrange(500)}" for _ in range(n)]
        for k in range(4):
            v = list(w)
            for _ in range(k * n // 25):
                v[rng.randrange(n)] = "other"
            rows += [" ".join(v), " ".join(["new", *v[1:]])]
    rows += [None, "", " \t", "one", "one"]
    sets = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if (w := (t or "").split()) else set() for t in rows]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if sets[i] and 2 * len(sets[i] & sets[j]) >= len(sets[i] | sets[j])}
    got = similar_texts(spark.createDataFrame(list(enumerate(rows)), "id long, text string")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(len(rows[i]) > 3000 and rows[i][:30] != rows[j][:30] for i, j in want)


def test_graph_queries_read_all_line_items(spark, tmp_path):
    """Every supplier and part is a node; closeness and betweenness of that graph against all pairs by breadth-first search."""
    rng = random.Random(3)
    items = [(k, rng.randrange(1, 60), rng.randrange(1, 120), rng.choice("ANR")) for k in range(1, 150)]
    spark.createDataFrame(items, "l_orderkey long, l_suppkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    edges = {(-s, p) for _, s, p, _ in items} | {(p, -s) for _, s, p, r in items if r == "R"}
    nodes = {x for e in edges for x in e}
    out = {v: [b for a, b in edges if a == v] for v in nodes}
    dist, ways = {}, {}
    for v in nodes:
        d, n, level = {v: 0}, {v: 1}, [v]
        while level:
            after = []
            for x in level:
                for y in out[x]:
                    if y not in d:
                        d[y], n[y] = d[x] + 1, 0
                        after.append(y)
                    if d[y] == d[x] + 1:
                        n[y] += n[x]
            level = after
        dist[v], ways[v] = d, n
    near, between = dict.fromkeys(nodes, 0.0), dict.fromkeys(nodes, 0.0)
    for v in nodes:
        to = [dist[u][v] for u in nodes if u != v and v in dist[u]]
        near[v] = len(to) / sum(to) * len(to) / (len(nodes) - 1) if to else 0.0
        for s in nodes - {v}:
            for t in dist[s].keys() - {s, v}:
                if v in dist[s] and t in dist[v] and dist[s][v] + dist[v][t] == dist[s][t]:
                    between[v] += ways[s][v] * ways[v][t] / ways[s][t] / ((len(nodes) - 1) * (len(nodes) - 2))
    q = catalogue.QUERIES
    graph = spark.createDataFrame(sorted(edges), "src long, dst long")
    assert {r.id: r.closeness for r in analytics.closeness(graph).collect()} == pytest.approx(near, abs=1e-8)
    assert {r.id: r.betweenness for r in analytics.betweenness(graph).collect()} == pytest.approx(between, abs=1e-8)
    for name in ("pagerank", "louvain", "leiden"):
        assert {r.id for r in q[name](spark, str(tmp_path)).collect()} == nodes


def test_recall_and_invariants_read_all_rows(spark, tmp_path):
    """Rows of high ids count, and gold is benchmark items against documents."""
    put = lambda name, rows, kind: spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    put("lineitem", [(5000, 1, 700, "R", "F"), (5001, 2, 701, "A", "F"), (5002, 3, 702, "N", "O")], "l_orderkey long, l_suppkey long, l_partkey long, l_returnflag string, l_linestatus string")
    put("supplier", [(1,), (2,), (3,), (10,)], "s_suppkey long")
    put("benchmark", [(1, "What is the sum?"), (2, "Never asked at all")], "item_id long, text string")
    put("documents", [(7, "so: what is THE sum, then"), (8, None)], "doc_id long, text string")
    q, at = catalogue.QUERIES, str(tmp_path)
    assert [tuple(r)[:2] for r in q["relation_recall"](spark, at).collect()] == [(2, 3)]
    assert [tuple(r)[:2] for r in q["gold_recall"](spark, at).collect()] == [(1, 2)]
    got = sorted(map(tuple, q["invariant_violations"](spark, at).collect()))
    assert got == sorted([("endpoint_type", k) for k in ("700", "700", "701", "702")] + [("two_cycle", "1")])


def test_registered_pairs_have_fifteen_neighbours(spark):
    at = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{at}/embeddings.parquet").orderBy("vec_id").collect()
    v = np.array([r.embedding for r in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    score = np.round((1 + v @ v.T) / 2, 12)
    want = set()
    for i in range(len(rows)):
        for j in np.lexsort((np.arange(len(rows)), -score[i]))[:16]:
            if i != j and rows[i].label == rows[j].label and score[i, j] >= 0.6:
                want.add(tuple(sorted((rows[i].vec_id, rows[j].vec_id))))
    assert {(r.a, r.b) for r in catalogue.QUERIES["s2_pairs"](spark, at).collect()} == want
