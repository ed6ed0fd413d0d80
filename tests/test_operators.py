import itertools
import random

import pytest
from pyspark.sql import functions as F

from strataloom import models
from strataloom.operators import analytics, blocking, build, conflict, gates, ledger, metrics
from strataloom.operators.components import connected_components
from strataloom.plans.ingest_queries import _uploads
from strataloom.sources.tables import SnapshotTable
from strataloom.streaming import handoff


def edges(spark, pairs, kind="string"):
    return spark.createDataFrame(pairs, f"src {kind}, dst {kind}")


def by_id(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_components_of_chains_stars_and_rings(spark):
    rnd = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(900, 901), (901, 902), (902, 900), (7, 7), (None, 3)] + [(rnd.randint(2000, 2060), rnd.randint(2000, 2060)) for _ in range(40)]
    rnd.shuffle(pairs)
    low = {}
    for a, b in pairs:
        if a is not None:
            low.setdefault(a, a)
            low.setdefault(b, b)
    for _ in pairs:
        for a, b in pairs:
            if a is not None:
                low[a] = low[b] = min(low[a], low[b])
    assert by_id(connected_components(edges(spark, pairs, "long")), "component") == low
    assert connected_components(edges(spark, [], "long")).count() == 0


def test_pagerank_of_a_ring_and_with_a_dead_end(spark):
    ring = by_id(analytics.pagerank(edges(spark, [("a", "b"), ("b", "c"), ("c", "a")]), iterations=20), "rank")
    assert all(abs(v - 1 / 3) < 1e-9 for v in ring.values())
    dead = by_id(analytics.pagerank(edges(spark, [("a", "b")]), iterations=60, tolerance=1e-9), "rank")
    assert abs(sum(dead.values()) - 1) < 1e-6 and dead["b"] > dead["a"]


def test_path_centralities(spark):
    path = edges(spark, [("a", "b"), ("b", "c"), ("c", "d")])
    between = by_id(analytics.betweenness(path, normalized=False), "betweenness")
    assert between == {"a": 0.0, "b": 2.0, "c": 2.0, "d": 0.0}
    close = by_id(analytics.closeness(path), "closeness")
    assert close["a"] == 0 and abs(close["d"] - 3 / 6) < 1e-12 and abs(close["c"] - 2 / 3 * 2 / 3) < 1e-12
    diamond = by_id(analytics.betweenness(edges(spark, [("s", "x"), ("s", "y"), ("x", "t"), ("y", "t")]), normalized=False), "betweenness")
    assert diamond["x"] == diamond["y"] == 0.5


def test_communities_of_two_triangles(spark):
    tri = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", "z"), ("z", "x"), ("c", "x")]
    for found in (analytics.louvain(edges(spark, tri)), analytics.leiden(edges(spark, tri))):
        got = by_id(found, "community")
        assert got["a"] == got["b"] == got["c"] and got["x"] == got["y"] == got["z"] and got["a"] != got["x"]
    part = analytics.louvain(edges(spark, tri))
    q = analytics.modularity(edges(spark, tri), part).first().modularity
    assert abs(q - (6 / 7 - 2 * (7 / 14) ** 2)) < 1e-12


def test_communities_never_lower_modularity(spark):
    rnd = random.Random(5)
    e = edges(spark, list({(f"n{a:02}", f"n{b:02}") for a, b in ((rnd.randint(0, 30), rnd.randint(0, 30)) for _ in range(90)) if a != b}))
    for directed, find in ((False, analytics.louvain), (True, analytics.leiden)):
        q = analytics.modularity(e, find(e), directed).first().modularity
        alone = analytics.modularity(e, analytics.nodes_of(e).select("id", F.col("id").alias("community")), directed).first().modularity
        assert q > max(alone, 0.15)


def best_modularity(pairs, directed):
    """Over all partitions of a small graph."""
    nodes = sorted({x for p in pairs for x in p})
    arcs = set(pairs) if directed else set(pairs) | {(b, a) for a, b in pairs}
    m, best = len(arcs), -1.0

    def split(i, of, used):
        nonlocal best
        if i == len(nodes):
            inside = sum(of[a] == of[b] for a, b in arcs)
            spread = sum(sum(of[a] == c for a, _ in arcs) * sum(of[b] == c for _, b in arcs) for c in range(used))
            best = max(best, inside / m - spread / m**2)
            return
        for c in range(used + 1):
            split(i + 1, {**of, nodes[i]: c}, max(used, c + 1))

    split(0, {}, 0)
    return best


def test_communities_against_all_partitions(spark):
    """Small graphs on which every partition can be tried: both methods come within a twentieth of the best one."""
    rnd = random.Random(2)
    for n, p in ((7, 0.35), (8, 0.4)):
        names = [f"n{i}" for i in range(n)]
        pairs = [q for q in itertools.combinations(names, 2) if rnd.random() < p]
        e = edges(spark, pairs)
        for directed, find in ((False, analytics.louvain), (True, analytics.leiden)):
            part = find(e)
            got = by_id(part, "community")
            assert all(got[c] == c and c == min(i for i in got if got[i] == c) for c in set(got.values()))
            assert analytics.modularity(e, part, directed).first().modularity >= best_modularity(pairs, directed) - 0.05


def test_leiden_communities_are_connected(spark):
    rnd = random.Random(9)
    pairs = list({(f"n{a:02}", f"n{b:02}") for a, b in ((rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(70)) if a != b})
    got = by_id(analytics.leiden(edges(spark, pairs)), "community")
    for c in set(got.values()):
        inside = {i for i in got if got[i] == c}
        seen, todo = {c}, [c]
        while todo:
            x = todo.pop()
            near = {b for a, b in pairs if a == x} | {a for a, b in pairs if b == x}
            todo += (near & inside) - seen
            seen |= near & inside
        assert seen == inside


def brute_cliques(pairs):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    all_ = [set(c) for n in range(2, len(near) + 1) for c in itertools.combinations(sorted(near), n) if all(y in near[x] for x, y in itertools.combinations(c, 2))]
    return sorted(sorted(c) for c in all_ if not any(c < d for d in all_))


def test_cliques(spark):
    rnd = random.Random(8)
    for pairs in ([("a", "b")], [("a", "b"), ("b", "c")], [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("c", "e")], list(itertools.combinations("abcdef", 2)), [p for p in itertools.combinations("abcdefghij", 2) if rnd.random() < 0.5]):
        found = conflict.maximal_cliques(spark.createDataFrame(pairs, "a string, b string"))
        assert sorted(r.ids for r in found.collect()) == brute_cliques(pairs)
    six = spark.createDataFrame([(None, [*"fedcba"]), (None, [*"abcdeg"])], "component string, ids array<string>")
    assert [r.ids for r in conflict.clusters(six).collect()] == [[*"abcde"]]


def test_neighbours_in_blocks_are_those_of_one_block(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(5)]) for i in range(90)] + [(200, [0.0] * 5), (201, None)]
    v = spark.createDataFrame(rows, "id long, embedding array<double>")
    one = sorted((r.a, r.b, round(r.score, 9)) for r in blocking.top_neighbours(v, 4).collect())
    many = sorted((r.a, r.b, round(r.score, 9)) for r in blocking.top_neighbours(v, 4, block_rows=20).collect())
    assert one == many and len(one) == 90 * 4


def test_gate_order_and_ratio(spark):
    long, near = "the quick brown fox jumps over the lazy dog again", "the quick brown fox jumps over the lazy dog agaim"
    rows = [(1, "short", long, "t", "t", "s", "s"), (2, long, near, "data", "t", "s", "s"), (3, long, near, "t", "t", "s", "s"), (4, long, near, "t", "t", "s", "r"), (5, long, long[::-1], "t", "t", "s", "s"), (6, None, long, "t", "t", None, None)]
    df = spark.createDataFrame(rows, "k int, text_a string, text_b string, topic_a string, topic_b string, source_a string, source_b string")
    got = {r.k: r.reason for r in gates.rule_gates(df).collect()}
    assert got == {1: "degenerate_text", 2: "generic_topic", 3: "intra_doc_duplicate", 4: None, 5: None, 6: "degenerate_text"}


def test_recall_of_an_empty_gold_set(spark):
    none = spark.createDataFrame([], "gold_id string, alias string")
    assert metrics.entity_recall(none, spark.createDataFrame([("A",)], "id string")).first().recall == 1.0


def test_retries():
    waits = []
    client = models.ScriptedCompleter({"q": {"a": 1}}, failures=2, error="429 rate limit")
    assert models.with_retries(lambda: client.complete("q"), sleep=waits.append) == ('{"a": 1}', None, 3) and waits == [65.0, 65.0]
    client = models.ScriptedCompleter({}, failures=9)
    reply, error, n = models.with_retries(lambda: client.complete("q"), sleep=waits.append)
    assert reply is None and "connection reset" in error and n == 5 and waits[2:] == [30.0] * 4


def test_build_from_chunks_to_stored_graph(spark):
    graph = {"nodes": [{"id": "deep_nets", "type": "Topic", "properties": {}}, {"id": "Method", "type": "Type", "properties": {}}, {"id": "p1.pdf", "type": "Source", "properties": {"date": "2021"}}],
             "relationships": [{"source": "deep_nets", "target": "Method", "type": "has_method", "properties": {}}, {"source": "deep_nets", "target": "p1.pdf", "type": "has_source", "properties": {}}]}
    import json

    chunks = spark.createDataFrame([("d1", "p1.pdf", "pdf", 0, "about nets", True), ("d1", "p1.pdf", "pdf", 1, "skip me", False), ("d1", "p1.pdf", "pdf", 2, "bad reply", True)], "filename string, source string, source_kind string, chunk_pos long, text string, eligible boolean")
    client = models.ScriptedCompleter({"about nets": "```json\n" + json.dumps(graph) + "\n```", "bad reply": "no json here"})
    raw = build.extract(chunks, client)
    rows = {r.chunk_pos: r for r in raw.collect()}
    assert set(rows) == {0, 2} and rows[0].error is None and rows[2].error == "no graph in the reply"
    nodes, edges_ = build.sanitized(raw, spark.createDataFrame([("d1", "p1.pdf", "pdf")], "doc_id string, source_name string, source_kind string"))
    now = F.lit("2024-01-01").cast("timestamp")
    stored = build.store_nodes(spark.createDataFrame([], build.NODES), nodes, now)
    assert {(r.label, r.id) for r in stored.collect()} == {("Topic", "Deep Nets"), ("Type", "Method"), ("Source", "P1 Pdf")}
    again = build.store_nodes(stored, nodes, F.lit("2025-01-01").cast("timestamp"))
    assert sorted(map(str, again.collect())) == sorted(map(str, stored.collect()))
    e = build.store_edges(spark.createDataFrame([], build.EDGES), edges_)
    assert {r.type for r in e.collect()} == {"HAS_TYPE", "HAS_SOURCE"}
    dated = build.set_properties(stored, build.producer_metadata(spark.createDataFrame([("p1.pdf", "1999-05-01")], "source_name string, date string")))
    assert {r.id: r.props.get("year") for r in dated.collect() if r.label == "Source"} == {"P1 Pdf": "1999"}


def test_embedding_only_what_is_missing(spark):
    d = spark.createDataFrame([("a", "text", "t", "Result", None), ("b", "text", "t", "Method", None), ("c", "x", "t", "Result", [1.0])], "id string, text string, topic string, type string, embedding array<float>")
    got = {r.id: r.embedding for r in models.embed_missing(d, models.HashEmbedder(4), ["Result"]).collect()}
    assert len(got["a"]) == 4 and got["b"] is None and got["c"] == [1.0]
    with pytest.raises(Exception, match="components"):
        models.embed_missing(d, models.HashEmbedder(4), ["Result"], size=8).collect()


def test_drain_is_idempotent_and_checks_files(spark, tmp_path):
    import hashlib
    import json

    store = tmp_path / "store"
    store.mkdir()
    good = json.dumps({"text": "hello", "doc_id": "d", "index": 0, "source_kind": "pdf"}).encode()
    payload = json.dumps({"metadata": {"meeting_id": "m-20240101-101010-x"}, "chunks": [{"chunk_id": "1", "text": "hi"}]}).encode()
    files = {"good.jsonl": good, "bad.jsonl": b"{oops", "meeting.json": payload}
    for name, data in files.items():
        (store / name).write_bytes(data)
    sha = lambda n: hashlib.sha256(files[n]).hexdigest()
    rows = [(1, "paper", "d", None, "in/good.jsonl", sha("good.jsonl"), 1, "pending"), (2, "paper", "e", None, "in/bad.jsonl", sha("bad.jsonl"), 1, "pending"), (3, "paper", "f", None, "in/good.jsonl", "0" * 64, 1, "pending"), (4, "meeting", "g", None, "in/meeting.json", sha("meeting.json"), 1, "pending"), (5, "meeting", "h", None, "in/none.json", "0" * 64, 1, "pending")]
    up = spark.createDataFrame([(*r, None, None, None, None) for r in rows], ledger.UPLOADS)
    table = SnapshotTable(spark, f"file://{tmp_path}/uploads", ledger.UPLOADS)
    table.publish(up)
    now = F.lit("2024-01-01").cast("timestamp")
    check = lambda todo: handoff.check_files(spark, todo, str(store))
    assert handoff.drain(table, check, now) == 5
    got = {r.id: (r.status, r.error) for r in table.read().collect()}
    assert got == {1: ("downloaded", None), 2: ("failed", "invalid: 1 errors"), 3: ("failed", "digest mismatch"), 4: ("downloaded", None), 5: ("failed", "no such object")}
    v = table.version()
    assert handoff.drain(table, check, now) == 0 and table.version() == v


def test_supervisor_doubles_its_wait():
    waits, runs = [], iter([1, 1, 1, 0, 1])
    left = iter([False] * 5 + [True])

    def run():
        if next(runs):
            raise RuntimeError

    handoff.supervise(run, lambda: next(left), waits.append)
    assert waits == [1.0, 2.0, 4.0, 1.0]


def test_row_order_and_partitions_change_nothing(spark):
    up = _uploads(spark, "/root/testdata/sf0.001")
    a = [r.id for r in ledger.uploads_pending(up, 10).collect()]
    assert a == [r.id for r in ledger.uploads_pending(up.orderBy(F.rand(3)).repartition(7), 10).collect()]
