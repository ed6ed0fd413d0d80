"""Faults that show only on larger tables, on small ones."""

import numpy as np
from pyspark.sql import functions as F

from strataloom import models
from strataloom.functions import similarity
from strataloom.operators import analytics, blocking, ledger, metrics, sanitize
from strataloom.plans.ingest_queries import _uploads
from strataloom.sources.tables import SnapshotTable
from strataloom.streaming import handoff

SMALL = "/root/testdata/sf0.001"


def most_rows(df):
    """The most rows that any node of the plan of ``df`` puts out, after a run."""
    df.collect()

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        if name == "ReusedExchangeExec":
            return walk(plan.child())
        m = plan.metrics().get("numOutputRows")
        below = [walk(plan.children().apply(i)) for i in range(plan.children().length())]
        return max([m.get().value() if m.isDefined() else 0, *below])

    return walk(df._jdf.queryExecution().executedPlan())


def test_drain_goes_on_after_full_batches(spark, tmp_path):
    up = _uploads(spark, SMALL).where("id < 30")
    n = up.where("status = 'pending'").count()
    now = F.lit("2024-01-01").cast("timestamp")
    for limit in (None, 2):
        table = SnapshotTable(spark, f"file://{tmp_path}/uploads-{limit}", ledger.UPLOADS)
        table.publish(up)
        assert handoff.drain(table, lambda todo: todo.select("id", F.lit("downloaded").alias("status"), F.lit(None).alias("error")), now, limit) == n > 4
        assert not table.read().where("status = 'pending'").count()
    table.publish(up)
    assert handoff.drain(table, lambda todo: todo.where("false").select("id", "status", "error"), now) == n  # none moves, and it ends


def test_transition_broadcasts_no_errors(spark):
    up = _uploads(spark, SMALL)
    out = ledger.transition(up, up.select("id", F.lit("failed").alias("status"), F.repeat(F.lit("x"), 5000).alias("error")), F.lit("2024-01-01").cast("timestamp"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_ties_at_the_cap_are_settled(spark):
    e = spark.createDataFrame([("d", 1, 1, f"t{i}", "Doc", "has_source", {}, "Topic", "Source") for i in range(9)], "doc_id string, chunk_pos long, edge_pos long, src string, dst string, type string, props map<string,string>, src_label string, dst_label string")
    types = spark.createDataFrame([], "doc_id string, chunk_pos long, topic string, types array<string>")
    for seed in range(3):
        got = sanitize.check_edges(e.orderBy(F.rand(seed)).repartition(5), types)
        assert sorted(r.src for r in got.collect()) == ["t0", "t1", "t2"]


def test_nearest_equals_a_full_sort(spark):
    rnd = np.random.default_rng(5)
    y = rnd.normal(size=(700, 16)).astype(np.float32)
    y[100:400] = y[7]  # more copies than k
    y[400:420] = 2 * y[3]
    x = np.concatenate([y[:40], y[395:405], rnd.normal(size=(50, 16)).astype(np.float32)])
    places, scores = blocking._nearest(x, y, 5, rows=32, columns=64)
    unit = lambda v: v / np.sqrt((v.astype(float) ** 2).sum(axis=1, keepdims=True))
    s = (1 + unit(x) @ unit(y).T) / 2
    want = np.argsort(-np.round(s, 12), axis=1, kind="stable")[:, :5]
    assert (places == want).all() and np.allclose(scores, np.take_along_axis(s, want, 1), atol=1e-12)
    assert (blocking._nearest(x, y[:3], 5)[0][:, 3:] == -1).all()


def test_a_group_of_equal_names_is_parted(spark):
    d = spark.range(60).select("id", F.lit("s").alias("source"), F.when(F.col("id") < 50, "hot").otherwise(F.col("id").cast("string")).alias("topic"), F.lit("t").alias("type"))
    got = sorted((r.a, r.b) for r in blocking.exact_pairs(d, None, chunk_rows=8).collect())
    assert got == [(a, b) for a in range(50) for b in range(a + 1, 50)]


def test_merge_shuffles_no_exact_pairs(spark):
    from strataloom.plans.conflict_queries import _merged

    plan = _merged(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "BroadcastHashJoin" in plan


def test_gold_rows_of_a_node_do_not_meet_all_its_edges(spark):
    e = spark.range(200).select(F.lit("Hub").alias("src"), F.concat(F.lit("Leaf"), "id").alias("dst"), F.lit("Uses").alias("relation"))
    nodes = e.select(F.col("dst").alias("id")).union(spark.sql("select 'Hub' as id"))
    gold = spark.range(200).select("id", F.col("id").cast("string").alias("gold_id"), F.array(F.concat(F.lit("leaf"), F.col("id") * 2), F.lit("none")).alias("source_any"), F.array(F.lit("hub")).alias("target_any"), F.lit("uses").alias("relation"))
    out = metrics.relation_recall(gold, e, nodes)
    assert tuple(out.first()) == (100, 200, 0.5)
    assert most_rows(out) <= 1000
    assert tuple(metrics.relation_recall(gold.where("false"), e, nodes).first()) == (0, 0, 1.0)


def test_betweenness_does_not_meet_all_edges_into_a_node(spark, monkeypatch):
    pairs = [(f"r{i}", "m") for i in range(30)] + [("m", f"k{i}") for i in range(3)] + [(f"q{i}", f"k{j}") for i in range(60) for j in range(3)]
    rows = []
    keep = analytics.materialize

    def noted(df, name="stage"):
        if name == "betweenness":
            rows.append(most_rows(df))
        return keep(df, name)

    monkeypatch.setattr(analytics, "materialize", noted)
    got = {r.id: r.betweenness for r in analytics.betweenness(spark.createDataFrame(pairs, "src string, dst string"), normalized=False).collect()}
    assert got["m"] == 90 and sum(got.values()) == 90
    assert max(rows) <= len(pairs)


def test_turns_of_moves_write_nothing(spark, monkeypatch):
    rnd, written = np.random.default_rng(3), []
    pairs = [(f"n{g * 8 + a}", f"n{g * 8 + b}") for g in range(6) for a, b in rnd.integers(0, 8, (30, 2))] + [(f"n{a}", f"n{b}") for a, b in rnd.integers(0, 48, (12, 2))]
    keep = analytics.materialize
    monkeypatch.setattr(analytics, "materialize", lambda df, name="stage": (written.append(name), keep(df, name))[1])
    found = {r.id: r.community for r in analytics.leiden(spark.createDataFrame(pairs, "src string, dst string")).collect()}
    assert len(written) < 16  # a few a level
    assert 4 <= len(set(found.values())) <= 8 and all(found[c] == c for c in found.values())
    h = [tuple(r) for r in spark.range(40).select(F.xxhash64("id"), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2)) == 0).collect()]
    assert analytics._halves(np.array([x for x, _ in h]), 9).tolist() == [y for _, y in h]


def test_prompts_come_in_batches_of_bounded_bytes(spark):
    class Echo:
        def complete(self, prompt):
            return "ok"

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    models.ask(spark.range(3).select("id", F.lit("p").alias("prompt")), Echo(), "id", "prompt").collect()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 16 << 20


def test_pagerank_reads_edges_as_lists(spark, monkeypatch):
    wide, keep = [], analytics.materialize
    monkeypatch.setattr(analytics, "materialize", lambda df, name="stage": (wide.append(df.columns), keep(df, name))[1])
    ranks = {r.id: r.rank for r in analytics.pagerank(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 3), (1, 3)], "src long, dst long"), iterations=30).collect()}
    assert abs(sum(ranks.values()) - 1) < 1e-9 and ranks[3] > ranks[1] > ranks[2]
    assert ["src", "dst"] not in wide and ["src", "to", "deg"] in wide


def test_ratio_above_agrees_with_difflib():
    import difflib
    import random

    rnd = random.Random(7)
    seen = set()
    for n in (0, 3, 40, 300, 900):
        for edits in (0, 1, n // 40, n // 8, n):
            a = "".join(rnd.choice("aabbcdefghij klmnopqrstuvwxyzQZ") for _ in range(n))
            b = list(a)
            for _ in range(edits):
                at = rnd.randrange(len(b) + 1)
                b[at : at + rnd.randrange(3)] = rnd.choice("xyzQ") * rnd.randrange(3)
            b = "".join(b)
            ratio = difflib.SequenceMatcher(None, a, b).ratio()
            for least in (0.5, 0.9, 0.95, ratio, 1.0):
                assert similarity.ratio_above(a, b, least) == (ratio > least)
                seen.add((least, ratio > least))
    assert len(seen) > 12


def test_ratio_ends_once_it_is_settled(monkeypatch):
    calls = []
    find = similarity._Matcher.find_longest_match
    monkeypatch.setattr(similarity._Matcher, "find_longest_match", lambda *x: (calls.append(1), find(*x))[1])
    words = [f"w{i * 7919 % 1000}" for i in range(400)]
    assert not similarity.ratio_above(" ".join(words), " ".join(words[200:] + words[:200]), 0.95)
    assert not similarity.ratio_above("x" * 300, "y" * 300, 0.95)
    assert len(calls) <= 2


def test_steps_of_the_sanitizer_with_nothing_to_do_give_what_they_got(spark):
    n = spark.createDataFrame([("d", 0, 0, "a part", "Topic", {})], sanitize.NODES)
    e = spark.createDataFrame([("d", 0, 0, "a part", "b", "has_x", {})], sanitize.EDGES)
    none = sanitize.topic_aliases(n, 1.1)
    assert none.isEmpty() and "FlatMapGroupsInPandas" not in none._jdf.queryExecution().executedPlan().toString()
    assert sanitize.redirect(n, e, none) == (n, e) and sanitize.drop_blank(n, e) == (n, e)
