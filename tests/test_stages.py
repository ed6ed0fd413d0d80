from pyspark.sql import functions as F

from strataloom import models
from strataloom.operators import blocking, conflict, stages
from strataloom.sources.tables import SnapshotTable

TEXT = "the method under test improves the measured outcome by a wide margin, case "


def test_the_conflict_pass_and_its_second_run(spark, tmp_path):
    rows = [(f"d{i}|s{i}", f"s{i}", "Robots", "Result", TEXT + str(i), None) for i in range(4)] + [("m|s0", "s0", "Robots", "Method", "indoors only", None)] + [("x|s9", "s9", "Data", "Result", TEXT + "x", None), ("y|s9", "s9", "Data", "Result", TEXT + "y", None)]
    d = spark.createDataFrame(rows, "id string, source string, topic string, type string, text string, embedding array<double>")
    sources = spark.createDataFrame([("s0", "2019"), ("s1", "2021"), ("s2", "2021"), ("s3", "2021"), ("s9", None)], "id string, year string")
    table = lambda n, s: SnapshotTable(spark, f"file://{tmp_path}/{n}", s)
    pairs, edges = table("pairs", blocking.CANDIDATES), table("supersedes", stages.SUPERSEDES)
    records, nodes, claims = table("records", stages.CLUSTERS), table("nodes", stages.CONTRADICTIONS), table("claims", stages.CLAIM_EDGES)
    log = tmp_path / "calls"
    client = models.ScriptedCompleter({
        "contradict each other": {"label": "contradiction", "confidence": 0.9, "rationale": "r"},
        "case 0\nNewer (2021): " + TEXT + "1": {"decision": "yes", "basis": "explicit_correction", "reason": "r", "confidence": 0.9},
        "replace the older one": {"decision": "no", "reason": "r", "confidence": 0.9},
        "oppose each other at all": {"resolution_type": "known_controversy", "summary": "they differ", "confidence": 0.8, "evidence_used": ["t"], "positions": []},
    }, log=str(log))

    def run(day):
        now = F.lit(day).cast("timestamp")
        stages.run_blocking(d, pairs, now)
        stages.run_gates(d, pairs, client, "m", now)
        stages.run_supersession(d, sources, pairs, edges, client, "m")
        stages.run_clusters(d, pairs, records, nodes, claims, client, "m", now)

    run("2024-01-01")
    got = {(r.description_id_a[:2], r.description_id_b[:2]): (r.gate_status, r.gate_reason, r.supersession_result) for r in pairs.read().collect()}
    assert got["d0", "d1"] == ("passed", None, "yes") and got["d0", "d2"] == ("passed", None, "no") and got["d1", "d2"] == ("passed", None, "not_evaluable")
    assert got["x|", "y|"] == ("rejected", "generic_topic", None)
    assert [tuple(r) for r in edges.read().collect()] == [("d1|s1", "d0|s0")]
    assert sorted(len(r.participant_ids) for r in records.read().collect()) == [3, 3] and {r.outcome for r in records.read().collect()} == {"written"}
    assert conflict.invariants(edges.read(), d, claims.read(), nodes.read()).count() == 0
    calls, before = log.stat().st_size, sorted(map(str, nodes.read().collect()))
    run("2025-01-01")
    assert log.stat().st_size == calls
    assert sorted(map(str, nodes.read().collect())) == before
    assert {str(r.created_at)[:4] for r in records.read().collect()} == {"2024"}
