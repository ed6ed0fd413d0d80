"""The conflict pass as three stages over snapshot tables. A second run over the same input calls no model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom import models
from strataloom import ontology as o
from strataloom.functions import text as tx
from strataloom.operators import blocking, conflict, gates
from strataloom.session import bound_batches, materialize
from strataloom.sources.tables import SnapshotTable, upsert

CLUSTERS = (
    "cluster_key string, participant_ids array<string>, contradiction_node_id string, resolution_type string, summary string, scope_conditions string, confidence double, "
    "evidence_used array<string>, outcome string, insufficient_evidence_reason string, cache_key string, pipeline_version string, created_at timestamp, last_seen_at timestamp"
)
CONTRADICTIONS = "id string, resolution_type string, summary string, scope_conditions string, confidence double, generated_at timestamp"
CLAIM_EDGES = "description_id string, node_id string"
SUPERSEDES = "src string, dst string"
_NLI = "label string, confidence double, rationale string"
_SUPERSESSION = "decision string, basis string, reason string, confidence double"


def run_blocking(descriptions: DataFrame, table: SnapshotTable, now: Column, k: int = o.KNN, floor: float | None = o.SIMILARITY_FLOOR, allowed=o.ALLOWED_TYPES) -> DataFrame:
    """Find candidates among descriptions (id, source, topic, type, text, embedding) and store them; returns the counts."""
    merged = materialize(blocking.merge(blocking.exact_pairs(descriptions, allowed), blocking.neighbour_pairs(descriptions, k, floor, allowed), descriptions), "blocking")
    table.publish(blocking.upsert_candidates(table.read(), blocking.candidates(merged, now)))
    return blocking.stats(merged)


def pair_texts(rows: DataFrame, descriptions: DataFrame) -> DataFrame:
    side = lambda s: descriptions.select(F.col("id").cast("string").alias(f"description_id_{s}"), F.col("text").alias(f"text_{s}"))
    named = rows.join(side("a"), "description_id_a", "left").join(side("b"), "description_id_b", "left")
    return named.withColumns({"source_a": F.col("source_id_a"), "source_b": F.col("source_id_b")})


def run_gates(descriptions: DataFrame, table: SnapshotTable, client: models.Completer, model: str, now: Column, version: str = o.GATE_VERSION, flush: int | None = None, **ask) -> DataFrame:
    """Gate the stored candidates that need it; the model sees only pairs that no rule rejects and no stored verdict answers.

    With ``flush`` the model is asked for about so many pairs at a time and each such part is published, so that a run that
    is broken off loses no more than one part; the rows of stored pairs are changed in place and never deleted.
    """
    bound_batches(descriptions.sparkSession)  # the texts of a pair meet in Python
    stored = table.read()
    keep = ["pair_key", "description_id_a", "description_id_b", "source_id_a", "source_id_b", "topic_a", "topic_b"]
    ruled = materialize(gates.rule_gates(pair_texts(gates.needs_gate(stored, version).select(*keep), descriptions)), "gates")
    key = gates.nli_key(F.col("description_id_a"), F.col("description_id_b"), F.col("text_a"), F.col("text_b"), model)
    open_ = gates.cached(ruled.where("reason is null").withColumn("nli_cache_key", key), stored)
    open_ = materialize(open_, "gates-open")
    parts = -(-open_.where("nli_label is null").count() // flush) if flush else 1
    part = F.when(F.col("nli_label").isNull(), F.pmod(F.xxhash64("pair_key"), F.lit(max(parts, 1)))).otherwise(0)
    open_ = open_.withColumn("part", part)
    ruled = ruled.join(open_.select("pair_key", "part"), "pair_key", "left").withColumn("part", F.coalesce("part", F.lit(0)))
    gated = None
    for k in range(max(parts, 1)):
        done = _publish_gated(table, open_.where(F.col("part") == k).drop("part"), ruled.where(F.col("part") == k).drop("part"), client, now, version, ask)
        gated = done if gated is None else gated.unionByName(done)
    return gates.stats(gated)


def _publish_gated(table: SnapshotTable, open_: DataFrame, ruled: DataFrame, client: models.Completer, now: Column, version: str, ask: dict) -> DataFrame:
    misses = open_.where("nli_label is null").withColumn("prompt", models.nli_prompt(F.col("text_a"), F.col("text_b")))
    said = models.ask(misses, client, "pair_key", "prompt", **ask).withColumn("v", tx.salvage_json(F.col("reply"), _NLI))
    known = F.col("v.label").isin(*o.NLI_LABELS)
    fresh = said.select("pair_key", F.when(known, F.col("v.label")).otherwise("error").alias("nli_label"), F.when(known, F.col("v.confidence")).alias("nli_confidence"))
    verdicts = materialize(fresh.unionByName(open_.where("nli_label is not null").select("pair_key", "nli_label", "nli_confidence")), "verdicts")
    gated = gates.with_verdicts(ruled, verdicts, version).join(open_.select("pair_key", "nli_cache_key"), "pair_key", "left")
    done = gated.select("pair_key", "gate_status", "gate_reason", "gate_version", now.alias("gate_checked_at"), "nli_label", "nli_confidence", "nli_cache_key")
    done = materialize(done, "gated")
    table.publish(upsert(table.read(), done, ["pair_key"]))
    return done


def run_supersession(descriptions: DataFrame, sources: DataFrame, table: SnapshotTable, edges: SnapshotTable, client: models.Completer, model: str, **ask) -> None:
    """Judge passed pairs of different years and write the edges of those that hold."""
    stored = table.read()
    passed = pair_texts(stored.where("gate_status = 'passed'"), descriptions).withColumns({"a": F.col("description_id_a"), "b": F.col("description_id_b")})
    about = conflict.direction(passed, sources)
    text = lambda which: F.when(F.col(which) == F.col("a"), F.col("text_a")).otherwise(F.col("text_b"))
    year = lambda which: F.when(F.col(which) == F.col("a"), F.col("year_a")).otherwise(F.col("year_b")).cast("string")
    key = tx.cache_key(F.col("newer"), F.col("older"), text("newer"), text("older"), model, o.SUPERSESSION_PROMPT)
    about = materialize(about.withColumn("key", F.when(F.col("evaluable"), key)), "supersession")
    fresh = about.where("evaluable and not (key <=> supersession_cache_key and supersession_result is not null)")
    asked = fresh.withColumn("prompt", models.supersession_prompt(text("older"), text("newer"), year("older"), year("newer"), F.lit("")))
    said = models.ask(asked, client, "pair_key", "prompt", **ask).withColumn("v", tx.salvage_json(F.col("reply"), _SUPERSESSION))
    answers = said.select("pair_key", F.col("v.decision").alias("decision"), F.col("v.basis").alias("basis"), F.col("v.reason").alias("reason"), F.col("v.confidence").alias("sure"))
    cached = about.where("evaluable and key <=> supersession_cache_key and supersession_result is not null")
    known = cached.select("pair_key", F.when(F.col("supersession_result") == "yes", "yes").otherwise("no").alias("decision"), F.col("supersession_basis").alias("basis"), F.col("supersession_reason").alias("reason"), F.col("supersession_confidence").alias("sure"))
    verdicts = materialize(answers.unionByName(known), "supersession-verdicts")
    types = descriptions.select(F.col("id").cast("string").alias("id"), "type")
    old = edges.read()
    judged = materialize(conflict.supersession(about, verdicts, old, types), "supersession-results")
    edges.publish(old.union(judged.where("result = 'yes'").select("newer", "older")).distinct())
    sure = F.col("decision").isin("yes", "no")
    done = judged.select(
        "pair_key", F.col("result").alias("supersession_result"), F.when(F.col("result") == "yes", F.col("basis")).alias("supersession_basis"), F.col("reason").alias("supersession_reason"),
        F.col("sure").alias("supersession_confidence"), F.when(sure, F.col("key")).alias("supersession_cache_key"),
    )
    table.publish(upsert(stored, done, ["pair_key"]))


def run_clusters(descriptions: DataFrame, table: SnapshotTable, records: SnapshotTable, contradictions: SnapshotTable, claims: SnapshotTable, client: models.Completer, model: str, now: Column, version: str = o.CLASSIFICATION_VERSION, **ask) -> DataFrame:
    """Cluster what passed and wasn't superseded, judge new clusters, and publish records, contradictions and their edges."""
    pairs = table.read().where("gate_status = 'passed' and coalesce(supersession_result, '') <> 'yes'").select(F.col("description_id_a").alias("a"), F.col("description_id_b").alias("b"))
    found = materialize(conflict.clusters(conflict.maximal_cliques(pairs)), "clusters")
    old_records, old_edges, old_nodes = records.read(), claims.read(), contradictions.read()
    todo = found.join(conflict.to_skip(found, old_records, old_edges, version), "cluster_key", "left_anti").withColumn("cache_key", tx.cache_key(F.col("cluster_key"), model, o.CLUSTER_PROMPT, version))
    about = descriptions.select(F.col("id").cast("string").alias("id"), F.col("source").cast("string").alias("source"), "topic", "text", "type")
    part = todo.select("cluster_key", "cache_key", "ids", F.posexplode("ids").alias("at", "id")).join(about, "id", "left")
    scope = about.where(F.col("type").isin(*o.SCOPE_TYPES)).groupBy("source").agg(F.collect_list("text").alias("context"))
    part = materialize(part.join(scope, "source", "left"), "participants")
    block = part.groupBy("cluster_key", "cache_key", "ids").agg(F.array_sort(F.collect_list(F.struct("at", "id", "source", "topic", "text", F.coalesce("context", F.array().cast("array<string>")).alias("context")))).alias("p"))
    seen = old_records.where("cache_key is not null").select("cache_key", F.lit(True).alias("seen")).distinct()
    fresh = block.join(seen, "cache_key", "left_anti").withColumn("prompt", models.cluster_prompt(models.participants_block(F.col("p"))))
    said = models.ask(fresh, client, "cluster_key", "prompt", **ask).withColumn("verdict", conflict.valid_verdict(tx.salvage_json(F.col("reply"), conflict.VERDICT)))
    context = conflict.scope_context(part.select("cluster_key", "id", "source"), about)
    judged = materialize(conflict.cluster_outcomes(block.select("cluster_key", "cache_key", "ids").join(said.select("cluster_key", "verdict"), "cluster_key").join(context, "cluster_key")).drop("verdict", "positions"), "judged")
    written = judged.where("outcome = 'written'").select("cluster_key", "ids")
    ids, dropped = conflict.node_identity(written, old_edges, old_nodes)
    ids = materialize(ids, "identity")
    refused = judged.where("outcome <> 'written'").select(F.explode("ids").alias("description_id")).join(old_edges, "description_id").select("node_id").distinct()
    edges = materialize(conflict.post_state(written, ids, dropped.union(refused.join(ids, "node_id", "left_anti")).distinct(), old_edges), "claims")
    alive = edges.select(F.col("node_id").alias("id")).distinct()
    new_nodes = judged.join(ids, "cluster_key").select(F.col("node_id").alias("id"), "resolution_type", "summary", "scope_conditions", "confidence", now.alias("generated_at"))
    contradictions.publish(upsert(old_nodes, new_nodes, ["id"], {"generated_at": lambda was, got, here: F.coalesce(was, got)}).join(alive, "id", "left_semi"))
    claims.publish(edges)
    new_records = judged.join(ids, "cluster_key", "left").select(
        "cluster_key", F.col("ids").alias("participant_ids"), F.col("node_id").alias("contradiction_node_id"), "resolution_type", "summary", "scope_conditions", "confidence", "evidence_used", "outcome", "insufficient_evidence_reason",
        F.when(F.col("cacheable"), F.col("cache_key")).alias("cache_key"), F.lit(version).alias("pipeline_version"), now.alias("created_at"), now.alias("last_seen_at"),
    )
    records.publish(upsert(old_records, new_records, ["cluster_key"], {"created_at": lambda was, got, here: F.coalesce(was, got)}))
    return judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
