"""From gated pairs to contradictions: supersession, cliques, verdict rules, identity and invariants."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom import ontology as o
from strataloom.functions import text as tx
from strataloom.operators.components import connected_components
from strataloom.session import materialize

VERDICT = (
    "resolution_type string, summary string, scope_conditions string, confidence double, evidence_used array<string>, "
    "positions array<struct<description_id:string,position:string>>, insufficient_evidence_reason string, not_a_conflict_reason string"
)


def direction(pairs: DataFrame, sources: DataFrame) -> DataFrame:
    """Pairs (a, b, source_a, source_b) with newer and older by their sources' years; equal or unknown years: not evaluable."""
    year = lambda s: sources.select(F.col("id").alias(f"source_{s}"), F.col("year").try_cast("int").alias(f"year_{s}"))
    rows = pairs.join(year("a"), "source_a", "left").join(year("b"), "source_b", "left")
    known = F.coalesce(F.col("year_a") != F.col("year_b"), F.lit(False))
    first = F.col("year_a") > F.col("year_b")
    return rows.withColumns({
        "evaluable": known, "newer": F.when(known, F.when(first, F.col("a")).otherwise(F.col("b"))), "older": F.when(known, F.when(first, F.col("b")).otherwise(F.col("a"))),
    })


def supersession(pairs: DataFrame, verdicts: DataFrame, existing: DataFrame, types: DataFrame, allowed=o.ALLOWED_TYPES) -> DataFrame:
    """Pairs with result: not_evaluable, no, yes or anti_cycle_blocked.

    ``verdicts`` (pair_key, decision, basis); yes needs a known basis, anything else is no. A yes is written unless the
    reverse edge exists in ``existing`` (src, dst), an end's type (``types``: id, type) isn't allowed or unknown, or the ends
    are one; all those are labelled anti_cycle_blocked.
    """
    rows = pairs.join(verdicts, "pair_key", "left")
    yes = (F.col("decision") == "yes") & F.col("basis").isin(*o.SUPERSESSION_BASES)
    back = existing.select(F.col("src").alias("older"), F.col("dst").alias("newer")).distinct().withColumn("back", F.lit(True))
    ok = types.where(F.col("type").isin(*allowed)).select("id").distinct()
    rows = rows.join(back, ["older", "newer"], "left")
    for end in ("newer", "older"):
        rows = rows.join(ok.select(F.col("id").alias(end), F.lit(True).alias(f"{end}_ok")), end, "left")
    writable = F.col("back").isNull() & F.col("newer_ok").isNotNull() & F.col("older_ok").isNotNull() & (F.col("newer") != F.col("older"))
    result = F.when(~F.col("evaluable"), "not_evaluable").when(~F.coalesce(yes, F.lit(False)), "no").when(writable, "yes").otherwise("anti_cycle_blocked")
    return rows.withColumn("result", result).drop("back", "newer_ok", "older_ok")


def without_reverse(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New edges (src, dst) but for loops and those whose reverse exists."""
    return new.where("src <> dst").join(existing.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_anti")


def _cliques(first, later: set, earlier: set, neighbours: dict) -> Iterator[list]:
    """Maximal cliques of ``first`` with some of ``later`` (Bron and Kerbosch, with Tomita's pivot), without recursion.

    Those that one of ``earlier`` would extend are left out. ``neighbours`` need not know edges within ``earlier``.
    """
    none: set = set()
    stack = [([first], later, earlier)]
    while stack:
        clique, open_, done = stack.pop()
        if not open_:
            if not done and len(clique) > 1:
                yield sorted(clique)
            continue
        pivot = max(open_ | done, key=lambda v: len(open_ & neighbours.get(v, none)))
        for v in sorted(open_ - neighbours.get(pivot, none)):
            stack.append(([*clique, v], open_ & neighbours.get(v, none), done & neighbours.get(v, none)))
            open_ = open_ - {v}
            done = done | {v}


def maximal_cliques(pairs: DataFrame, a: str = "a", b: str = "b", per_task: int = 200_000) -> DataFrame:
    """(component, ids): every maximal clique of the pair graph, ids ascending.

    Nodes are ordered by degree (an approximation of the degeneracy order), and each lists the cliques of which it is the
    first. For that it needs its neighbours and the edges between its later ones and any of them, which are the triangles
    it is part of; a node has no more than sqrt(2 E) later neighbours, so no task holds a component.
    """
    low, high = (f(F.col(a).cast("string"), F.col(b).cast("string")) for f in (F.least, F.greatest))
    edges = materialize(pairs.select(low.alias("src"), high.alias("dst")).where("src <> dst").distinct(), "cliques")
    part = connected_components(edges)
    degree = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    placed = edges.join(degree.toDF("src", "n_src"), "src").join(degree.toDF("dst", "n_dst"), "dst")
    one, two = F.struct(F.col("n_src").alias("n"), F.col("src").alias("id")), F.struct(F.col("n_dst").alias("n"), F.col("dst").alias("id"))
    up = materialize(placed.select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y")), "cliques")
    wedges = up.join(up.withColumnRenamed("y", "z"), "x").where("y < z")
    triangles = materialize(wedges.join(up.toDF("y", "z"), ["y", "z"]).select("x.id", F.col("y.id").alias("y"), F.col("z.id").alias("z")).toDF("x", "y", "z"), "cliques")
    ids = up.select(F.col("x.id").alias("x"), F.col("y.id").alias("y"))
    none = F.lit(None).cast("string")
    near = (
        ids.select(F.col("x").alias("v"), F.col("y").alias("p"), none.alias("q"), F.lit(0).alias("kind")).unionByName(ids.select(F.col("y").alias("v"), F.col("x").alias("p"), none.alias("q"), F.lit(1).alias("kind")))
        .unionByName(triangles.select(F.col("x").alias("v"), F.col("y").alias("p"), F.col("z").alias("q"), F.lit(2).alias("kind"))).unionByName(triangles.select(F.col("y").alias("v"), F.col("x").alias("p"), F.col("z").alias("q"), F.lit(2).alias("kind")))
    )
    near = materialize(near, "cliques")
    tasks = max(1, -(-near.count() // per_task))

    def listed(frame: pd.DataFrame) -> pd.DataFrame:
        of: dict[str, tuple[set, set, dict]] = {}
        for v, p, q, kind in zip(frame["v"], frame["p"], frame["q"], frame["kind"], strict=True):
            later, earlier, neighbours = of.setdefault(v, (set(), set(), {}))
            if kind < 2:
                (later, earlier)[kind].add(p)
            else:
                neighbours.setdefault(p, set()).add(q)
                neighbours.setdefault(q, set()).add(p)
        found = [(v, ids) for v, sets in of.items() for ids in _cliques(v, *sets)]
        return pd.DataFrame({"id": [v for v, _ in found], "ids": [ids for _, ids in found]})

    dealt = near.withColumn("task", F.pmod(F.xxhash64("v"), F.lit(tasks)))
    found = dealt.groupBy("task").applyInPandas(listed, "id string, ids array<string>")
    return found.join(part, "id").select("component", "ids")


def clusters(cliques: DataFrame, most: int = o.CLUSTER_MOST) -> DataFrame:
    """(cluster_key, ids): cliques cut to their first ids, each set once."""
    ids = F.slice(F.array_sort("ids"), 1, most)
    return cliques.select(tx.participants_hash(ids).alias("cluster_key"), ids.alias("ids")).dropDuplicates(["cluster_key"])


def valid_verdict(v: Column) -> Column:
    """A verdict struct, null where its resolution type is unknown; a missing confidence is 0.5."""
    return F.when(v["resolution_type"].isin(*o.RESOLUTIONS), v.withField("confidence", F.coalesce(v["confidence"], F.lit(0.5))))


def cluster_outcomes(rows: DataFrame, verdict: str = "verdict") -> DataFrame:
    """Rules on a model's verdict. Needs any_context and all_context; adds outcome and the fields to store.

    In order: no verdict; not a conflict; unresolved without or with partial context; insufficient; scope difference
    without conditions; blank summary; else written.
    """
    v = F.col(verdict)
    kind = v["resolution_type"]
    blind = (kind == "unresolved") & ~F.col("any_context")
    partial = (kind == "unresolved") & F.col("any_context") & ~F.col("all_context")
    confidence = F.when(partial, F.coalesce(v["confidence"], F.lit(0.0)) * o.PARTIAL_FACTOR).otherwise(v["confidence"])
    evidence = F.coalesce(v["evidence_used"], F.array().cast("array<string>"))
    evidence = F.when(partial, F.array_union(evidence, F.array(F.lit("partial_context")))).otherwise(evidence)
    no_scope = (kind == "scope_difference") & (F.coalesce(v["scope_conditions"], F.lit("")) == "")
    blank = tx.strip(F.coalesce(v["summary"], F.lit(""))) == ""
    step = (
        F.when(v.isNull(), "failed").when(kind == "not_a_conflict", "none").when(blind, "blind").when(kind == "insufficient_evidence", "insufficient")
        .when(no_scope, "no_scope").when(blank, "blank").otherwise("written")
    )
    out = rows.withColumn("step", step)
    s = F.col("step")
    reason = (
        F.when(s == "failed", "no verdict").when(s == "none", F.coalesce(v["not_a_conflict_reason"], F.lit("the claims do not oppose each other"))).when(s == "blind", "unresolved, but no scope context was available")
        .when(s == "insufficient", F.coalesce(v["insufficient_evidence_reason"], F.lit("insufficient evidence"))).when(s == "no_scope", "scope difference without conditions").when(s == "blank", "no summary")
    )
    written = s == "written"
    return out.withColumns({
        "outcome": F.when(written, "written").when(s == "none", "not_a_conflict").otherwise("insufficient_evidence"),
        "resolution_type": F.when(written, kind), "summary": F.when(written, v["summary"]), "scope_conditions": F.when(written & (kind == "scope_difference"), v["scope_conditions"]),
        "confidence": F.when(s != "failed", confidence), "evidence_used": F.when(written, evidence).otherwise(F.array().cast("array<string>")),
        "positions": F.when(written, v["positions"]), "insufficient_evidence_reason": reason, "cacheable": ~s.isin("failed", "no_scope", "blank"),
    }).drop("step")


def scope_context(participants: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Participants (cluster_key, id, source) by cluster: whether any and whether all of them have scope texts."""
    has = descriptions.where(F.col("type").isin(*o.SCOPE_TYPES)).select("source").distinct().withColumn("has", F.lit(True))
    rows = participants.join(has, "source", "left").groupBy("cluster_key").agg(F.count("has").alias("n"), F.count(F.lit(1)).alias("of"))
    return rows.select("cluster_key", (F.col("n") > 0).alias("any_context"), (F.col("n") == F.col("of")).alias("all_context"))


def node_identity(written: DataFrame, edges: DataFrame, contradictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((cluster_key, node_id), dropped ids) for clusters (cluster_key, ids).

    Overlapping stored contradictions are claimed once, by the smallest cluster key; a cluster keeps its oldest and drops
    the rest; one with none gets an id made of its key.
    """
    part = written.select("cluster_key", F.explode("ids").alias("description_id"))
    over = part.join(edges, "description_id").select("cluster_key", "node_id").distinct().join(contradictions.select(F.col("id").alias("node_id"), "generated_at"), "node_id")
    mine = over.withColumn("nth", F.row_number().over(Window.partitionBy("node_id").orderBy("cluster_key"))).where("nth = 1")
    kept = mine.groupBy("cluster_key").agg(F.min_by("node_id", F.struct("generated_at", "node_id")).alias("node_id"))
    ids = written.select("cluster_key").join(kept, "cluster_key", "left").withColumn("node_id", F.coalesce("node_id", F.concat(F.lit("contradiction-"), "cluster_key")))
    return ids, mine.select("node_id").join(kept.select("node_id"), "node_id", "left_anti")


def post_state(written: DataFrame, ids: DataFrame, dropped: DataFrame, edges: DataFrame) -> DataFrame:
    """has_contradiction edges (description_id, node_id) after a run; nodes with fewer than two participants have none."""
    new = written.join(ids, "cluster_key").select(F.explode("ids").alias("description_id"), "node_id").distinct()
    gone = dropped.select("node_id").union(ids.select("node_id")).distinct()
    both = edges.select("description_id", "node_id").join(gone, "node_id", "left_anti").select("description_id", "node_id").union(new).distinct()
    enough = both.groupBy("node_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("node_id")
    return both.join(enough, "node_id", "left_semi").select("description_id", "node_id")


def to_skip(clusters_: DataFrame, records: DataFrame, edges: DataFrame, version: str = o.CLASSIFICATION_VERSION) -> DataFrame:
    """Clusters recorded by this version whose participants already share a contradiction of exactly that set."""
    stored = edges.groupBy("node_id").agg(F.collect_set("description_id").alias("ids")).select(tx.participants_hash(F.col("ids")).alias("cluster_key")).distinct()
    current = records.where(F.col("pipeline_version") == version).select("cluster_key")
    return clusters_.join(current, "cluster_key", "left_semi").join(stored, "cluster_key", "left_semi")


def invariants(supersedes: DataFrame, descriptions: DataFrame, edges: DataFrame, contradictions: DataFrame, allowed=o.ALLOWED_TYPES) -> DataFrame:
    """(invariant, id) of violations; a sound store has none."""
    ok = descriptions.where(F.col("type").isin(*allowed)).select(F.col("id"))
    bad_src = supersedes.join(ok.withColumnRenamed("id", "src"), "src", "left_anti").select("src")
    bad_dst = supersedes.join(ok.withColumnRenamed("id", "dst"), "dst", "left_anti").select("dst")
    cycle = supersedes.alias("x").join(supersedes.alias("y"), (F.col("x.src") == F.col("y.dst")) & (F.col("x.dst") == F.col("y.src")) & (F.col("x.src") < F.col("x.dst"))).select(F.col("x.src"))
    loops = supersedes.where("src = dst").select("src")
    n = edges.select("node_id", "description_id").distinct().groupBy("node_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("description_id")).alias("ids"))
    single = contradictions.select("id").join(n.withColumnRenamed("node_id", "id"), "id", "left").where(F.coalesce("n", F.lit(0)) < 2).select("id")
    differs = (F.col("resolution_type") == "scope_difference") != F.col("scope_conditions").isNotNull()
    scope = contradictions.where(differs).select("id")
    twice = n.withColumn("low", F.min("node_id").over(Window.partitionBy("ids"))).where("node_id <> low").select("node_id")
    parts = {"endpoint_type": bad_src.union(bad_dst), "two_cycle": cycle, "self_loop": loops, "singleton": single, "scope_conditions": scope, "duplicate_participants": twice}
    out = None
    for name, rows in parts.items():
        rows = rows.toDF("id").select(F.lit(name).alias("invariant"), F.col("id").cast("string").alias("id"))
        out = rows if out is None else out.unionByName(rows)
    return out


def ingest_checks(descriptions: DataFrame, sources: DataFrame) -> DataFrame:
    """(check, id) of descriptions without exactly one bar in their id, a source, a text, or with an unknown source."""
    bars = F.length("id") - F.length(F.replace(F.col("id"), F.lit("|"), F.lit("")))
    rules = {"id_bar": bars != 1, "no_source": F.coalesce("source", F.lit("")) == "", "no_text": tx.strip(F.coalesce("text", F.lit(""))) == ""}
    out = descriptions.where("source is not null").join(sources.select(F.col("id").alias("source")), "source", "left_anti").select(F.lit("unknown_source").alias("check"), "id")
    for name, bad in rules.items():
        out = out.unionByName(descriptions.where(bad).select(F.lit(name).alias("check"), "id"))
    return out
