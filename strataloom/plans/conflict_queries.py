"""Candidate blocking, gates, supersession, clusters and their invariants."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataloom import ontology as o
from strataloom.functions import text as tx
from strataloom.operators import blocking, conflict, gates
from strataloom.plans.registry import query, table
from strataloom.session import materialize

FLOOR, NEAR = 0.6, o.KNN  # the synthetic vectors are far apart, so the floor is lower than usual


def _claims(spark, sf_dir):
    """Vectors as claims: the label is the type, and the id gives topic and source."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), (F.col("vec_id") % 7).alias("source"), F.concat(F.lit("topic "), F.col("vec_id") % 40).alias("topic"), F.col("label").cast("string").alias("type"), "embedding", F.concat(F.lit("claim "), F.col("vec_id")).alias("text"))


CLAIMS_SQL = "select vec_id as id, vec_id % 7 as source, 'topic ' || (vec_id % 40) as topic, label::varchar as type, embedding from embeddings"
EXACT_SQL = f"select a.id as a, b.id as b from ({CLAIMS_SQL}) a join ({CLAIMS_SQL}) b on a.type = b.type and a.topic = b.topic and a.id < b.id"
NEAR_SQL = f"""
select least(a, b) as a, greatest(a, b) as b, max(score) as similarity from (
  select x.id as a, y.id as b, x.type as ta, y.type as tb, (1 + list_cosine_similarity(x.embedding::double[], y.embedding::double[])) / 2 as score,
    row_number() over (partition by x.id order by round((1 + list_cosine_similarity(x.embedding::double[], y.embedding::double[])) / 2, 12) desc, y.id) as rank
  from ({CLAIMS_SQL}) x, ({CLAIMS_SQL}) y) where rank <= {NEAR + 1} and a <> b and ta = tb and score >= {FLOOR} group by 1, 2
"""
MERGED_SQL = f"""
select coalesce(e.a, k.a) as a, coalesce(e.b, k.b) as b, case when e.a is null then 'knn' when k.a is null then 'exact' else 'both' end as strategy, k.similarity
from ({EXACT_SQL}) e full outer join ({NEAR_SQL}) k on e.a = k.a and e.b = k.b
"""


def _merged(spark, sf_dir):
    d = _claims(spark, sf_dir)
    return blocking.merge(blocking.exact_pairs(d, None), blocking.neighbour_pairs(d, NEAR, FLOOR, None), d)


@query("""
select p.p_partkey as a, q.p_partkey as b from part p join part q on p.p_type = q.p_type and p.p_brand = q.p_brand and p.p_partkey < q.p_partkey
""")
def s1_pairs(spark, sf_dir):
    d = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("type"), F.col("p_brand").alias("topic"), F.lit(None).cast("string").alias("source"))
    return blocking.exact_pairs(d, None).select("a", "b")


@query(f"select a, b, round(similarity, 9) as similarity from ({NEAR_SQL})")
def s2_pairs(spark, sf_dir):
    return blocking.neighbour_pairs(_claims(spark, sf_dir), NEAR, FLOOR, None).withColumn("similarity", F.round("similarity", 9))


@query(f"""
select a, b, a % 7 as source_a, b % 7 as source_b, 'topic ' || (a % 40) as topic_a, 'topic ' || (b % 40) as topic_b, strategy, round(similarity, 9) as similarity from ({MERGED_SQL})
""")
def candidate_pairs(spark, sf_dir):
    return _merged(spark, sf_dir).drop("type").withColumn("similarity", F.round("similarity", 9))


@query(f"""
select count(*) filter (where strategy = 'exact') as n_exact, count(*) filter (where strategy = 'knn') as n_knn, count(*) filter (where strategy = 'both') as n_both, count(*) as n_pairs from ({MERGED_SQL})
""")
def blocking_stats(spark, sf_dir):
    return blocking.stats(_merged(spark, sf_dir))


@query(f"""
with m as ({MERGED_SQL}), old as (select * from m where (a + b) % 3 <> 0), new as (select a, b, case when strategy = 'both' then 'exact' else strategy end as strategy, case when strategy <> 'both' then similarity end as similarity from m where (a + b) % 3 <> 1)
select sha1(least(coalesce(o.a, n.a)::varchar, coalesce(o.b, n.b)::varchar) || chr(31) || greatest(coalesce(o.a, n.a)::varchar, coalesce(o.b, n.b)::varchar)) as pair_key, coalesce(n.strategy, o.strategy) as strategy,
  round(case when n.a is not null then n.similarity else o.similarity end, 9) as similarity, case when o.a is not null then 'run-1' else 'run-2' end as pipeline_version, case when n.a is not null then 'run-2' else 'run-1' end as last_seen_pipeline_version
from old o full outer join new n on o.a = n.a and o.b = n.b
""")
def candidate_upsert(spark, sf_dir):
    m = materialize(_merged(spark, sf_dir), "merged")
    now = F.lit("2024-01-01").cast("timestamp")
    empty = spark.createDataFrame([], blocking.CANDIDATES).where("false")
    first = blocking.upsert_candidates(empty, blocking.candidates(m.where("(a + b) % 3 <> 0"), now, "run-1"))
    again = m.where("(a + b) % 3 <> 1").withColumns({"similarity": F.when(F.col("strategy") != "both", F.col("similarity")), "strategy": F.when(F.col("strategy") == "both", "exact").otherwise(F.col("strategy"))})
    out = blocking.upsert_candidates(first, blocking.candidates(again, now, "run-2"))
    return out.select("pair_key", "strategy", F.round("similarity", 9).alias("similarity"), "pipeline_version", "last_seen_pipeline_version")


@query(r"select doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) < 40 as degenerate from documents")
def gate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", gates.degenerate(F.col("text")).alias("degenerate"))


@query("""
select p_partkey, p_partkey % 4 = 0 or p_partkey % 4 = 2 as generic from part
""")
def gate_topic(spark, sf_dir):
    k = F.col("p_partkey") % 4
    topic = F.when(k == 0, " Future \t WORK ").when(k == 1, F.col("p_name")).when(k == 2, "Data").otherwise("dataset")
    return table(spark, sf_dir, "part").select("p_partkey", gates.generic_topic(topic).alias("generic"))


def similar_texts(texts, words: int = 3, least: float = 0.5):
    """(a, b), a < b: all pairs of ``texts`` (id, text) whose sets of word shingles have a Jaccard similarity of at least ``least``.

    Such a pair shares one of either's rarest shingles (all but a share of ``least`` of them, plus one), so candidates meet
    on these alone. A text of fewer words is one shingle; a text without words pairs with none.
    """
    w = F.filter(F.split(F.lower("text"), r"(?U)\s+"), lambda x: x != "")
    grams = F.when(F.size("w") <= words, F.array(F.array_join("w", " "))).otherwise(F.transform(F.sequence(F.lit(1), F.size("w") - words + 1), lambda i: F.array_join(F.slice("w", i, words), " ")))
    sets = texts.select("id", w.alias("w")).where("size(w) > 0").select("id", F.array_distinct(F.transform(grams, lambda g: F.xxhash64(g))).alias("grams"))
    sets = materialize(sets, "shingles")
    each = sets.select("id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    common = each.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    order = Window.partitionBy("id").orderBy("df", "gram")
    rank = each.join(common, "gram", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn("rank", F.row_number().over(order))
    first = materialize(rank.where((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * least) + 1) & (F.col("df") > 1)).select("id", "gram", "n"), "prefixes")
    x, y = (first.select("gram", F.col("id").alias(i), F.col("n").alias(f"n_{i}")) for i in "ab")
    met = x.join(y, "gram").where((F.col("a") < F.col("b")) & (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least)).select("a", "b").distinct()
    both = met.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= least * (F.size("x") + F.size("y") - shared)).select("a", "b")


def _near_copies(spark, sf_dir):
    """Pairs of documents of any length with similar texts, as claims of one source."""
    d = table(spark, sf_dir, "documents")
    a = d.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"), F.col("source").alias("source_a"))
    b = d.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    pairs = materialize(similar_texts(d.select(F.col("doc_id").alias("id"), "text")), "similar")
    tasks = 16 * spark.sparkContext.defaultParallelism  # a few long texts take most of the time, whatever their bytes
    rows = pairs.join(a, "a").repartition(tasks, "b").join(b, "b").withColumn("source_b", F.when(F.col("b") % 2 == 0, F.col("source_a")).otherwise("another"))
    return rows.select("a", "b", "text_a", "text_b", "source_a", "source_b", F.lit("a topic").alias("topic_a"), F.lit("a topic").alias("topic_b"))


@query()
def gate_intra_doc(spark, sf_dir):
    return gates.rule_gates(_near_copies(spark, sf_dir)).select("a", "b", "reason")


_LABEL = ["entailment", "neutral", "contradiction", "unclear", "error"]


@query("""
with v as (select o_orderkey, ['entailment', 'neutral', 'contradiction', 'unclear', 'error'][(o_orderkey % 5)::int + 1] as label, case when o_orderkey % 11 <> 0 then (o_orderkey % 10) / 10.0::double end as confidence from orders)
select o_orderkey, label, case when label in ('entailment', 'neutral') and coalesce(confidence, 0) >= 0.8 then 'rejected' else 'passed' end as status,
  case when label in ('entailment', 'neutral') and coalesce(confidence, 0) >= 0.8 then 'nli_' || label end as reason from v
""")
def gate_decision(spark, sf_dir):
    k = F.col("o_orderkey")
    label = F.element_at(F.array(*map(F.lit, _LABEL)), (k % 5 + 1).cast("int"))
    d = gates.nli_decision(label, F.when(k % 11 != 0, (k % 10) / F.lit(10.0)))
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"), d["status"].alias("status"), d["reason"].alias("reason"))


def _gated(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.cast("string").alias("pair_key"), F.when(k % 7 == 0, "degenerate_text").when(k % 7 == 1, "generic_topic").alias("reason"))
    verdicts = table(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0").select(k.cast("string").alias("pair_key"), F.element_at(F.array(*map(F.lit, _LABEL)), (k % 5 + 1).cast("int")).alias("nli_label"), F.lit(0.9).alias("nli_confidence"))
    return gates.with_verdicts(rows, verdicts)


@query("""
with r as (select o_orderkey as k, case when o_orderkey % 7 = 0 then 'degenerate_text' when o_orderkey % 7 = 1 then 'generic_topic' end as reason, case when o_orderkey % 4 <> 0 then ['entailment', 'neutral', 'contradiction', 'unclear', 'error'][(o_orderkey % 5)::int + 1] else 'error' end as label from orders),
g as (select case when reason is not null or label in ('entailment', 'neutral') then 'rejected' else 'passed' end as gate_status, coalesce(reason, case when label in ('entailment', 'neutral') then 'nli_' || label end) as gate_reason from r)
select gate_status, gate_reason, count(*) as n from g group by all
""")
def gate_counts(spark, sf_dir):
    return gates.stats(_gated(spark, sf_dir))


@query("""
select o_orderkey from orders where not (o_orderkey % 3 <> 0 and o_orderkey % 2 = 0)
""")
def gate_pending(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 != 0, "passed").alias("gate_status"), F.when(k % 2 == 0, o.GATE_VERSION).when(k % 5 == 0, "older").alias("gate_version"))
    return gates.needs_gate(rows).select("o_orderkey")


@query("""
with p as (select o_orderkey as k, sha1('a' || chr(31) || o_orderkey % 100 || chr(31)) as key from orders), s as (select distinct key, 'neutral' as label from p where k % 100 < 50 and k % 100 % 5 <> 0)
select k as o_orderkey, label as nli_label from p left join s using (key)
""")
def nli_cache(spark, sf_dir):
    k = F.col("o_orderkey")
    pairs = table(spark, sf_dir, "orders").select("o_orderkey", tx.cache_key("a", k % 100).alias("nli_cache_key"))
    store = pairs.where("o_orderkey % 100 < 50").select("nli_cache_key", F.when(k % 100 % 5 == 0, "error").otherwise("neutral").alias("nli_label"), F.lit(0.5).alias("nli_confidence"))
    return gates.cached(pairs, store).select("o_orderkey", "nli_label")


@query("""
select l_orderkey, l_linenumber, l_partkey, sha1(least(l_orderkey::varchar, l_partkey::varchar) || chr(31) || greatest(l_orderkey::varchar, l_partkey::varchar)) as pair_key,
  sha1(array_to_string(list_sort([l_orderkey::varchar, l_partkey::varchar, l_suppkey::varchar]), chr(31))) as participants, sha1(l_orderkey || chr(31) || l_returnflag || chr(31) || 'model' || chr(31) || 'nli-v2' || chr(31)) as cache_key from lineitem
""")
def pair_keys(spark, sf_dir):
    s = lambda c: F.col(c).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", tx.pair_key(s("l_orderkey"), s("l_partkey")).alias("pair_key"), tx.participants_hash(F.array(s("l_orderkey"), s("l_partkey"), s("l_suppkey"))).alias("participants"),
        tx.cache_key(s("l_orderkey"), F.col("l_returnflag"), "model", o.NLI_PROMPT).alias("cache_key"),
    )


def _order_pairs(spark, sf_dir):
    n = table(spark, sf_dir, "orders").select((F.col("o_orderkey") - 1).alias("a"), F.col("o_orderkey").alias("b"))
    return n.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a")), "a").select("a", "b", F.col("a").alias("source_a"), F.col("b").alias("source_b"), F.col("a").alias("pair_key"))


def _order_sources(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 9 == 0, "unknown").otherwise(F.year("o_orderdate").cast("string")).alias("year"))


DIRECTION_SQL = """
select p.o_orderkey as a, q.o_orderkey as b, case when p.o_orderkey % 9 <> 0 then year(p.o_orderdate) end as ya, case when q.o_orderkey % 9 <> 0 then year(q.o_orderdate) end as yb from orders p join orders q on q.o_orderkey = p.o_orderkey + 1
"""


@query(f"""
select a, b, coalesce(ya <> yb, false) as evaluable, case when ya > yb then a when yb > ya then b end as newer, case when ya > yb then b when yb > ya then a end as older from ({DIRECTION_SQL})
""")
def supersession_direction(spark, sf_dir):
    return conflict.direction(_order_pairs(spark, sf_dir), _order_sources(spark, sf_dir)).select("a", "b", "evaluable", "newer", "older")


@query(f"""
with d as (select a, b, case when ya > yb then a when yb > ya then b end as newer, case when ya > yb then b when yb > ya then a end as older from ({DIRECTION_SQL}))
select a, case when newer is null then 'not_evaluable' when not (a % 4 < 2 and a % 3 < 2) then 'no' when newer % 10 = 0 or older % 10 = 0 or a % 8 = 0 then 'anti_cycle_blocked' else 'yes' end as result from d
""")
def supersession_results(spark, sf_dir):
    d = materialize(conflict.direction(_order_pairs(spark, sf_dir), _order_sources(spark, sf_dir)), "direction")
    a = F.col("a")
    verdicts = d.select("pair_key", F.when(a % 4 < 2, "yes").otherwise("no").alias("decision"), F.when(a % 3 == 0, o.SUPERSESSION_BASES[0]).when(a % 3 == 1, o.SUPERSESSION_BASES[2]).otherwise("it feels newer").alias("basis"))
    existing = d.where("a % 8 = 0").select(F.col("older").alias("src"), F.col("newer").alias("dst"))
    types = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 10 != 0, "Result").otherwise("Method").alias("type"))
    return conflict.supersession(d, verdicts, existing, types).select("a", "result")


@query("""
with e as (select distinct l_suppkey as src, l_partkey % 100 as dst from lineitem), n as (select dst as src, src as dst from e where (src + dst) % 5 = 0 union select src, src from e union select src + 1000, dst from e)
select src, dst from n where src <> dst and not exists (select 1 from e where e.src = n.dst and e.dst = n.src)
""")
def anti_cycle_guard(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 100).alias("dst")).distinct()
    n = e.where("(src + dst) % 5 = 0").select(F.col("dst").alias("src"), F.col("src").alias("dst")).union(e.select("src", F.col("src").alias("dst"))).union(e.select((F.col("src") + 1000).alias("src"), "dst")).distinct()
    return conflict.without_reverse(n, e)


def _pair_graph(spark, sf_dir):
    return materialize(blocking.neighbour_pairs(_claims(spark, sf_dir), NEAR, FLOOR, None).select("a", "b"), "pairs")


@query()
def maximal_cliques(spark, sf_dir):
    return conflict.maximal_cliques(_pair_graph(spark, sf_dir)).select(F.array_join("ids", ",").alias("ids"), F.size("ids").alias("size"))


@query()
def cluster_keys(spark, sf_dir):
    return conflict.clusters(conflict.maximal_cliques(_pair_graph(spark, sf_dir))).select("cluster_key", F.array_join("ids", ",").alias("ids"))


def _verdicts(spark, sf_dir):
    k = F.col("o_orderkey")
    kinds = ["scope_difference", "known_controversy", "unresolved", "insufficient_evidence", "not_a_conflict", "made_up"]
    v = F.struct(
        F.element_at(F.array(*map(F.lit, kinds)), (k % 6 + 1).cast("int")).alias("resolution_type"), F.when(k % 7 == 0, "  ").otherwise("a summary").alias("summary"), F.when(k % 5 == 0, "only indoors").alias("scope_conditions"),
        F.when(k % 11 != 0, F.lit(0.6)).alias("confidence"), F.array(F.lit("text")).alias("evidence_used"), F.array().cast("array<struct<description_id:string,position:string>>").alias("positions"),
        F.lit(None).cast("string").alias("insufficient_evidence_reason"), F.lit(None).cast("string").alias("not_a_conflict_reason"),
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 13 != 0, v).alias("raw"), (k % 3 > 0).alias("any_context"), (k % 3 > 1).alias("all_context"))
    return rows.withColumn("verdict", conflict.valid_verdict(F.col("raw"))).drop("raw")


@query("""
with v as (select o_orderkey, case when o_orderkey % 13 <> 0 and o_orderkey % 6 < 5 then ['scope_difference', 'known_controversy', 'unresolved', 'insufficient_evidence', 'not_a_conflict'][(o_orderkey % 6)::int + 1] end as kind,
  o_orderkey % 7 = 0 as blank, case when o_orderkey % 5 = 0 then 'only indoors' end as scope, case when o_orderkey % 11 <> 0 then 0.6::double else 0.5 end as confidence, o_orderkey % 3 > 0 as any_c, o_orderkey % 3 > 1 as all_c from orders),
s as (select *, case when kind is null then 'failed' when kind = 'not_a_conflict' then 'none' when kind = 'unresolved' and not any_c then 'blind' when kind = 'insufficient_evidence' then 'few' when kind = 'scope_difference' and scope is null then 'no_scope' when blank then 'blank' else 'written' end as step from v)
select o_orderkey, case step when 'written' then 'written' when 'none' then 'not_a_conflict' else 'insufficient_evidence' end as outcome, case when step = 'written' then kind end as resolution_type,
  case when step = 'written' and kind = 'scope_difference' then scope end as scope_conditions, case when step <> 'failed' then round(case when kind = 'unresolved' and any_c and not all_c then confidence * 0.7 else confidence end, 6) end as confidence,
  case when step <> 'written' then '' when kind = 'unresolved' and not all_c then 'text,partial_context' else 'text' end as evidence, step not in ('failed', 'no_scope', 'blank') as cacheable from s
""")
def cluster_outcomes(spark, sf_dir):
    out = conflict.cluster_outcomes(_verdicts(spark, sf_dir))
    return out.select("o_orderkey", "outcome", "resolution_type", "scope_conditions", F.round("confidence", 6).alias("confidence"), F.array_join("evidence_used", ",").alias("evidence"), "cacheable")


def _store(spark, sf_dir):
    """Parts as claims; a brand's parts of one size form a cluster; stored contradictions span a brand's sizes below 10."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("description_id"), "p_brand", "p_size")
    written = p.groupBy("p_brand", "p_size").agg(F.array_sort(F.collect_set("description_id")).alias("ids")).where("size(ids) > 1").select(F.concat_ws("/", "p_brand", "p_size").alias("cluster_key"), "ids")
    edges = p.where("p_size < 10").select("description_id", F.concat(F.lit("old-"), "p_brand", F.lit("-"), F.col("p_size") % 3).alias("node_id"))
    stored = edges.select(F.col("node_id").alias("id")).distinct().withColumn("generated_at", F.length("id"))
    return written, edges, stored


STORE_SQL = """
p as (select p_partkey::varchar as d, p_brand, p_size from part),
w as (select p_brand || '/' || p_size as key, p_brand, p_size from p group by p_brand, p_size having count(*) > 1),
m as (select w.key, d from w join p using (p_brand, p_size)),
e as (select d, 'old-' || p_brand || '-' || (p_size % 3) as node from p where p_size < 10),
o as (select distinct key, node from m join e using (d)),
c as (select node, min(key) as key from o group by node),
k as (select key, min_by(node, (length(node), node)) as node from c group by key)
"""


@query(f"with {STORE_SQL} select w.key as cluster_key, coalesce(k.node, 'contradiction-' || w.key) as node_id from w left join k using (key)")
def node_identity(spark, sf_dir):
    return conflict.node_identity(*_store(spark, sf_dir))[0]


@query(f"""
with {STORE_SQL}, ids as (select w.key, coalesce(k.node, 'contradiction-' || w.key) as node from w left join k using (key)),
gone as (select node from c where node not in (select node from k) union select node from ids),
after as (select d, node from e where node not in (select node from gone) union select m.d, ids.node from m join ids using (key))
select d as description_id, node as node_id from after where node in (select node from after group by node having count(*) >= 2)
""")
def cluster_post_state(spark, sf_dir):
    written, edges, stored = _store(spark, sf_dir)
    ids, dropped = conflict.node_identity(written, edges, stored)
    return conflict.post_state(written, ids, dropped, edges)


@query(f"""
with {STORE_SQL}, ids as (select w.key, coalesce(k.node, 'contradiction-' || w.key) as node from w left join k using (key)),
gone as (select node from c where node not in (select node from k) union select node from ids),
after as (select d, node from e where node not in (select node from gone) union select m.d, ids.node from m join ids using (key))
select null::varchar as invariant, null::varchar as id where false
""")
def invariants_all(spark, sf_dir):
    """Of the store after a run: no rows."""
    written, edges, stored = _store(spark, sf_dir)
    ids, dropped = conflict.node_identity(written, edges, stored)
    after = materialize(conflict.post_state(written, ids, dropped, edges), "after")
    nodes = after.select(F.col("node_id").alias("id")).distinct().select("id", F.lit("known_controversy").alias("resolution_type"), F.lit(None).cast("string").alias("scope_conditions"))
    claims = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.lit("Result").alias("type"))
    pairs = claims.select(F.col("id").alias("src"), (F.col("id").cast("long") + 1).cast("string").alias("dst")).join(claims.select(F.col("id").alias("dst")), "dst", "left_semi")
    return conflict.invariants(pairs, claims, after, nodes)


@query("""
with s as (select l_suppkey as src, l_partkey as dst from lineitem union select l_partkey, l_suppkey from lineitem where l_returnflag = 'R'),
d as (select s_suppkey as id from supplier where s_suppkey % 10 <> 0)
select 'endpoint_type' as invariant, src::varchar as id from s where src not in (select id from d) union all select 'endpoint_type', dst::varchar from s where dst not in (select id from d)
union all select 'two_cycle', x.src::varchar from s x join s y on x.src = y.dst and x.dst = y.src and x.src < x.dst union all select 'self_loop', src::varchar from s where src = dst
""")
def invariant_violations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = li.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).union(li.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey")).distinct()
    d = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 10 != 0, "Result").otherwise("Method").alias("type"))
    empty = spark.createDataFrame([], "node_id string, description_id string")
    return conflict.invariants(s, d, empty, spark.createDataFrame([], "id string, resolution_type string, scope_conditions string"))


@query("""
with d as (select p_partkey, case when p_partkey % 5 = 0 then 'plain' else 'd' || p_partkey || '|s' || (p_partkey % 30) end as id, case when p_partkey % 7 <> 0 then 's' || (p_partkey % 30) end as source, case when p_partkey % 11 = 0 then ' ' else p_name end as text from part)
select 'id_bar' as check, count(*) as n from d where p_partkey % 5 = 0 union all select 'no_source', count(*) from d where source is null union all select 'no_text', count(*) from d where trim(text) = ''
union all select 'unknown_source', count(*) from d where source is not null and source not in (select 's' || i from range(25) t(i))
""")
def ingest_checks(spark, sf_dir):
    k = F.col("p_partkey")
    d = table(spark, sf_dir, "part").select(
        F.when(k % 5 == 0, "plain").otherwise(F.concat(F.lit("d"), k, F.lit("|s"), k % 30)).alias("id"), F.when(k % 7 != 0, F.concat(F.lit("s"), k % 30)).alias("source"), F.when(k % 11 == 0, " ").otherwise(F.col("p_name")).alias("text"),
    )
    sources = spark.range(25).select(F.concat(F.lit("s"), "id").alias("id"))
    return conflict.ingest_checks(d, sources).groupBy("check").agg(F.count(F.lit(1)).alias("n"))
