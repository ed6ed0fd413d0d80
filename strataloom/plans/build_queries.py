"""Structural edges, the graph's upserts and counts, and the sanitizer's rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.functions import text as tx
from strataloom.operators import build, sanitize, structure
from strataloom.plans.registry import MEETING_SQL, PAPER_SQL, meeting_chunks, paper_chunks, query, table
from strataloom.sources.tables import keep_first, upsert


@query("select conv_id::varchar || '-' || turn as chunk_id, conv_id as filename, 1 as document_version from conversations")
def part_of_edges(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.col("conv_id").alias("filename"), F.lit(1).alias("document_version"))
    return structure.part_of(c, c.select("filename", "document_version").distinct())


@query("select a.conv_id, a.turn as src, b.turn as dst from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1")
def next_edges(spark, sf_dir):
    return structure.next_edges(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "turn")


@query("""
select 'NEXT' as edge_type, count(*) as n_edges from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1
union all select 'PART_OF', count(*) from conversations
""")
def structure_counts(spark, sf_dir):
    n = structure.next_edges(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "turn").agg(F.lit("NEXT").alias("edge_type"), F.count(F.lit(1)).alias("n_edges"))
    return n.unionByName(part_of_edges(spark, sf_dir).agg(F.lit("PART_OF").alias("edge_type"), F.count(F.lit(1)).alias("n_edges")))


@query("""
with w as (select distinct doc_id, lower(unnest(regexp_split_to_array(text, '[ \t\n\r]+'))) as id from documents),
n as (select distinct lower(unnest(regexp_split_to_array(text, '[ \t\n\r]+'))) as id from benchmark)
select count(*) as n_mentions, count(distinct doc_id) as n_chunks, count(distinct id) as n_nodes from w join n using (id)
""")
def mentions_edges(spark, sf_dir):
    words = lambda t: F.explode(F.split(F.lower(t), "[ \t\n\r]+"))
    named = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), words("text").alias("id"))
    nodes = table(spark, sf_dir, "benchmark").select(F.lit("Topic").alias("label"), words("text").alias("id")).distinct().unionByName(table(spark, sf_dir, "documents").select(F.lit("Chunk").alias("label"), F.col("doc_id").cast("string").alias("id")))
    return structure.mentions(named, nodes).agg(F.count(F.lit(1)).alias("n_mentions"), F.countDistinct("chunk_id").alias("n_chunks"), F.countDistinct("id").alias("n_nodes"))


@query("""
with l as (select o_orderkey as src, lead(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as dst from orders) select src, dst from l where dst is not null
""")
def precedes_edges(spark, sf_dir):
    return structure.precedes(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey")


@query("""
select o.o_orderkey, count(distinct l_partkey) as n from orders o left join lineitem on l_orderkey = o.o_orderkey and l_quantity > 20 group by o.o_orderkey having count(distinct l_partkey) < 2
""")
def singleton_cleanup(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").where("l_quantity > 20").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("other"))
    return structure.singletons(table(spark, sf_dir, "orders"), edges, "o_orderkey")


def _graph(spark, sf_dir):
    """Nations, customers and suppliers as a small typed graph."""
    t = lambda n: table(spark, sf_dir, n)
    node = lambda n, label, key: t(n).select(F.lit(label).alias("label"), F.concat(F.lit(f"{label}-"), key).alias("id"))
    nodes = node("nation", "Nation", "n_nationkey").unionByName(node("customer", "Customer", "c_custkey")).unionByName(node("supplier", "Supplier", "s_suppkey")).unionByName(node("region", "Region", "r_regionkey"))
    edge = lambda n, a, ka, kind, b, kb: t(n).select(F.lit(a).alias("src_label"), F.concat(F.lit(f"{a}-"), ka).alias("src"), F.lit(kind).alias("type"), F.lit(b).alias("dst_label"), F.concat(F.lit(f"{b}-"), kb).alias("dst"))
    edges = edge("nation", "Nation", "n_nationkey", "PART_OF", "Region", "n_regionkey").unionByName(edge("customer", "Customer", "c_custkey", "LIVES_IN", "Nation", "c_nationkey")).unionByName(edge("supplier", "Supplier", "s_suppkey", "LIVES_IN", "Nation", "s_nationkey"))
    return nodes, edges


@query("""
select (select count(*) from nation) + (select count(*) from customer) + (select count(*) from supplier) + (select count(*) from region) as n_nodes, 4 as n_labels,
  (select count(*) from nation) + (select count(*) from customer) + (select count(*) from supplier) as n_edges, 2 as n_edge_types, 2 * ((select count(*) from nation) + (select count(*) from customer) + (select count(*) from supplier)) as n_edges_undirected
""")
def graph_counts(spark, sf_dir):
    return structure.graph_counts(*_graph(spark, sf_dir))


@query("""
select 'Nation' as label, count(*) as n from nation union all select 'Customer', count(*) from customer union all select 'Supplier', count(*) from supplier union all select 'Region', count(*) from region
""")
def label_counts(spark, sf_dir):
    return _graph(spark, sf_dir)[0].groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("""
with h as (select c_custkey, exists (select 1 from orders where o_custkey = c_custkey) as has from customer)
select count(*) as total, count(*) filter (where not has) as untyped, 100.0::double * count(*) filter (where not has) / count(*) as percent from h
""")
def untyped_coverage(spark, sf_dir):
    return structure.untyped(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), "id")


@query("""
select l_suppkey as src, l_partkey as dst, max(l_shipmode_type) as type from (select l_suppkey, l_partkey, l_returnflag || l_linestatus as l_shipmode_type from lineitem) group by all
""")
def simple_digraph(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.concat("l_returnflag", "l_linestatus").alias("type"))
    return structure.simple_digraph(e)


@query("""
select o_custkey, coalesce(min(o_orderkey) filter (where o_orderkey % 2 = 0), min(o_orderkey)) as o_orderkey, coalesce(min_by(o_orderstatus, o_orderkey) filter (where o_orderkey % 2 = 0), min_by(o_orderstatus, o_orderkey)) as first_status,
  coalesce(max_by(o_orderpriority, o_orderkey) filter (where o_orderkey % 2 = 1), max_by(o_orderpriority, o_orderkey)) as last_priority from orders group by o_custkey
""")
def graph_upsert(spark, sf_dir):
    """A stored table (even orders) and a new batch (odd ones): first-writer columns stay, last-seen columns follow."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("first_status"), F.col("o_orderpriority").alias("last_priority"))
    one = lambda r: r.groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"), F.min_by("first_status", "o_orderkey").alias("first_status"), F.max_by("last_priority", "o_orderkey").alias("last_priority"))
    return upsert(one(rows.where("o_orderkey % 2 = 0")), one(rows.where("o_orderkey % 2 = 1")), ["o_custkey"], {"o_orderkey": keep_first, "first_status": keep_first})


@query(f"""
select count(*) as n_chunks, count(distinct md5(text)) as n_identities, min(md5(text)) as low, max(md5(text)) as high from ({PAPER_SQL})
""")
def chunk_identity(spark, sf_dir):
    c = paper_chunks(spark, sf_dir)
    kept = build.chunk_identity(c)
    return kept.agg(F.count(F.lit(1)).alias("n_identities"), F.min("chunk_id").alias("low"), F.max("chunk_id").alias("high")).crossJoin(c.agg(F.count(F.lit(1)).alias("n_chunks")))


@query(r"""
with w as (select p_partkey, trim(regexp_replace(regexp_replace(p_name, '[-.,;:!?@#$%^&*()_{}<>/\\''"~\s\[\]]', ' ', 'g'), '\s+', ' ', 'g')) as s from part)
select p_partkey, array_to_string(list_transform(string_split(s, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') as canonical from w
""")
def canonical_ids(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", tx.canonical_id(F.col("p_name")).alias("canonical"))


EDGE_NAMES = ["has_method", "role_in_paper", "has_source", "relates_to", "assigned_to", "has_method_description", "writes_about", "made_up", "has_x::y", "has_contradiction", "has_subtopic", "spoke_about"]
_LABELS_SQL = "['Topic', 'Type', 'Agent', 'Role', 'Source', 'Description']"


@query(f"""
with e as (select l_orderkey, l_linenumber, ['has_method', 'role_in_paper', 'has_source', 'relates_to', 'assigned_to', 'has_method_description', 'writes_about', 'made_up', 'has_x::y', 'has_contradiction', 'has_subtopic', 'spoke_about'][(l_partkey % 12)::int + 1] as type,
  {_LABELS_SQL}[(l_suppkey % 6)::int + 1] as src_label, {_LABELS_SQL}[(l_orderkey % 6)::int + 1] as dst_label from lineitem),
r as (select * from (values ('has_method', 'Topic', 'Type'), ('role_in_paper', 'Agent', 'Role'), ('has_source', 'Topic', 'Source'), ('relates_to', 'Topic', 'Topic'), ('assigned_to', 'Topic', 'Agent'), ('has_method_description', 'Type', 'Description'),
  ('writes_about', 'Agent', 'Topic'), ('has_contradiction', 'Description', 'Contradiction'), ('has_subtopic', 'Topic', 'Topic'), ('spoke_about', 'Agent', 'Topic')) t(type, a, b))
select e.type, count(*) as n_valid from e join r on e.type = r.type and src_label = a and dst_label = b group by e.type
""")
def edge_validation(spark, sf_dir):
    labels = F.array(*map(F.lit, ("Topic", "Type", "Agent", "Role", "Source", "Description")))
    pick = lambda a, c, n: F.element_at(a, (F.col(c) % n + 1).cast("int"))
    e = table(spark, sf_dir, "lineitem").select(pick(F.array(*map(F.lit, EDGE_NAMES)), "l_partkey", 12).alias("type"), pick(labels, "l_suppkey", 6).alias("src_label"), pick(labels, "l_orderkey", 6).alias("dst_label"))
    e = e.withColumn("want", sanitize.expected_labels(F.col("type"))).where("src_label = want.src_label and dst_label = want.dst_label")
    return e.groupBy("type").agg(F.count(F.lit(1)).alias("n_valid"))


def _typed(e):
    """Edges of one graph per order as check_edges takes them."""
    none = F.create_map().cast("map<string,string>")
    props = F.col("props") if "props" in e.columns else none
    return e.select("doc_id", "chunk_pos", "edge_pos", "src", "dst", "type", props.alias("props"), "src_label", "dst_label")


def _no_types(spark):
    return spark.createDataFrame([], "doc_id string, chunk_pos long, topic string, types array<string>")


@query("""
with e as (select l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() over (partition by l_suppkey, l_orderkey, l_partkey order by l_linenumber) as nth from lineitem),
k as (select *, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) as slot from e where nth = 1)
select l_suppkey::varchar as doc_id, l_orderkey as chunk_pos, l_partkey::varchar as src from k where slot <= 3
""")
def has_source_cap(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("doc_id"), F.col("l_orderkey").alias("chunk_pos"), F.col("l_linenumber").cast("long").alias("edge_pos"), F.col("l_partkey").cast("string").alias("src"), F.lit("Doc").alias("dst"),
        F.lit("has_source").alias("type"), F.lit("Topic").alias("src_label"), F.lit("Source").alias("dst_label"),
    )
    return sanitize.check_edges(_typed(e), _no_types(spark)).select("doc_id", "chunk_pos", "src")


_T = ["method", "problem", "decision", "issue", "result", "dataset"]


@query("""
with t as (select l_orderkey, l_linenumber, ['method', 'problem', 'decision', 'issue', 'result', 'dataset'][(l_partkey % 6)::int + 1] as a, ['method', 'problem', 'decision', 'issue', 'result', 'dataset'][(l_suppkey % 6)::int + 1] as b,
  ['addresses', 'resolves', 'uses', 'compares_to', 'invented'][(l_orderkey % 5)::int + 1] as relation from (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem))
select l_orderkey as chunk_pos, l_linenumber::bigint as edge_pos, relation from t where (relation = 'addresses' and a = 'method' and b = 'problem') or (relation = 'resolves' and a = 'decision' and b = 'issue')
  or (relation = 'uses' and a = 'method' and b = 'dataset') or (relation = 'compares_to' and a = 'result' and b = 'result')
""")
def relates_to_pairs(spark, sf_dir):
    pick = lambda values, c: F.element_at(F.array(*map(F.lit, values)), (F.col(c) % len(values) + 1).cast("int"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("d").alias("doc_id"), F.col("l_orderkey").alias("chunk_pos"), F.col("l_linenumber").cast("long").alias("edge_pos"), F.concat_ws("-", F.lit("a"), "l_linenumber", "l_partkey", "l_suppkey").alias("src"), F.concat_ws("-", F.lit("b"), "l_linenumber", "l_partkey", "l_suppkey").alias("dst"), F.lit("relates_to").alias("type"),
        F.create_map(F.lit("relation"), F.initcap(F.replace(pick(["addresses", "resolves", "uses", "compares_to", "invented"], "l_orderkey"), F.lit("_"), F.lit(" ")))).alias("props"), F.lit("Topic").alias("src_label"), F.lit("Topic").alias("dst_label"),
        pick(_T, "l_partkey").alias("ta"), pick(_T, "l_suppkey").alias("tb"),
    )
    types = rows.select("doc_id", "chunk_pos", F.col("src").alias("topic"), F.array("ta").alias("types")).union(rows.select("doc_id", "chunk_pos", "dst", F.array("tb"))).distinct()
    return sanitize.check_edges(_typed(rows), types).select("chunk_pos", "edge_pos", F.col("props")["relation"].alias("relation"))


@query("""
select l_orderkey as chunk_pos, l_linenumber::bigint as edge_pos from (select distinct l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey % 3 = 0)
""")
def assigned_to_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.lit("d").alias("doc_id"), F.col("l_orderkey").alias("chunk_pos"), F.col("l_linenumber").cast("long").alias("edge_pos"), F.concat_ws("-", F.lit("t"), "l_linenumber", "l_partkey").alias("src"), F.lit("Ann").alias("dst"), F.lit("assigned_to").alias("type"), F.lit("Topic").alias("src_label"), F.lit("Agent").alias("dst_label"), "l_partkey")
    types = rows.select("doc_id", "chunk_pos", F.col("src").alias("topic"), F.when(F.col("l_partkey") % 3 == 0, F.array(F.lit("action item"), F.lit("idea"))).otherwise(F.array(F.lit("idea"))).alias("types")).distinct()
    return sanitize.check_edges(_typed(rows), types).select("chunk_pos", "edge_pos")


@query(f"""
with r as (select conv_id, turn, case when turn % 3 = 1 then role end as format, case when turn % 2 = 1 then 'in ' || (1990 + (conv_id + turn) % 40) end as d from ({MEETING_SQL})),
w as (select conv_id, turn, first_value(format ignore nulls) over s as format, first_value(d ignore nulls) over s as date_raw from r window s as (partition by conv_id order by turn rows between unbounded preceding and current row))
select conv_id::varchar as doc_id, turn as chunk_pos, format, date_raw, substr(date_raw, 4) as year from w
""")
def source_metadata_first(spark, sf_dir):
    turn, conv = F.col("turn"), F.col("conv_id")
    date = F.when(turn % 2 == 1, F.concat(F.lit(" in "), (1990 + (conv + turn) % 40).cast("string")))
    props = F.map_filter(F.map_from_arrays(F.array(F.lit("format"), F.lit("date")), F.array(F.when(turn % 3 == 1, F.col("role")), date)), lambda k, v: v.isNotNull())
    nodes = meeting_chunks(spark, sf_dir).select(conv.cast("string").alias("doc_id"), turn.alias("chunk_pos"), F.lit(0).cast("long").alias("node_pos"), F.lit("s").alias("id"), F.lit("source").alias("label"), props.alias("props"))
    return sanitize.source_metadata(nodes)


def _names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("chunk_pos"), F.lit(0).cast("long").alias("node_pos"), F.col("p_name").alias("id"), F.lit("topic").alias("label"), F.create_map().cast("map<string,string>").alias("props"))


@query()
def topic_dedupe_fold(spark, sf_dir):
    return sanitize.topic_aliases(_names(spark, sf_dir), 0.8)


@query("""
with l as (select l_suppkey, l_orderkey, l_linenumber, l_partkey, ['Method', 'Decision', 'Result'][(l_partkey % 3)::int + 1] as kind from lineitem),
ok as (select *, l_suppkey % 2 = 0 and kind = 'Decision' as bad from l),
t as (select l_suppkey, count(*) as n from (select distinct l_suppkey, l_orderkey, l_partkey from ok) group by 1),
y as (select l_suppkey, count(*) as n from (select distinct l_suppkey, l_orderkey, kind from ok where not bad) group by 1),
s as (select l_suppkey, count(*) as n from (select distinct l_suppkey, l_orderkey from ok) group by 1),
e as (select l_suppkey, 'has_type' as type, count(*) as n_edges from (select distinct l_suppkey, l_orderkey, l_partkey, kind from ok where not bad) group by 1
  union all select l_suppkey, 'has_source', least(3, count(*)) from (select distinct l_suppkey, l_orderkey, l_partkey from ok) group by 1)
select e.l_suppkey::varchar as doc_id, e.type, e.n_edges, t.n + coalesce(y.n, 0) + s.n as n_nodes from e join t using (l_suppkey) join s using (l_suppkey) left join y using (l_suppkey)
""")
def sanitized_graph(spark, sf_dir):
    """The whole sanitizer over a graph made of line items: topics are parts, types go by return flag, suppliers are agents."""
    li = table(spark, sf_dir, "lineitem")
    doc, pos, at = F.col("l_suppkey").cast("string").alias("doc_id"), F.col("l_orderkey").alias("chunk_pos"), F.col("l_linenumber").cast("long") * 10
    topic, kind = F.concat(F.lit("part "), F.col("l_partkey")), F.element_at(F.array(F.lit("Method"), F.lit("Decision"), F.lit("Result")), (F.col("l_partkey") % 3 + 1).cast("int"))
    none = F.create_map().cast("map<string,string>")
    n = li.select(doc, pos, F.explode(F.array(F.struct(at.alias("node_pos"), topic.alias("id"), F.lit("Topic").alias("label")), F.struct((at + 1).alias("node_pos"), kind.alias("id"), F.lit("Type").alias("label")))).alias("n")).select("doc_id", "chunk_pos", "n.*", none.alias("props"))
    e = li.select(doc, pos, F.explode(F.array(F.struct(at.alias("edge_pos"), topic.alias("src"), kind.alias("dst"), F.lit("has_x").alias("type")), F.struct((at + 1).alias("edge_pos"), topic.alias("src"), F.lit("the source").alias("dst"), F.lit("has_source").alias("type")))).alias("e")).select("doc_id", "chunk_pos", "e.*", none.alias("props"))
    docs = n.select("doc_id").distinct().select("doc_id", F.lit("The Source").alias("source_name"), F.when(F.col("doc_id").cast("long") % 2 == 0, "paper").alias("domain"))
    nodes, edges = sanitize.sanitize(n, e, docs, 1.1)
    return edges.groupBy("doc_id", "type").agg(F.count(F.lit(1)).alias("n_edges")).join(nodes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_nodes")), "doc_id")

