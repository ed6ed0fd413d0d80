"""Files, snapshots, stores, model calls and reports, on whole tables."""

from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from strataloom import models
from strataloom import ontology as o
from strataloom.functions import text as tx
from strataloom.operators import blocking, build, conflict, ledger, reports, stages, structure, validate
from strataloom.operators import sanitize as sz
from strataloom.plans.conflict_queries import FLOOR, NEAR, _claims
from strataloom.plans.ingest_queries import _uploads
from strataloom.plans.registry import MEETING_SQL, ORACLE, PAPER_SQL, meeting_chunks, paper_chunks, query, table
from strataloom.session import materialize, scratch_path
from strataloom.sources import chunks as ch
from strataloom.sources import graphs
from strataloom.sources.tables import SnapshotTable, keep_first, take_new, upsert, widen
from strataloom.streaming import handoff

DAY = "2024-01-01"


def _now(day: str = DAY):
    return F.lit(day).cast("timestamp")


def _title(name: str) -> str:
    """SQL for the canonical form of plain lower- or upper-case words parted by blanks."""
    return f"array_to_string(list_transform(string_split(lower({name}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


# --- files --------------------------------------------------------------------------------------------------------------


@query(f"select filename as doc_id, chunk_pos as index, md5(text) as text_md5 from ({PAPER_SQL})")
def jsonl_round_trip(spark, sf_dir):
    """Documents written as chunk files and read back from the folder; a bad line would end the query."""
    at = scratch_path(spark, "lines")
    ch.write_lines(paper_chunks(spark, sf_dir).select("text", F.col("filename").alias("doc_id"), F.col("chunk_pos").alias("index")), at)
    parsed = ch.parse(ch.read_lines(spark, at, "part-*"), strict=True)
    return parsed.select("r.doc_id", "r.index", F.md5("r.text").alias("text_md5"))


@query("select n_name as doc_id, n_nationkey::bigint as index from nation")
def lines_in_memory(spark, sf_dir):
    lines = table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.lit("x").alias("text"), F.col("n_name").alias("doc_id"), F.col("n_nationkey").alias("index"))).alias("j"))
    data = "\n".join(r.j for r in lines.collect()).encode()  # 25 rows: the form of input is bytes in memory
    return ch.parse(ch.lines_of(spark, data)).select("r.doc_id", "r.index")


@query("select o_orderkey, o_orderkey % 4 = 0 as is_payload from orders")
def payload_sniffing(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.concat(F.lit('{"chunks": ['), "o_orderkey", F.lit("]}"))).when(k == 1, '{"chunks": {"a": 1}}').when(k == 2, "[1, 2]").otherwise("not json")
    return table(spark, sf_dir, "orders").select("o_orderkey", ch.looks_like_payload(text).alias("is_payload"))


@query(f"""
select case when conv_id % 2 = 0 then 'chunk ' || conv_id else 'whole ' || conv_id end as doc_id, turn as index, count(*) over (partition by conv_id) as n_chunks, 'en' as text_language, turn * 10 as start_ms, md5(text) as text_md5
from ({MEETING_SQL})
""")
def meeting_payload_rows(spark, sf_dir):
    """The chunk's own meeting id counts, else the payload's; the producer's fields come along."""
    fields = {f.name: f.dataType for f in ch.PAYLOAD["chunks"].dataType.elementType.fields}
    given = {"chunk_id": F.col("turn").cast("string"), "meeting_id": F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("chunk "), "conv_id")), "text": F.col("text"), "start_ms": F.col("turn") * 10, "text_language": F.lit("en")}
    one = F.struct(*(given.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields.items()))
    turns = meeting_chunks(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", one.alias("c")))).alias("t"))
    meta = F.struct(F.concat(F.lit("whole "), "conv_id").alias("meeting_id"), F.lit(None).cast("string").alias("input"), F.size("t").cast("long").alias("conversation_chunks"))
    rows = ch.from_payload(turns.select(meta.alias("metadata"), F.transform("t", lambda t: t["c"]).alias("chunks")))
    return rows.select("doc_id", "index", "n_chunks", "text_language", "start_ms", F.md5("text").alias("text_md5"))


@query("""
with b as (select conv_id % 8 as bucket, count(*) as n from conversations group by 1)
select bucket as id, case when bucket % 4 = 1 then 'failed' else 'downloaded' end as status, case when bucket % 4 = 1 then 'digest mismatch' end as error, case when bucket % 4 = 1 then 0 else n end as n_lines from b
""")
def hand_off_files(spark, sf_dir):
    """Objects of eight producers are checked against their digests and validated; what passes is written as chunk files."""
    at = scratch_path(spark, "objects")
    pos = F.row_number().over(Window.partitionBy("bucket").orderBy("conv_id", "turn")) - 1
    rows = meeting_chunks(spark, sf_dir).withColumn("bucket", F.col("conv_id") % 8)
    line = F.to_json(F.struct("text", F.concat(F.lit("b"), "bucket").alias("doc_id"), pos.alias("index"), F.lit("transcript").alias("source_kind")))
    rows = materialize(rows.select("bucket", pos.alias("at"), line.alias("value")), "objects")
    for k in range(8):
        rows.where(F.col("bucket") == k).orderBy("at").select("value").coalesce(1).write.text(f"{at}/in/{k}")  # an object is a file
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{at}/in").where("length > 0")
    k = F.element_at(F.split("path", "/"), -2).cast("long")
    none = F.lit(None)
    uploads = files.select(
        k.alias("id"), F.lit("meeting").alias("doc_type"), F.concat(F.lit("b"), k).alias("doc_id"), none.cast("string").alias("owner"), F.concat(F.lit("inbox/"), F.element_at(F.split("path", "/"), -1)).alias("storage_path"),
        F.when(k % 4 == 1, "0").otherwise(F.sha2("content", 256)).alias("sha256"), none.cast("long").alias("n_chunks"), F.lit("pending").alias("status"), none.cast("string").alias("error"), _now().alias("uploaded_at"),
    )
    outcomes = materialize(handoff.check_files(spark, uploads, f"{at}/in", f"{at}/out"), "outcomes")
    written = ch.parse(ch.read_lines(spark, f"{at}/out", "part-*")).groupBy("r.doc_id").agg(F.count(F.lit(1)).alias("n")).select(F.substring("doc_id", 2, 9).cast("long").alias("id"), "n")
    return outcomes.join(written, "id", "left").select("id", "status", "error", F.coalesce("n", F.lit(0)).alias("n_lines"))


@query("""
select s_suppkey::varchar as doc_id, 'inbox/' || s_suppkey || '__' || left(sha256(s_name), 8) || '.jsonl' as storage_path, s_suppkey % 5 as n_chunks from supplier where s_suppkey % 3 <> 0
""")
def producer_offer(spark, sf_dir):
    """A producer's files that the manifest doesn't know yet."""
    doc, body = F.col("s_suppkey").cast("string"), F.col("s_name").cast("binary")
    s = table(spark, sf_dir, "supplier")
    files = s.select(F.col("s_name").alias("path"), body.alias("content"), doc.alias("doc_id"), (F.col("s_suppkey") % 5).alias("n_chunks"), F.lit(True).alias("ok"))
    known = s.where("s_suppkey % 3 = 0").select(F.lit("paper").alias("doc_type"), doc.alias("doc_id"), F.sha2(body, 256).alias("sha256"))
    return handoff.offer(files, known, "inbox/", "paper").select("doc_id", "storage_path", "n_chunks")


@query(f"""
select distinct 'node' as kind, p_brand as doc, {_title('p_name')} as a, 'Topic' as b, null as relation from part
union select distinct 'edge', p_brand, {_title('p_name')}, {_title('p_type')}, 'uses' from part
""")
def graph_dump_load(spark, sf_dir):
    """Graphs written as one object per document and read back with ids in canonical form."""
    p = table(spark, sf_dir, "part")
    at = scratch_path(spark, "graphs")
    nodes = p.select(F.col("p_brand").alias("doc_id"), F.col("p_name").alias("id"), F.lit("Topic").alias("label"))
    edges = p.select(F.col("p_brand").alias("doc_id"), F.col("p_name").alias("src"), F.col("p_type").alias("dst"), F.lit("relates_to").alias("type"), F.create_map(F.lit("relation"), F.lit("uses")).alias("props"))
    graphs.dump(nodes, edges, "m", at)
    n, e = graphs.load(spark, at)
    rows = n.select(F.lit("node").alias("kind"), "doc", F.col("id").alias("a"), F.col("label").alias("b"), F.lit(None).cast("string").alias("relation"))
    return rows.unionByName(e.select(F.lit("edge").alias("kind"), "doc", F.col("src").alias("a"), F.col("dst").alias("b"), "relation")).distinct()


@query("select 1::bigint as ok")
def smoke(spark, sf_dir):
    return reports.smoke(spark)


# --- snapshots and stores -----------------------------------------------------------------------------------------------


@query("select c_custkey, c_mktsegment from customer where c_custkey % 2 = 0 union all select c_custkey, 'again' from customer where c_custkey % 2 = 1")
def snapshot_rewrite(spark, sf_dir):
    """A snapshot rewritten from itself: readers see the old rows or the new ones."""
    t = SnapshotTable(spark, scratch_path(spark, "snapshot"), "c_custkey long, c_mktsegment string")
    t.publish(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    t.publish(t.read().withColumn("c_mktsegment", F.when(F.col("c_custkey") % 2 == 1, "again").otherwise(F.col("c_mktsegment"))))
    return t.read()


@query("select c_custkey, c_mktsegment, null::varchar as added from customer")
def schema_widening(spark, sf_dir):
    """Rows stored before a column was added have null in it."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    schema = spark.createDataFrame([], "c_custkey long, c_mktsegment string, added string").schema
    return widen(rows, schema)


@query("select source as filename, 2::bigint as n_versions, count(distinct doc_id) as n_records from documents group by source")
def document_nodes(spark, sf_dir):
    """Each build appends a document row of its own, stamped with its time."""
    rows = paper_chunks(spark, sf_dir).select(F.lit("f").alias("file"), F.col("filename").alias("doc_id"), F.col("chunk_pos").alias("line_no"), *(F.lit(None).cast("string").alias(c) for c in ("source_path", "source_kind", "date", "series", "doc_type")), F.lit(None).cast("long").alias("n_chunks"))
    t = SnapshotTable(spark, scratch_path(spark, "documents"), "filename string, document_version int, n_records long, created_at timestamp")
    for v in (1, 2):
        t.publish(t.read().unionByName(ch.documents(rows, v).select("filename", "document_version", "n_records", _now(f"2024-01-0{v}").alias("created_at"))))
    return t.read().groupBy("filename").agg(F.countDistinct("document_version", "created_at").alias("n_versions"), F.max("n_records").alias("n_records"))


@query("""
select c_custkey::varchar as id, case when c_custkey % 3 = 0 and c_custkey % 2 = 0 then 'set' else c_mktsegment end as segment, c_nationkey::varchar as nation, case when c_custkey % 3 = 0 then (c_custkey * 2)::varchar end as twice from customer
""")
def property_write_back(spark, sf_dir):
    """Only given keys are set, nulls leave a property as it is, and unknown ids are ignored."""
    c = table(spark, sf_dir, "customer")
    ident = F.col("c_custkey").cast("string")
    stored = c.select(F.lit("Source").alias("label"), ident.alias("id"), F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string")).alias("props"), _now().alias("created_at"))
    told = c.where("c_custkey % 3 = 0").select(ident.alias("id"), F.when(F.col("c_custkey") % 2 == 0, "set").alias("segment"), (F.col("c_custkey") * 2).cast("string").alias("twice"))
    told = told.unionByName(told.select(F.concat(F.lit("no "), "id").alias("id"), "segment", "twice"))
    p = F.col("props")
    return build.set_properties(stored, told).select("id", p["segment"].alias("segment"), p["nation"].alias("nation"), p["twice"].alias("twice"))


@query("select r_name as name, case when r_regionkey > 2 then r_regionkey + 0.5 else r_regionkey::double end as value from region")
def metric_upsert(spark, sf_dir):
    """Measures of the graph by name: a new value takes the old one's place, the others stay."""
    r = table(spark, sf_dir, "region")
    old = r.select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("double").alias("value"))
    return upsert(old, old.where("value > 2").withColumn("value", F.col("value") + 0.5), ["name"])


@query("""
select s_nationkey::varchar as id, max_by(s_name, s_suppkey) as last_name, min(s_suppkey) as first_key from supplier group by s_nationkey
""")
def source_last_seen(spark, sf_dir):
    """What is last told of a source is stored; of any other node what was told first."""
    s = table(spark, sf_dir, "supplier")
    node = lambda label, key: s.select(F.lit(label).alias("label"), F.col("s_nationkey").cast("string").alias("id"), F.create_map(F.lit("v"), key).alias("props"), F.lit("d").alias("doc_id"), F.col("s_suppkey").alias("chunk_pos"), F.lit(0).cast("long").alias("node_pos"))
    both = node("Source", F.col("s_name")).unionByName(node("Topic", F.col("s_suppkey").cast("string")))
    empty = spark.createDataFrame([], build.NODES)
    out = build.store_nodes(empty, both, _now())
    v = F.col("props")["v"]
    return out.groupBy("id").agg(F.max(F.when(F.col("label") == "Source", v)).alias("last_name"), F.max(F.when(F.col("label") == "Topic", v)).cast("long").alias("first_key"))


@query("select c_custkey, case when c_custkey % 2 = 0 then timestamp '2023-05-05' else timestamp '2024-01-01' end as created_at from customer")
def created_at_kept(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    old = c.where("c_custkey % 2 = 0").withColumn("created_at", _now("2023-05-05"))
    return structure.stamp_created(old, c, ["c_custkey"], _now())


@query("""
select o_orderkey::varchar as pair_key, case when o_orderkey % 3 = 0 then 'no' else 'yes' end as supersession_result, case when o_orderkey % 3 = 0 then null else o_orderpriority end as supersession_reason, o_totalprice as similarity from orders
""")
def supersession_write_back(spark, sf_dir):
    """A judged pair's result overwrites the stored one, null reasons included; other columns and pairs stay."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("pair_key"), F.lit("yes").alias("supersession_result"), F.col("o_orderpriority").alias("supersession_reason"), F.col("o_totalprice").alias("similarity"))
    told = rows.where("cast(pair_key as long) % 3 = 0").select("pair_key", F.lit("no").alias("supersession_result"), F.lit(None).cast("string").alias("supersession_reason"))
    return upsert(rows, told, ["pair_key"], {"supersession_result": take_new, "supersession_reason": take_new})


@query("""
select c_custkey::varchar as cluster_key, case when c_custkey % 2 = 0 then 'written' else 'none' end as outcome, case when c_custkey % 4 = 0 then timestamp '2023-01-01' else timestamp '2024-01-01' end as created_at from customer where c_custkey % 4 <> 3
""")
def cluster_record_upsert(spark, sf_dir):
    """A cluster's record is overwritten, but for the time it was first made."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("cluster_key"), F.col("c_custkey").alias("k"))
    old = c.where("k % 4 = 0").select("cluster_key", F.lit("old").alias("outcome"), _now("2023-01-01").alias("created_at"))
    new = c.where("k % 4 <> 3").select("cluster_key", F.when(F.col("k") % 2 == 0, "written").otherwise("none").alias("outcome"), _now().alias("created_at"))
    return upsert(old, new, ["cluster_key"], {"created_at": keep_first})


@query("select o_orderkey::varchar as doc_id, 'd' || o_orderkey as digest from orders where o_orderkey % 5 <> 0 order by o_orderkey::varchar limit 25")
def ledger_limit(spark, sf_dir):
    """The first documents by id that the ledger doesn't hold; the limit comes after the ledger."""
    d = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), F.concat(F.lit("d"), "o_orderkey").alias("digest"))
    built = d.where("cast(doc_id as long) % 5 = 0")
    return ledger.pending(d, built, limit=25)


@query("select o_orderkey::varchar as doc_id, 'd' || o_orderkey as digest from orders")
def ledger_rebuild(spark, sf_dir):
    """A rebuild takes all documents, whatever the ledger holds."""
    d = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), F.concat(F.lit("d"), "o_orderkey").alias("digest"))
    return ledger.pending(d, d, rebuild=True)


@query("""
select o_custkey::varchar as doc_id, max(o_orderkey)::varchar as digest, count(*) as n_chunks, max(o_orderdate) as built_at from orders where o_custkey % 7 <> 0 group by o_custkey
""")
def ledger_record_forget(spark, sf_dir):
    """Documents are recorded as they are built, a later build in place of an earlier; forgotten ones are gone."""
    r = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("doc_id")).agg(F.max("o_orderkey").cast("string").alias("digest"), F.lit("paper").alias("doc_type"), F.lit("f").alias("source_file"), F.count(F.lit(1)).alias("n_chunks"), F.max("o_orderdate").alias("built_at"))
    first = r.withColumn("digest", F.lit("old"))
    gone = r.where("cast(doc_id as long) % 7 = 0")
    kept = ledger.forget(ledger.record(first, r), gone)
    return reports.ledger_listing(kept).join(ledger.lookup(kept, r).select("doc_id", "digest"), "doc_id").select("doc_id", "digest", "n_chunks", "built_at")


@query("""
select conv_id::varchar as filename, count(*) as n_done, case when min(turn % 2) = 0 and max(turn % 2) = 0 then timestamp '2023-01-01' else timestamp '2024-01-01' end as last_done from conversations where conv_id % 5 <> 0 group by conv_id
""")
def progress_marked(spark, sf_dir):
    """Chunks marked done in two runs, the first time kept; documents that are finished are cleared."""
    rows = meeting_chunks(spark, sf_dir).select(F.col("conv_id").cast("string").alias("filename"), F.lit(1).alias("document_version"), F.lit("x").alias("digest"), F.col("turn").cast("string").alias("chunk_key"), "turn")
    first = rows.where("turn % 2 = 0").drop("turn").withColumn("done_at", _now("2023-01-01"))
    both = ledger.mark_done(first, rows.drop("turn").withColumn("done_at", _now()))
    left = ledger.clear(both, rows.where("cast(filename as long) % 5 = 0"))
    return reports.progress_listing(left).select("filename", "n_done", "last_done")


# --- functions ----------------------------------------------------------------------------------------------------------


@query("""
select o_orderkey, case o_orderkey % 4 when 0 then 'paper' when 1 then 'meeting' end as domain, case o_orderkey % 4 when 0 then 'PDF ' when 1 then 'transcript' when 2 then 'txt' else case when o_orderkey % 8 = 3 then 'md' else 'unknown' end end as format,
  case when o_orderkey % 2 = 0 then lower(left(o_orderstatus, 1)) || '_folder' end as doc_type from orders
""")
def formats_and_domains(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    kind = F.when(k == 0, "PDF ").when(k == 1, "transcript").when(k == 2, "").otherwise(F.lit(None))
    name = F.when(k == 2, F.concat("o_orderpriority", F.lit(".TXT"))).when(F.col("o_orderkey") % 8 == 3, F.concat("o_orderpriority", F.lit(".md"))).otherwise("noext")
    path = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("data/"), F.lower(F.left("o_orderstatus", F.lit(1))), F.lit("_folder/x.jsonl"))).otherwise("x.jsonl")
    return table(spark, sf_dir, "orders").select("o_orderkey", ch.expected_domain(kind).alias("domain"), ch.source_format(kind, name).alias("format"), ch.doc_type_of(path).alias("doc_type"))


@query(f"""
with t as (select p_partkey, case p_partkey % 5 when 0 then 'Table ' || p_partkey when 1 then 'Fig A' when 2 then p_name when 3 then 'Table Of ' || p_partkey else 'section ' || p_size || 'b' end as topic from part)
select p_partkey, regexp_matches(topic, '(?i)^({"|".join(o.FRAGMENT_WORDS)})(\\s+([0-9]+[A-Za-z]?|[A-Za-z]))+$') as fragment from t
""")
def fragment_topics(spark, sf_dir):
    k = F.col("p_partkey") % 5
    topic = F.when(k == 0, F.concat(F.lit("Table "), "p_partkey")).when(k == 1, "Fig A").when(k == 2, F.col("p_name")).when(k == 3, F.concat(F.lit("Table Of "), "p_partkey")).otherwise(F.concat(F.lit("section "), "p_size", F.lit("b")))
    return table(spark, sf_dir, "part").select("p_partkey", tx.is_fragment_topic(topic).alias("fragment"))


@query("""
with w as (select p_partkey, string_split(lower(p_name || ' ' || p_type), ' ') as w from part)
select p_partkey, w[1] || array_to_string(list_transform(w[2:], lambda x: upper(x[1]) || x[2:]), '') as key from w
""")
def property_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", tx.property_key(F.concat(F.lit(" "), "p_name", F.lit("  "), "p_type")).alias("key"))


@query("select o_orderkey, case when o_orderkey % 5 in (0, 1, 2) then o_orderkey end as a from orders")
def json_salvage(spark, sf_dir):
    """The outermost object of a reply, code fences and talk around it left out; null where there is none."""
    k, body = F.col("o_orderkey") % 5, F.concat(F.lit('{"a": '), "o_orderkey", F.lit(', "b": {"c": 1}}'))
    reply = F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 1, F.concat(F.lit("Here: "), body, F.lit(" so it is."))).when(k == 2, body).when(k == 3, "no object at all").otherwise('{"a": ')
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.salvage_json(reply, "a long, b map<string,string>")["a"].alias("a"))


@query("""
with l as (select *, row_number() over (partition by l_orderkey order by l_partkey, l_linenumber, l_suppkey, l_extendedprice) as pos from lineitem),
b as (select l_orderkey, pos, '[' || pos || '] ' || l_partkey || ' (source ' || coalesce(case when l_suppkey % 3 <> 0 then l_suppkey::varchar end, 'unknown') || ', topic ' || l_returnflag || '): ' || l_linestatus
  || case when l_suppkey % 2 = 0 then chr(10) || '    context: one | two' else '' end as line from l)
select l_orderkey, md5(string_agg(line, chr(10) order by pos)) as block_md5 from b group by l_orderkey
""")
def participants_blocks(spark, sf_dir):
    """The text that a model gets of a cluster's participants."""
    at = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice"))
    context = F.when(F.col("l_suppkey") % 2 == 0, F.array(F.lit("one"), F.lit("two"))).otherwise(F.array().cast("array<string>"))
    one = F.struct(at.alias("at"), F.col("l_partkey").cast("string").alias("id"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey").cast("string")).alias("source"), F.col("l_returnflag").alias("topic"), F.col("l_linestatus").alias("text"), context.alias("context"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", one.alias("p")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return rows.select("l_orderkey", F.md5(models.participants_block(F.col("p"))).alias("block_md5"))


@query(f"select {_title('p_name')} as id, '20' || lpad((p_partkey % 30)::varchar, 2, '0') || '-05-06' as date_raw, '20' || lpad((p_partkey % 30)::varchar, 2, '0') as year from part where p_partkey % 4 <> 0")
def producer_dates(spark, sf_dir):
    """A producer's date overrules what the text told, unchecked."""
    date = F.when(F.col("p_partkey") % 4 != 0, F.concat(F.lit("20"), F.lpad((F.col("p_partkey") % 30).cast("string"), 2, "0"), F.lit("-05-06")))
    return build.producer_metadata(table(spark, sf_dir, "part").select(F.col("p_name").alias("source_name"), date.alias("date")))


# --- validation ---------------------------------------------------------------------------------------------------------


@query("""
with r as (select conv_id, turn from conversations where (conv_id + turn) % 5 <> 2), s as (select conv_id, count(*) as n, min(turn) as low, max(turn) as high from r group by conv_id)
select 'f' || conv_id as file, case when conv_id % 7 = 0 then 'failed' when low <> 0 or n <> high - low + 1 then 'warned' else 'clean' end as state, conv_id % 7 <> 0 as ok from s
""")
def validate_report(spark, sf_dir):
    """Files by state: failed with a line that is no JSON, warned with holes in the index, else clean."""
    rows = meeting_chunks(spark, sf_dir).where("(conv_id + turn) % 5 <> 2")
    good = F.to_json(F.struct(F.lit("some text").alias("text"), F.concat(F.lit("d"), "conv_id").alias("doc_id"), F.col("turn").alias("index"), F.lit("transcript").alias("source_kind")))
    lines = rows.select(F.concat(F.lit("f"), "conv_id").alias("file"), F.col("turn").cast("int").alias("line_no"), F.when(F.col("conv_id") % 7 == 0, "{broken").otherwise(good).alias("line"))
    parsed = ch.parse(lines)
    return validate.file_summary(parsed, validate.validate(parsed)).select("file", "state", "ok")


# --- graphs and clusters ------------------------------------------------------------------------------------------------


@query("""
with n as (select c_nationkey as k, c_custkey, 'full ' || c_custkey as id, 'ab' || c_custkey % 5 as abbreviation from customer),
f as (select k, abbreviation, max_by(id, c_custkey) as target from n group by all)
select distinct k::bigint as chunk_pos, abbreviation as id, target from f
""")
def abbreviation_merge(spark, sf_dir):
    """Nodes named like another one's abbreviation, whatever the case; of several such nodes the last counts."""
    c = table(spark, sf_dir, "customer")
    base = [F.lit("d").alias("doc_id"), F.col("c_nationkey").cast("long").alias("chunk_pos")]
    short = F.concat(F.lit("AB"), F.col("c_custkey") % 5)
    full = c.select(*base, F.col("c_custkey").alias("node_pos"), F.concat(F.lit("full "), "c_custkey").alias("id"), F.lit("Topic").alias("label"), F.create_map(F.lit("abbreviation"), short).alias("props"))
    named = c.select(*base, (F.col("c_custkey") + 10**9).alias("node_pos"), F.lower(short).alias("id"), F.lit("Topic").alias("label"), F.create_map().cast("map<string,string>").alias("props"))
    return sz.abbreviation_aliases(full.unionByName(named)).select("chunk_pos", "id", "target")


@query("""
with l as (select o_custkey, o_orderkey, o_orderkey::varchar as id from orders), c as (select o_custkey, sha1(string_agg(id, chr(31) order by id)) as cluster_key from l group by o_custkey having count(*) >= 2)
select cluster_key from c where o_custkey % 2 = 0 and o_custkey % 3 = 0
""")
def clusters_to_skip(spark, sf_dir):
    """Clusters that this version has recorded and whose very set of claims shares a contradiction."""
    found = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.col("o_orderkey").cast("string")).alias("ids")).where("size(ids) >= 2").withColumn("cluster_key", tx.participants_hash(F.col("ids")))
    records = found.select("cluster_key", F.when(F.col("o_custkey") % 2 == 0, o.CLASSIFICATION_VERSION).otherwise("older").alias("pipeline_version"))
    some = F.when(F.col("o_custkey") % 3 == 0, F.col("ids")).otherwise(F.slice(F.array_sort("ids"), 2, 1000))
    edges = found.select(F.concat(F.lit("n"), "o_custkey").alias("node_id"), F.explode(some).alias("description_id"))
    return conflict.to_skip(found.select("cluster_key", "ids"), records, edges).select("cluster_key")


@query("""
select l_orderkey::varchar as cluster_key, bool_or(l_suppkey % 3 = 0) as any_context, bool_and(l_suppkey % 3 = 0) as all_context from lineitem group by l_orderkey
""")
def scope_contexts(spark, sf_dir):
    """Clusters for whose sources scope texts are known: for any, for all."""
    part = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("cluster_key"), F.col("l_partkey").cast("string").alias("id"), F.col("l_suppkey").alias("source"))
    kind = F.when(F.col("s_suppkey") % 3 == 0, sorted(o.SCOPE_TYPES)[0]).otherwise("Result")
    return conflict.scope_context(part, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"), kind.alias("type")))


@query("""
select o_orderkey::varchar as pair_key, a.c_name as text_a, b.c_name as text_b from orders left join customer a on a.c_custkey = o_custkey left join customer b on b.c_custkey = o_custkey + 1
""")
def pair_lookups(spark, sf_dir):
    """Texts of both claims of every pair, null where a claim isn't stored."""
    pairs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("pair_key"), F.col("o_custkey").cast("string").alias("description_id_a"), (F.col("o_custkey") + 1).cast("string").alias("description_id_b"), F.lit("s").alias("source_id_a"), F.lit("t").alias("source_id_b"))
    return stages.pair_texts(pairs, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("text"))).select("pair_key", "text_a", "text_b")


@query("select l_suppkey as src, count(distinct l_partkey) as n_targets, md5(string_agg(distinct l_partkey::varchar, ',' order by l_partkey::varchar)) as targets_md5 from lineitem group by l_suppkey")
def adjacency_maps(spark, sf_dir):
    """Edges as maps by node and back."""
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("type"))
    back = reports.from_adjacency(reports.adjacency(e))
    return back.groupBy("src").agg(F.count(F.lit(1)).alias("n_targets"), F.md5(F.array_join(F.array_sort(F.collect_list(F.col("dst").cast("string"))), ",")).alias("targets_md5"))


@query("select count(*) as n_edges, count(distinct l_suppkey) as n_src from lineitem where l_suppkey % 2 = 0 and l_partkey % 3 = 0")
def known_relationships(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"), F.col("l_returnflag").alias("type"))
    nodes = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("id")).union(table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("p"), "p_partkey").alias("id")))
    return reports.known_relationships(e, nodes).agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("src").alias("n_src"))


@query("select l_orderkey::varchar as doc_id, l_suppkey::varchar as src, count(distinct l_partkey)::int as n from lineitem where l_returnflag <> 'N' group by all")
def has_source_counts(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), F.col("l_suppkey").cast("string").alias("src"), F.col("l_partkey").alias("dst"), F.when(F.col("l_returnflag") == "N", "relates_to").otherwise("Has_Source").alias("type"))
    return build.has_source_counts(e)


# --- reports ------------------------------------------------------------------------------------------------------------


@query("select distinct source as filename from documents")
def distinct_filenames(spark, sf_dir):
    return reports.filenames(paper_chunks(spark, sf_dir))


@query("select count(distinct c_nationkey) as n_communities from customer")
def community_count(spark, sf_dir):
    return reports.community_count(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("community_leiden")))


@query("select case when event_id % 2 = 0 then 'paper' else 'meeting' end as doc_type, count(*) as n from events where event_id % 3 = 0 group by 1")
def queue_counts(spark, sf_dir):
    return reports.queue_counts(_uploads(spark, sf_dir).where("status = 'pending'"))


@query("""
select p_name as topic, p_type as type, count(*) as n, count(distinct p_brand) as n_sources from part group by p_name, p_type having count(*) > 1 order by n desc, topic, type limit 20
""")
def description_checks(spark, sf_dir):
    return reports.description_checks(table(spark, sf_dir, "part").select(F.col("p_name").alias("topic"), F.col("p_type").alias("type"), F.col("p_brand").alias("source")))


@query("select o_orderstatus as outcome, count(*) as n, count(*) filter (where o_orderkey % 2 = 0) as n_cached from orders group by 1")
def outcome_stats(spark, sf_dir):
    return reports.outcome_stats(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("outcome"), (F.col("o_orderkey") % 2 == 0).alias("cached")))


@query("select conv_id::varchar as filename, count(*) as n_chunks, count(*) filter (where turn % 3 = 0) as n_skipped from conversations group by 1")
def skipped_chunks(spark, sf_dir):
    return reports.skipped_chunks(meeting_chunks(spark, sf_dir).select(F.col("conv_id").cast("string").alias("filename"), (F.col("turn") % 3 != 0).alias("eligible")))


# --- model calls --------------------------------------------------------------------------------------------------------


@query(f"""
select p_partkey as id, (p_partkey % 3 = 0 or {"p_partkey % 2 = 0"}) as embedded, case when p_partkey % 3 = 0 then 2 when p_partkey % 2 = 0 then 16 end as n from part
""")
def embed_missing(spark, sf_dir):
    """Claims of an allowed type without a vector get one; stored ones stay."""
    kind = F.when(F.col("p_partkey") % 2 == 0, sorted(o.ALLOWED_TYPES)[0]).otherwise("another")
    stored = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>"))
    d = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"), F.col("p_brand").alias("topic"), kind.alias("type"), stored.alias("embedding"))
    out = models.embed_missing(d, models.HashEmbedder(16), o.ALLOWED_TYPES, size=16)
    return out.select("id", F.col("embedding").isNotNull().alias("embedded"), F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("n"))


@query("select c_custkey as id, case when c_custkey % 2 = 0 then '{\"ok\": true}' end as reply, c_custkey % 2 = 1 as failed, case when c_custkey % 2 = 0 then 3 else 5 end as attempts from customer")
def model_retries(spark, sf_dir):
    """Calls that fail are tried again, five times at most; an error becomes a row."""

    class Flaky(models.ScriptedCompleter):
        def complete(self, prompt):
            self.failures = 2 if "even" in prompt else 99
            return super().complete(prompt)

    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.col("c_custkey"), F.when(F.col("c_custkey") % 2 == 0, " even").otherwise(" odd")).alias("prompt"))
    out = models.ask(asked, Flaky({"even": {"ok": True}}), "id", "prompt", sleep=lambda s: None)
    return out.select("id", "reply", F.col("error").isNotNull().alias("failed"), "attempts")


@query(r"""
with d as (select doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) < 40 as short from documents)
select a.doc_id::varchar as description_id_a, case when a.short or b.short then 'degenerate_text' else 'nli_neutral' end as gate_reason, 'rejected' as gate_status from d a join d b on b.doc_id = a.doc_id + 1
""")
def stage_gates(spark, sf_dir):
    """The gate stage over stored pairs, published in parts."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    pairs = d.select(F.col("id").alias("a")).join(d.select((F.col("id") - 1).alias("a")), "a")
    text = lambda c: c.cast("string")
    rows = pairs.select(tx.pair_key(text(F.col("a")), text(F.col("a") + 1)).alias("pair_key"), text(F.col("a")).alias("description_id_a"), text(F.col("a") + 1).alias("description_id_b"), F.lit("s").alias("source_id_a"), F.lit("t").alias("source_id_b"), F.lit("robots").alias("topic_a"), F.lit("robots").alias("topic_b"))
    t = SnapshotTable(spark, scratch_path(spark, "pairs"), blocking.CANDIDATES)
    t.publish(widen(rows, t.schema))
    stages.run_gates(d, t, models.ScriptedCompleter({"contradict": {"label": "neutral", "confidence": 0.99, "rationale": "r"}}), "m", _now(), flush=max(1, rows.count() // 2))
    return t.read().select("description_id_a", "gate_reason", "gate_status")


@query(ORACLE["blocking_stats"])
def stage_blocking(spark, sf_dir):
    """The blocking stage: candidates found and stored, with their counts."""
    t = SnapshotTable(spark, scratch_path(spark, "candidates"), blocking.CANDIDATES)
    return stages.run_blocking(_claims(spark, sf_dir), t, _now(), NEAR, FLOOR, None)


@query("""
select c_nationkey::varchar as filename, count(*) filter (where c_custkey % 4 <> 0) as n_graphs, count(*) as n_done from customer group by 1
""")
def resumable_build(spark, sf_dir):
    """A build that breaks off after replies to a half of the chunks, and the run that ends it."""
    c = table(spark, sf_dir, "customer")
    doc = F.col("c_nationkey").cast("string")
    chunks = c.select(doc.alias("filename"), F.lit(1).alias("document_version"), F.col("c_custkey").alias("chunk_pos"), F.col("c_custkey").cast("string").alias("chunk_key"), (F.col("c_custkey") % 4 != 0).alias("eligible"), F.concat(F.when(F.col("c_custkey") % 2 == 0, "even ").otherwise("odd "), "c_name").alias("text"), doc.alias("source"), F.lit("pdf").alias("source_kind"))
    digests = chunks.select("filename", "document_version", F.lit("x").alias("digest")).distinct()
    at = scratch_path(spark, "build")
    raw, progress = SnapshotTable(spark, f"{at}/raw", build.RAW), SnapshotTable(spark, f"{at}/progress", ledger.PROGRESS)
    graph = {"nodes": [{"id": "A", "type": "Topic", "properties": {}}], "relationships": []}
    build.extract_resumable(chunks, digests, raw, progress, models.ScriptedCompleter({"odd ": graph, "even ": "no graph"}), _now(), waves=2)
    build.extract_resumable(chunks, digests, raw, progress, models.ScriptedCompleter({"even ": graph, "odd ": "not asked again"}), _now(), waves=2)
    done = reports.progress_listing(progress.read()).select("filename", "n_done")
    return raw.read().where("nodes is not null").groupBy(F.col("doc_id").alias("filename")).agg(F.count(F.lit(1)).alias("n_graphs")).join(done, "filename")


@query("select n_nationkey::bigint as id, case when n_nationkey % 2 = 1 then 'raw' else 'whole' end as reply, 1 as attempts from nation")
def model_time_limits(spark, sf_dir):
    """A call that takes too long is given up by the clock, and the client asked again without a reply schema."""

    class Slow:
        def complete(self, prompt):
            if prompt.endswith("odd"):
                time.sleep(60)
            return "whole"

        def complete_raw(self, prompt):
            return "raw"

    key = F.col("n_nationkey").cast("long")
    asked = table(spark, sf_dir, "nation").select(key.alias("id"), F.concat(F.lit("nation "), F.when(key % 2 == 1, "odd").otherwise("even")).alias("prompt"))
    return models.ask(asked, Slow(), "id", "prompt", seconds=0.3).select("id", "reply", "attempts")


def _customers_as_claims(spark, sf_dir):
    """Customers as claims of one topic; the nation is the source, and its number gives the year."""
    c = table(spark, sf_dir, "customer")
    claims = c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").cast("string").alias("source"), F.lit("robots").alias("topic"), F.lit(sorted(o.ALLOWED_TYPES)[0]).alias("type"), F.col("c_name").alias("text"))
    sources = c.select(F.col("c_nationkey").cast("string").alias("id"), (F.col("c_nationkey") + 1990).cast("string").alias("year")).distinct()
    pairs = c.select(F.col("c_custkey").alias("a"), F.col("c_nationkey").alias("s")).join(c.select((F.col("c_custkey") - 1).alias("a"), F.col("c_nationkey").alias("t")), "a")
    one, two = F.col("a").cast("string"), (F.col("a") + 1).cast("string")
    rows = pairs.select("a", tx.pair_key(one, two).alias("pair_key"), one.alias("description_id_a"), two.alias("description_id_b"), F.col("s").cast("string").alias("source_id_a"), F.col("t").cast("string").alias("source_id_b"), F.lit("passed").alias("gate_status"))
    return claims, sources, rows


@query("""
select a.c_custkey::varchar as description_id_a, case when a.c_nationkey = b.c_nationkey then 'not_evaluable' else 'yes' end as supersession_result,
  case when a.c_nationkey > b.c_nationkey then a.c_custkey when a.c_nationkey < b.c_nationkey then b.c_custkey end::varchar as newer from customer a join customer b on b.c_custkey = a.c_custkey + 1
""")
def stage_supersession(spark, sf_dir):
    """The supersession stage over passed pairs: results in the pairs' table, edges from the newer claim."""
    claims, sources, rows = _customers_as_claims(spark, sf_dir)
    at = scratch_path(spark, "supersession")
    t, edges = SnapshotTable(spark, f"{at}/pairs", blocking.CANDIDATES), SnapshotTable(spark, f"{at}/edges", stages.SUPERSEDES)
    t.publish(widen(rows.drop("a"), t.schema))
    client = models.ScriptedCompleter({"replace": {"decision": "yes", "basis": sorted(o.SUPERSESSION_BASES)[0], "reason": "r", "confidence": 0.9}})
    stages.run_supersession(claims, sources, t, edges, client, "m")
    e = edges.read()
    newer = e.select(tx.pair_key(F.col("src"), F.col("dst")).alias("pair_key"), F.col("src").alias("newer"))
    return t.read().join(newer, "pair_key", "left").select("description_id_a", "supersession_result", "newer")


@query("""
select case when k::varchar < (k + 1)::varchar then k || ',' || (k + 1) else (k + 1) || ',' || k end as ids, case when k % 2 = 0 then 'written' else 'not_a_conflict' end as outcome, k % 2 = 0 as has_node
from (select a.c_custkey as k from customer a join customer b on b.c_custkey = a.c_custkey + 1 where a.c_custkey % 3 = 0)
""")
def stage_clusters(spark, sf_dir):
    """The clustering stage: pairs that passed become clusters, verdicts records, and written ones contradiction nodes."""
    claims, _, rows = _customers_as_claims(spark, sf_dir)
    claims = claims.withColumn("text", F.concat("text", F.when(F.col("id").cast("long") % 6 == 0, " even case").otherwise("")))
    at = scratch_path(spark, "clusters")
    t = SnapshotTable(spark, f"{at}/pairs", blocking.CANDIDATES)
    t.publish(widen(rows.where("a % 3 = 0").drop("a"), t.schema))
    records, nodes, edges = (SnapshotTable(spark, f"{at}/{n}", s) for n, s in (("records", stages.CLUSTERS), ("nodes", stages.CONTRADICTIONS), ("claims", stages.CLAIM_EDGES)))
    client = models.ScriptedCompleter({"even case": {"resolution_type": "known_controversy", "summary": "they differ", "confidence": 0.8, "evidence_used": [], "positions": []}, "oppose": {"resolution_type": "not_a_conflict", "confidence": 0.9}})
    stages.run_clusters(claims, t, records, nodes, edges, client, "m", _now())
    known = nodes.read().select(F.col("id").alias("contradiction_node_id"), F.lit(True).alias("known"))
    out = records.read().join(known, "contradiction_node_id", "left")
    return out.select(F.array_join("participant_ids", ",").alias("ids"), "outcome", F.coalesce("known", F.lit(False)).alias("has_node"))
