"""Ingestion, cleaning, eligibility, validation, ledger and hand-off."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataloom.functions import text as tx
from strataloom.operators import ledger, validate
from strataloom.plans.registry import MEETING_SQL, PAPER_SQL, meeting_chunks, paper_chunks, query, table
from strataloom.session import scratch_path
from strataloom.sources import chunks as ch
from strataloom.sources.tables import SnapshotTable
from strataloom.streaming import handoff


@query(PAPER_SQL.replace(", text, lang", ", length(text)::bigint as n_chars"))
def chunks_from_documents(spark, sf_dir):
    return paper_chunks(spark, sf_dir).select("filename", "document_version", "chunk_pos", "chunk_id", F.length("text").cast("long").alias("n_chars"))


@query(f"""
select conv_id::varchar as doc_id, turn as chunk_pos, count(*) over (partition by conv_id) as n_chunks,
  length(trim(regexp_replace(text, '^\\[[^\\]]*\\]\\s*', '', 'gm'), ' \t\n\r'))::bigint as speech_chars,
  length(trim(regexp_replace(text, '^\\[[^\\]]*\\]\\s*', '', 'gm'), ' \t\n\r')) >= 70 as eligible
from ({MEETING_SQL})
""")
def chunks_from_conversations(spark, sf_dir):
    turns = meeting_chunks(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    one = F.transform("t", lambda t: F.struct(t["turn"].cast("string").alias("chunk_id"), F.lit(None).cast("string").alias("meeting_id"), t["text"].alias("text"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in ch.PAYLOAD["chunks"].dataType.elementType.fields[3:])))
    payload = turns.select(F.struct(F.col("conv_id").cast("string").alias("meeting_id"), F.lit(None).cast("string").alias("input"), F.size("t").cast("long").alias("conversation_chunks")).alias("metadata"), one.alias("chunks"))
    rows = ch.from_payload(payload)
    return rows.select("doc_id", F.col("chunk_id").cast("long").alias("chunk_pos"), "n_chunks", tx.speech_length(F.col("text")).cast("long").alias("speech_chars"), F.col("extraction_eligible").alias("eligible"))


@query(r"""
select doc_id, length(trim(regexp_replace(regexp_replace(replace(text, chr(0), ' '), '\b12345\b', ' ', 'g'), '\s+', ' ', 'g')))::bigint as clean_chars,
  md5(trim(regexp_replace(regexp_replace(replace(text, chr(0), ' '), '\b12345\b', ' ', 'g'), '\s+', ' ', 'g'))) as clean_md5 from documents
""")
def clean_text_len(spark, sf_dir):
    clean = tx.clean_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(clean).cast("long").alias("clean_chars"), F.md5(clean.cast("binary")).alias("clean_md5"))


@query(r"""
with r as (select doc_id, text, doc_id % 3 = 0 as flag, case doc_id % 4 when 0 then [] when 1 then ['pdf_ligature'] when 2 then ['pdf_ligature', 'ocr_noise'] else ['line_break_hyphenation', 'pdf_ligature'] end as notes,
  case when doc_id % 8 < 4 then 'table_artifact' end as role, text || case when doc_id % 16 = 1 then '' else ' It shows this.' end as body from documents)
select doc_id, case when flag then true when len(notes) > 0 then len(list_filter(notes, lambda x: x not in ('pdf_ligature', 'line_break_hyphenation'))) = 0
  else coalesce(role, '') = 'table_artifact' and regexp_matches(body, '(?i)\b(shows?|summarizes?|reveals?|identifies?|presents?|outlines?|specifies?|indicates?|suggests?|demonstrates?)\b') end as eligible, flag as raw_eligible
from r
""")
def eligibility_flags(spark, sf_dir):
    k = F.col("doc_id") % 4
    notes = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lit("pdf_ligature"))).when(k == 2, F.array(F.lit("pdf_ligature"), F.lit("ocr_noise"))).otherwise(F.array(F.lit("line_break_hyphenation"), F.lit("pdf_ligature")))
    body = F.concat("text", F.when(F.col("doc_id") % 16 == 1, "").otherwise(" It shows this."))
    flag = F.col("doc_id") % 3 == 0
    role = F.when(F.col("doc_id") % 8 < 4, "table_artifact")
    return table(spark, sf_dir, "documents").select("doc_id", ch.effective_eligible(flag, notes, role, body).alias("eligible"), flag.alias("raw_eligible"))


@query(f"""
select filename, min_by(lang, chunk_pos) as lang, count(*) as n_records, min(chunk_pos) as first_pos, max(chunk_pos) as last_pos from ({PAPER_SQL}) group by filename
""")
def doc_rollup(spark, sf_dir):
    return paper_chunks(spark, sf_dir).groupBy("filename").agg(F.min_by("lang", "chunk_pos").alias("lang"), F.count(F.lit(1)).alias("n_records"), F.min("chunk_pos").alias("first_pos"), F.max("chunk_pos").alias("last_pos"))


def _holes(spark, sf_dir):
    """Conversations with what validation looks for: missing turns, missing indices, a declared count, no kind."""
    rows = meeting_chunks(spark, sf_dir).where("(conv_id + turn) % 5 <> 2")
    index = F.when((F.col("conv_id") + F.col("turn")) % 7 != 3, F.col("turn"))
    return rows.select(
        F.lit("conversations").alias("file"), F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").alias("line_no"), index.alias("index"), F.when(F.col("conv_id") % 2 == 0, F.lit(4).cast("long")).alias("n_chunks"),
        F.when(F.col("conv_id") % 3 != 0, "transcript").alias("source_kind"), "text", (F.col("turn") % 2 == 0).alias("raw_eligible"),
    )


HOLES_SQL = f"""
select conv_id::varchar as doc_id, turn as line_no, case when (conv_id + turn) % 7 <> 3 then turn end as index, case when conv_id % 2 = 0 then 4 end as n_chunks,
  case when conv_id % 3 <> 0 then 'transcript' end as source_kind, text, turn % 2 = 0 as raw_eligible from ({MEETING_SQL}) where (conv_id + turn) % 5 <> 2
"""


@query(f"select doc_id, count(*) as n_records, count(*) - count(index) as n_missing from ({HOLES_SQL}) group by doc_id having count(*) > count(index)")
def validate_missing_index(spark, sf_dir):
    s = validate.index_stats(_holes(spark, sf_dir), ["file", "doc_id"])
    return s.where("n_records > n_indexed").select("doc_id", "n_records", (F.col("n_records") - F.col("n_indexed")).alias("n_missing"))


@query(f"""
with s as (select doc_id, min(index) as low, max(index) as high, list(distinct index) filter (where index is not null) as have from ({HOLES_SQL}) group by doc_id),
g as (select doc_id, low, list_sort(list_filter(range(low, high + 1), lambda x: not list_contains(have, x))) as gaps from s where low is not null)
select doc_id, low as first_index, array_to_string(gaps, ',') as gaps from g where len(gaps) > 0 or low <> 0
""")
def validate_index_gaps(spark, sf_dir):
    s = validate.index_stats(_holes(spark, sf_dir), ["file", "doc_id"])
    return s.where("size(gaps) > 0 or low <> 0").select("doc_id", F.col("low").alias("first_index"), F.array_join(F.transform("gaps", lambda x: x.cast("string")), ",").alias("gaps"))


@query(f"""
select doc_id, count(*) as n_records, min_by(n_chunks, line_no) filter (where n_chunks is not null) as declared,
  min_by(source_kind, line_no) filter (where source_kind is not null) is null as no_kind, count(*) filter (where not raw_eligible) as n_ineligible, count(*) filter (where length(text) < 40) as n_short
from ({HOLES_SQL}) group by doc_id
""")
def validate_n_chunks(spark, sf_dir):
    s = validate.index_stats(_holes(spark, sf_dir), ["file", "doc_id"])
    return s.select("doc_id", "n_records", F.col("first_n_chunks").cast("int").alias("declared"), F.col("first_source_kind").isNull().alias("no_kind"), "n_ineligible", "n_short")


@query("""
with r as (select conv_id, role, turn, row_number() over (partition by conv_id, role order by turn) as nth from conversations)
select conv_id::varchar as doc_id, turn as line_no, 'duplicate_chunk' as code, role as msg from r where nth > 1
""")
def validate_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    line = F.to_json(F.struct("text", F.col("conv_id").cast("string").alias("doc_id"), F.col("role").alias("chunk_id")))
    parsed = ch.parse(rows.select(F.lit("conversations").alias("file"), F.col("turn").alias("line_no"), line.alias("line")))
    return validate.line_issues(parsed).where("code = 'duplicate_chunk'").select("doc_id", "line_no", "code", "msg")


@query("""
select doc_id::varchar as doc_id, case when doc_id % 10 = 0 then 'invalid_json' when doc_id % 10 = 1 then 'schema' when doc_id % 10 = 2 then 'unknown_fields' when doc_id % 10 = 3 then 'no_doc_id' else 'empty_text' end as code
from documents where doc_id % 10 < 4 or regexp_full_match(text, '\\s*')
""")
def validate_lines(spark, sf_dir):
    k = F.col("doc_id") % 10
    ident = F.when(k != 3, F.col("doc_id").cast("string"))
    line = F.when(k == 0, "{broken").when(k == 1, F.to_json(F.struct(ident.alias("doc_id")))).when(k == 2, F.to_json(F.struct("text", ident.alias("doc_id"), F.lit(1).alias("colour")))).otherwise(F.to_json(F.struct("text", ident.alias("doc_id"))))
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), F.lit(1).alias("line_no"), line.alias("line"))
    issues = validate.line_issues(ch.parse(lines))
    return issues.select(F.col("file").alias("doc_id"), "code")


@query("""
select event_id, array_to_string(list_sort(list_filter(json_keys(props), lambda k: k not in ('text', 'doc_id', 'chunk_id', 'index', 'n_chunks', 'source_path', 'source_file', 'source_kind', 'source_type', 'date', 'series', 'page', 'section',
  'content_role', 'quality_notes', 'extraction_eligible'))), ',') as unknown_fields from events
""")
def unknown_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.array_join(ch.unknown_fields(F.col("props")), ",").alias("unknown_fields"))


@query("""
select conv_id, sha256(string_agg(turn::varchar || chr(0) || text || chr(0), '' order by turn::varchar)) as digest, count(*) as n_chunks from conversations group by conv_id
""")
def content_digest(spark, sf_dir):
    return ledger.content_digest(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text")


def _digests(spark, sf_dir):
    d = ledger.content_digest(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text").select(F.col("conv_id").cast("string").alias("doc_id"), "digest", "n_chunks")
    recorded = d.where("cast(doc_id as long) % 2 = 0").withColumn("digest", F.when(F.col("doc_id").cast("long") % 6 == 0, "old").otherwise(F.col("digest")))
    return d, recorded.select("doc_id", "digest", F.lit("meeting").alias("doc_type"), F.lit(None).cast("string").alias("source_file"), "n_chunks", F.lit(None).cast("timestamp").alias("built_at"))


@query("select distinct conv_id::varchar as doc_id from conversations where not (conv_id % 2 = 0 and conv_id % 6 <> 0)")
def ledger_pending(spark, sf_dir):
    digests, recorded = _digests(spark, sf_dir)
    return ledger.pending(digests, recorded).select("doc_id")


@query("select distinct conv_id::varchar as doc_id, conv_id % 6 <> 0 as up_to_date from conversations where conv_id % 2 = 0 and conv_id % 4 <> 0")
def ledger_stale(spark, sf_dir):
    digests, recorded = _digests(spark, sf_dir)
    stored = digests.where("cast(doc_id as long) % 4 = 0")
    return ledger.stale(recorded, stored).select("doc_id", (F.col("digest") != "old").alias("up_to_date"))


@query("""
select conv_id::varchar as filename, turn::varchar as chunk_key, case when conv_id % 3 <> 1 and turn % 2 = 0 then 'done' when turn % 4 < 3 then 'extract' else 'skip' end as todo from conversations
""")
def resume_split(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("filename"), F.lit(1).alias("document_version"), F.col("turn").cast("string").alias("chunk_key"), (F.col("turn") % 4 < 3).alias("eligible"))
    digest = lambda c: F.when(c.cast("long") % 3 == 0, "").when(c.cast("long") % 3 == 1, "changed").otherwise("same")
    progress = rows.where("cast(chunk_key as long) % 2 = 0").select("filename", "document_version", digest(F.col("filename")).alias("digest"), "chunk_key", F.lit(None).cast("timestamp").alias("done_at"))
    digests = rows.select("filename", "document_version", F.lit("same").alias("digest")).distinct()
    return ledger.split_chunks(rows, progress, digests).select("filename", "chunk_key", "todo")


YEARS = ["2021-08", "August 1999", "中華民國一一零年八月", "民國110年8月", "民國 99 年", "民國1零9年", "in 1850", "12019 and 2005", "", "no year", "2101-2099", "民國二年"]


@query("""
with t as (select unnest(range(12)) as i), y as (select i, ['2021-08', 'August 1999', '中華民國一一零年八月', '民國110年8月', '民國 99 年', '民國1零9年', 'in 1850', '12019 and 2005', '', 'no year', '2101-2099', '民國二年'][i + 1] as raw,
  [2021, 1999, 2021, 2021, 2010, null, null, 2005, null, null, 2099, 1913][i + 1] as year from t)
select doc_id, raw, year from documents join y on doc_id % 12 = i
""")
def year_parse(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, YEARS)), (F.col("doc_id") % 12 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"), tx.parse_year(raw).alias("year"))


@query("""
with m as (select o_orderkey, case o_orderkey % 4 when 0 then 'team-sync-' || strftime(o_orderdate, '%Y%m%d') || '-101500utc-x' when 1 then 'oral-june-25-20260625-125907-' || o_orderkey when 2 then 'a-20261399-111111' else 'plain' end as meeting_id from orders)
select o_orderkey, case when meeting_id[1:1] = 't' and substr(meeting_id, 11, 2) = '20' then substr(meeting_id, 11, 4) || '-' || substr(meeting_id, 15, 2) || '-' || substr(meeting_id, 17, 2) when meeting_id[1:1] = 'o' then '2026-06-25' end as date,
  case when meeting_id[1:1] = 't' and substr(meeting_id, 11, 2) = '20' then 'team-sync' when meeting_id[1:1] = 'o' then 'oral-june-25' end as series from m
""")
def meeting_id_parse(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    ident = (
        F.when(k == 0, F.concat(F.lit("team-sync-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-101500utc-x"))).when(k == 1, F.concat(F.lit("oral-june-25-20260625-125907-"), "o_orderkey"))
        .when(k == 2, "a-20261399-111111").otherwise("plain")
    )
    parts = tx.meeting_id_parts(ident)
    return table(spark, sf_dir, "orders").select("o_orderkey", parts["date"].alias("date"), parts["series"].alias("series"))


@query(r"""
select page_id, length(trim(regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->|<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')))::bigint as n_chars from pages
where length(trim(regexp_replace(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->|<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) >= 15
""")
def strip_markup(spark, sf_dir):
    from strataloom.operators.metrics import stripped_chunks

    return stripped_chunks(table(spark, sf_dir, "pages").withColumnRenamed("html", "text")).select("page_id", F.length("text").cast("long").alias("n_chars"))


@query("""
select event_id, case when event_id % 5 = 0 then 'meeting' when event_id % 5 = 1 then 'paper' when event_id % 5 = 2 then 'meeting' when event_id % 5 = 3 then 'paper' else 'paper' end as doc_type,
  ['row', 'path', 'path', 'kind', 'default'][event_id % 5 + 1] as reason, event_id || '.jsonl' as file_name from events
""")
def doc_type_resolution(spark, sf_dir):
    k = F.col("event_id") % 5
    path = F.concat(F.when(k == 1, "papers/").when(k == 2, "meeting/").otherwise("inbox/"), "event_id", F.lit(".jsonl"))
    kinds = F.when(k == 3, F.array(F.lit(""), F.lit("Journal PDF"))).otherwise(F.array(F.lit("unheard of")))
    got = ch.resolve_doc_type(F.when(k == 0, " Meeting "), path, kinds)
    return table(spark, sf_dir, "events").select("event_id", got["doc_type"].alias("doc_type"), got["reason"].alias("reason"), ch.safe_file_name(path).alias("file_name"))


def _uploads(spark, sf_dir):
    """Events as manifest rows."""
    k = F.col("event_id")
    none = F.lit(None)
    return table(spark, sf_dir, "events").select(
        k.alias("id"), F.when(k % 2 == 0, "paper").otherwise("meeting").alias("doc_type"), F.col("user_id").cast("string").alias("doc_id"), none.cast("string").alias("owner"), F.concat(F.lit("inbox/"), k).alias("storage_path"),
        F.sha2(k.cast("string").cast("binary"), 256).alias("sha256"), (k % 9).alias("n_chunks"), F.when(k % 3 == 0, "pending").when(k % 3 == 1, "downloaded").otherwise("failed").alias("status"), none.cast("string").alias("error"),
        F.col("ts").alias("uploaded_at"), none.cast("timestamp").alias("downloaded_at"), none.cast("timestamp").alias("built_at"),
    )


@query("""
with u as (select event_id as id, case when event_id % 2 = 0 then 'paper' else 'meeting' end as doc_type, ts as uploaded_at from events where event_id % 3 = 0),
r as (select *, row_number() over (partition by doc_type order by uploaded_at, id) as nth from u)
select id, doc_type from r where nth <= 25 order by uploaded_at, id limit 25
""")
def uploads_pending(spark, sf_dir):
    return ledger.uploads_pending(_uploads(spark, sf_dir), 25).select("id", "doc_type")


@query("""
select event_id as id, case when event_id % 3 = 0 and event_id % 4 = 0 then 'downloaded' when event_id % 3 = 0 and event_id % 4 = 1 then 'failed' when event_id % 3 = 1 and event_id % 4 = 2 then 'built'
  when event_id % 3 = 0 then 'pending' when event_id % 3 = 1 then 'downloaded' else 'failed' end as status, (event_id % 3 = 0 and event_id % 4 = 0) as stamped_download, (event_id % 3 = 1 and event_id % 4 = 2) as stamped_built,
  case when event_id % 3 = 0 and event_id % 4 = 1 then 4000 end as error_chars from events
""")
def uploads_transition(spark, sf_dir):
    up = _uploads(spark, sf_dir)
    k = F.col("id") % 4
    outcomes = up.where(k < 3).select("id", F.when(k == 0, "downloaded").when(k == 1, "failed").otherwise("built").alias("status"), F.when(k == 1, F.repeat(F.lit("x"), 5000)).alias("error"))
    out = ledger.transition(up, outcomes, F.lit("2024-01-01").cast("timestamp"))
    return out.select("id", "status", F.col("downloaded_at").isNotNull().alias("stamped_download"), F.col("built_at").isNotNull().alias("stamped_built"), F.length("error").alias("error_chars"))


@query("""
with o as (select event_id % 50 as k, event_id from events), n as (select distinct user_id::varchar as doc_id, event_type as sha256 from events where event_id % 2 = 1)
select doc_id, sha256 from n where (doc_id, sha256) not in (select distinct user_id::varchar, event_type from events where event_id % 2 = 0)
""")
def uploads_dedup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.lit("paper").alias("doc_type"), F.col("user_id").cast("string").alias("doc_id"), F.col("event_type").alias("sha256"))
    return ledger.new_uploads(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")).select("doc_id", "sha256")


@query("select event_id as id, case when event_id % 3 = 0 then case when event_id % 7 = 0 then 'failed' else 'downloaded' end when event_id % 3 = 1 then 'downloaded' else 'failed' end as status from events")
def stream_drain(spark, sf_dir):
    """Manifest rows arrive as files; the stream's only task is to wake the drain, which handles all pending rows."""
    at = scratch_path(spark, "drain")
    uploads = SnapshotTable(spark, f"{at}/uploads", ledger.UPLOADS)
    uploads.publish(_uploads(spark, sf_dir))
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    events.write.parquet(f"{at}/events")
    outcomes = lambda todo: todo.select("id", F.when(F.col("id") % 7 == 0, "failed").otherwise("downloaded").alias("status"), F.when(F.col("id") % 7 == 0, "digest mismatch").alias("error"))
    now = F.lit("2024-01-01").cast("timestamp")
    handoff.listen(spark, f"{at}/events", "event_id long, ts timestamp", lambda: handoff.drain(uploads, outcomes, now), f"{at}/checkpoint").awaitTermination()
    return uploads.read().select("id", "status")


@query("select user_id::varchar as doc_id, event_type as sha256, count(*) > 0 as seen from events group by all")
def stream_dedup(spark, sf_dir):
    at = scratch_path(spark, "dedup")
    # the delay covers the whole table, so that no row is late in whatever order files are read
    table(spark, sf_dir, "events").select("ts", F.col("user_id").cast("string").alias("doc_id"), F.col("event_type").alias("sha256")).write.parquet(f"{at}/in")
    stream = spark.readStream.schema("ts timestamp, doc_id string, sha256 string").parquet(f"{at}/in")
    kept = handoff.distinct_uploads(stream, "ts", "20000 days")
    kept.writeStream.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).format("parquet").option("path", f"{at}/out").outputMode("append").start().awaitTermination()
    return spark.read.schema("ts timestamp, doc_id string, sha256 string").parquet(f"{at}/out").select("doc_id", "sha256", F.lit(True).alias("seen"))
