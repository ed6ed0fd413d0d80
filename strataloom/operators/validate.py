"""Validation of chunk files: rules per line and per document, as rows (file, line_no, doc_id, level, code, msg)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom import ontology as o
from strataloom.functions import text as tx
from strataloom.sources import chunks as ch


def _issues(rows: DataFrame, level: str, code: str, msg, doc=None, line=None) -> DataFrame:
    return rows.select(
        "file", (F.col("line_no") if line is None else F.lit(None)).cast("long").alias("line_no"), (F.lit(None) if doc is None else F.col(doc)).cast("string").alias("doc_id"),
        F.lit(level).alias("level"), F.lit(code).alias("code"), msg.cast("string").alias("msg"),
    )


def line_issues(parsed: DataFrame) -> DataFrame:
    """Errors of single lines; ``parsed`` comes from sources.chunks.parse."""
    bad = _issues(parsed.where("not ok"), "error", "invalid_json", F.substring("line", 1, 80))
    ok = parsed.where("ok").withColumn("doc", ch.effective_doc_id(F.col("r.doc_id"), F.col("r.source_path")))
    ok = ok.withColumn("key", ch.effective_chunk_id(F.col("r.index"), F.col("r.chunk_id")))
    schema = _issues(ok.where("r.text is null"), "error", "schema", F.lit("text is missing"), "doc")
    no_id = _issues(ok.where("doc = 'unknown'"), "error", "no_doc_id", F.lit("neither doc_id nor source_path"), "doc")
    nth = F.row_number().over(Window.partitionBy("file", "doc", "key").orderBy("line_no"))
    twice = _issues(ok.where("key is not null and r.text is not null").withColumn("nth", nth).where("nth > 1"), "error", "duplicate_chunk", F.col("key"), "doc")
    blank = _issues(ok.where(tx.strip(F.col("r.text")) == ""), "warning", "empty_text", F.lit("text is empty"), "doc")
    extra = ch.unknown_fields(F.col("line"))
    fields = _issues(ok.where(F.size(extra) > 0), "warning", "unknown_fields", F.array_join(extra, ","), "doc")
    out = bad
    for part in (schema, no_id, twice, blank, fields):
        out = out.unionByName(part)
    return out


def index_stats(records: DataFrame, keys: list[str]) -> DataFrame:
    """Per document: counts and the warnings' ingredients. Needs index, n_chunks, source_kind, line_no, raw_eligible, text."""
    ordered = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("line_no"))).alias(f"first_{c}")
    stats = records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_records"), F.count("index").alias("n_indexed"), F.min("index").alias("low"), F.max("index").alias("high"),
        F.collect_set("index").alias("indices"), ordered("n_chunks"), ordered("source_kind"),
        F.count_if(F.length("text") < o.SHORT_TEXT).alias("n_short"), F.count_if(~F.col("raw_eligible")).alias("n_ineligible"),
    )
    gaps = F.when(F.col("low").isNotNull(), F.array_sort(F.array_except(F.sequence("low", "high"), F.col("indices"))))
    return stats.withColumn("gaps", F.coalesce(gaps, F.array().cast("array<bigint>"))).drop("indices")


def document_issues(stats: DataFrame, doc: str = "doc_id") -> DataFrame:
    n = F.col("n_records") - F.col("n_indexed")
    rules = [
        ("missing_index", n > 0, F.concat(n, F.lit(" of "), F.col("n_records"))),
        ("index_gaps", F.size("gaps") > 0, F.array_join(F.transform("gaps", lambda x: x.cast("string")), ",")),
        ("index_start", F.col("low") != 0, F.col("low").cast("string")),
        ("n_chunks", F.col("first_n_chunks") != F.col("n_records"), F.concat(F.col("first_n_chunks"), F.lit(" declared, "), F.col("n_records"), F.lit(" found"))),
        ("no_source_kind", F.col("first_source_kind").isNull(), F.lit("no source_kind")),
    ]
    found = F.filter(F.array(*(F.when(hit, F.struct(F.lit(code).alias("code"), msg.alias("msg"))) for code, hit, msg in rules)), lambda x: x.isNotNull())
    return stats.select("file", F.lit(None).cast("long").alias("line_no"), F.col(doc).alias("doc_id"), F.lit("warning").alias("level"), F.explode(found).alias("x")).select("file", "line_no", "doc_id", "level", "x.code", "x.msg")


def validate(parsed: DataFrame) -> DataFrame:
    """All issues of all files."""
    records = parsed.where("ok and r.text is not null").select(
        "file", ch.effective_doc_id(F.col("r.doc_id"), F.col("r.source_path")).alias("doc_id"), "line_no", F.col("r.index").alias("index"),
        F.col("r.n_chunks").alias("n_chunks"), F.col("r.source_kind").alias("source_kind"), F.col("r.text").alias("text"), F.col("r.extraction_eligible").alias("raw_eligible"),
    )
    return line_issues(parsed).unionByName(document_issues(index_stats(records, ["file", "doc_id"])))


def file_summary(parsed: DataFrame, issues: DataFrame) -> DataFrame:
    """file, errors, warnings, ok and state (clean, warned, failed)."""
    counts = issues.groupBy("file").agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"))
    out = parsed.select("file").distinct().join(counts, "file", "left").na.fill(0, ["errors", "warnings"])
    return out.withColumn("ok", F.col("errors") == 0).withColumn("state", F.when(F.col("errors") > 0, "failed").when(F.col("warnings") > 0, "warned").otherwise("clean"))


def exit_code(summary: DataFrame) -> int:
    """0 clean or warned, 1 if any file failed, 2 if there are no files."""
    n, failed = summary.agg(F.count(F.lit(1)), F.count_if(~F.col("ok"))).first()
    return 2 if not n else int(failed > 0)
