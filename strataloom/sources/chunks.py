"""Chunk records: JSON lines, meeting payloads, and the producer's and benchmark's shapes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom import ontology as o
from strataloom.functions import text as tx

KNOWN = (
    "text", "doc_id", "chunk_id", "index", "n_chunks", "source_path", "source_file", "source_kind", "source_type", "date", "series", "page",
    "section", "content_role", "quality_notes", "extraction_eligible",
)
RECORD = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType()), T.StructField("chunk_id", T.StringType()),
    T.StructField("index", T.LongType()), T.StructField("n_chunks", T.LongType()), T.StructField("source_path", T.StringType()),
    T.StructField("source_file", T.StringType()), T.StructField("source_kind", T.StringType()), T.StructField("source_type", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("series", T.StringType()), T.StructField("page", T.LongType()),
    T.StructField("section", T.StringType()), T.StructField("content_role", T.StringType()), T.StructField("quality_notes", T.ArrayType(T.StringType())),
    T.StructField("extraction_eligible", T.BooleanType()),
])
PAYLOAD = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("meeting_id", T.StringType()), T.StructField("input", T.StringType()), T.StructField("conversation_chunks", T.LongType())])),
    T.StructField("chunks", T.ArrayType(T.StructType([
        T.StructField("chunk_id", T.StringType()), T.StructField("meeting_id", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("source_uri", T.StringType()), T.StructField("speaker_ids", T.ArrayType(T.StringType())), T.StructField("start_ms", T.LongType()),
        T.StructField("end_ms", T.LongType()), T.StructField("source_utterance_ids", T.ArrayType(T.StringType())), T.StructField("text_language", T.StringType()),
    ]))),
])


def read_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """(file, line_no, line) of one file or of all matching files below a folder; blank lines are skipped but numbered.

    Files are read whole, one to a row, so that line numbers are exact; chunk files are small by contract.
    """
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    rows = whole.select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("at", "line"))
    return rows.where(tx.strip(F.col("line")) != "").select("file", (F.col("at") + 1).alias("line_no"), "line")


def lines_of(spark: SparkSession, data: bytes, name: str = "memory") -> DataFrame:
    """The same rows from bytes in memory."""
    rows = [(name, i + 1, x) for i, x in enumerate(data.decode("utf-8").split("\n")) if x.strip()]
    return spark.createDataFrame(rows, "file string, line_no int, line string")


def parse(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Lines with a struct ``r`` of the record (aliases resolved) and ``ok``; ``strict`` fails on the first bad line."""
    found = lines.withColumn("r", F.from_json("line", T.StructType([*RECORD.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad", "mode": "FAILFAST" if strict else "PERMISSIVE"}))
    ok = F.col("line").rlike(r"^\s*\{") & F.col("r").isNotNull() & F.col("r._bad").isNull()
    r = lambda n: F.col(f"r.{n}")
    clean = F.struct(
        *(r(f.name).alias(f.name) for f in RECORD.fields if f.name not in ("source_path", "source_file", "source_kind", "source_type", "quality_notes", "extraction_eligible")),
        F.coalesce(r("source_path"), r("source_file")).alias("source_path"), F.coalesce(r("source_kind"), r("source_type")).alias("source_kind"),
        F.coalesce(r("quality_notes"), F.array().cast("array<string>")).alias("quality_notes"), F.coalesce(r("extraction_eligible"), F.lit(True)).alias("extraction_eligible"),
    )
    return found.withColumn("ok", ok).withColumn("r", clean)


def stem(path: Column) -> Column:
    """File name without its last extension (a leading dot is no extension)."""
    name = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def effective_doc_id(doc_id: Column, source_path: Column) -> Column:
    empty = F.lit("")
    return F.coalesce(F.nullif(doc_id, empty), F.nullif(stem(F.nullif(source_path, empty)), empty), F.lit("unknown"))


def effective_chunk_id(index: Column, chunk_id: Column) -> Column:
    return F.coalesce(index.cast("string"), chunk_id)


def effective_eligible(flag: Column, notes: Column, role: Column, text: Column) -> Column:
    """A false flag is overruled by notes that are all cosmetic, or by prose in what is flagged as a table."""
    cosmetic = F.size(F.array_except(notes, F.array(*map(F.lit, o.COSMETIC_NOTES)))) == 0
    prose = (F.coalesce(role, F.lit("")) == "table_artifact") & F.coalesce(tx.has_reporting_verb(text), F.lit(False))
    return F.when(flag, True).when(F.size(notes) > 0, cosmetic).otherwise(prose)


def doc_type_of(path: Column) -> Column:
    """The name of the file's folder, null if it has none."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.nullif(F.element_at(parts, -2), F.lit("")))


def unknown_fields(line: Column) -> Column:
    return F.array_sort(F.array_except(F.json_object_keys(line), F.array(*map(F.lit, KNOWN))))


def chunks(parsed: DataFrame) -> DataFrame:
    """One row per record: file, doc_id, line_no, chunk_pos, chunk_key, text (cleaned), eligible, and document fields."""
    r = lambda n: F.col(f"r.{n}")
    return parsed.where("ok").select(
        "file", effective_doc_id(r("doc_id"), r("source_path")).alias("doc_id"), "line_no", r("index").alias("chunk_pos"),
        effective_chunk_id(r("index"), r("chunk_id")).alias("chunk_key"), tx.clean_text(r("text")).alias("text"),
        effective_eligible(r("extraction_eligible"), r("quality_notes"), r("content_role"), r("text")).alias("eligible"),
        r("extraction_eligible").alias("raw_eligible"), r("source_path").alias("source_path"), r("source_kind").alias("source_kind"),
        r("n_chunks").alias("n_chunks"), r("date").alias("date"), r("series").alias("series"), doc_type_of(F.col("file")).alias("doc_type"),
        unknown_fields(F.col("line")).alias("unknown_fields"),
    )


def documents(rows: DataFrame, version: int = 1) -> DataFrame:
    """One row per (file, doc_id); the fields are those of its first record."""
    first = lambda c: F.min_by(c, "line_no").alias(c)
    out = rows.groupBy("file", F.col("doc_id").alias("filename")).agg(*map(first, ("source_path", "source_kind", "n_chunks", "date", "series", "doc_type")), F.count(F.lit(1)).alias("n_records"))
    return out.withColumn("document_version", F.lit(version)).withColumn("source", F.coalesce("source_path", "filename"))


def looks_like_payload(line: Column) -> Column:
    return F.coalesce(F.get_json_object(line, "$.chunks").rlike(r"^\s*\["), F.lit(False))


def from_payload(payloads: DataFrame, min_chars: int = o.SPEECH_CHARS) -> DataFrame:
    """Chunk records of meeting payloads (columns metadata and chunks), one row per chunk, with the producer's fields.

    The document is the chunk's meeting id, else the payload's; a chunk with neither is an error. Short speech is kept
    but not eligible.
    """
    rows = payloads.select("metadata", F.size("chunks").cast("long").alias("n_chunks"), F.posexplode("chunks").alias("index", "c"))
    empty = F.lit("")
    doc = F.coalesce(F.nullif(F.col("c.meeting_id"), empty), F.nullif(F.col("metadata.meeting_id"), empty))
    doc = F.coalesce(doc, F.raise_error(F.lit("a meeting payload has no meeting_id")))
    when = tx.meeting_id_parts(doc)
    return rows.select(
        F.col("c.text").alias("text"), doc.alias("doc_id"), F.col("c.chunk_id").alias("chunk_id"), F.col("index").cast("long").alias("index"), "n_chunks",
        F.coalesce(F.col("c.source_uri"), F.col("metadata.input")).alias("source_path"), F.lit("transcript").alias("source_kind"),
        when["date"].alias("date"), when["series"].alias("series"), (tx.speech_length(F.col("c.text")) >= min_chars).alias("extraction_eligible"),
        *(F.col(f"c.{n}").alias(n) for n in ("speaker_ids", "start_ms", "end_ms", "source_utterance_ids", "text_language")),
    )


def read_payloads(spark: SparkSession, path: str, pattern: str = "*.chunks.json") -> DataFrame:
    return spark.read.schema(PAYLOAD).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(path)


def write_lines(records: DataFrame, path: str) -> None:
    """Records as JSON lines; text outside ASCII is kept as it is."""
    records.select(F.to_json(F.struct(*records.columns)).alias("value")).write.text(path)


def infer_doc_type(kinds: Column) -> Column:
    """meeting or paper by the first kind (of an array, in order) that holds a marker; null if none does."""
    word = lambda k: F.lower(tx.strip(F.coalesce(k.cast("string"), F.lit(""))))
    kind = lambda k: F.when(word(k).rlike("|".join(o.MEETING_KINDS)), "meeting").when(word(k).rlike("|".join(o.PAPER_KINDS)), "paper")
    return F.get(F.filter(F.transform(kinds, kind), lambda k: k.isNotNull()), F.lit(0))


def resolve_doc_type(explicit: Column, storage_path: Column, kinds: Column, default: str = "paper") -> Column:
    """struct(doc_type, reason): given, else by the path's first folder (a plural s dropped), else by kind, else the default."""
    given = F.nullif(F.lower(tx.strip(explicit)), F.lit(""))
    parts = F.split(storage_path, "/")
    folder = F.when(F.size(parts) > 1, F.regexp_replace(F.lower(parts[0]), "s$", ""))
    by_path = F.when(folder.isin("paper", "meeting"), folder)
    by_kind = infer_doc_type(kinds)
    reason = F.when(given.isNotNull(), "row").when(by_path.isNotNull(), "path").when(by_kind.isNotNull(), "kind").otherwise("default")
    return F.struct(F.coalesce(given, by_path, by_kind, F.lit(default)).alias("doc_type"), reason.alias("reason"))


def safe_file_name(path: Column) -> Column:
    """The base name; an absolute path, one with '..' or one without a name is an error."""
    bad = path.isNull() | path.rlike(r"^/|(^|/)\.\.(/|$)|^$|^\.$")
    return F.when(bad, F.raise_error(F.concat(F.lit("unsafe storage_path: "), F.coalesce(path, F.lit("null"))))).otherwise(F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1))


def source_format(kind: Column, filename: Column) -> Column:
    ext = F.regexp_extract(filename, r"\.([^./]+)$", 1)
    return F.coalesce(F.nullif(kind, F.lit("")), F.nullif(F.lower(ext), F.lit("")), F.lit("unknown"))


def expected_domain(kind: Column) -> Column:
    k = F.lower(tx.strip(kind))
    return F.when(k == "pdf", "paper").when(k == "transcript", "meeting")
