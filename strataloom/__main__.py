"""Command line: python -m strataloom COMMAND ...; --help lists the commands."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def session() -> SparkSession:
    return SparkSession.builder.appName("strataloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def validate(args) -> int:
    """Report issues of chunk files; exit 1 if a file failed, 2 if there is none."""
    from strataloom.operators import validate as v
    from strataloom.sources import chunks as ch

    parsed = ch.parse(ch.read_lines(session(), args.path))
    issues = v.validate(parsed)
    summary = v.file_summary(parsed, issues)
    for r in summary.orderBy("file").limit(args.files).collect():
        print(f"{r.state:7} {r.file}: {r.errors} errors, {r.warnings} warnings")
    for r in issues.orderBy("file", "level", "line_no", "code").limit(args.issues).collect():
        print(f"  {r.level} {r.code} {r.file}:{r.line_no or '-'} {r.doc_id or ''} {r.msg}")
    return v.exit_code(summary)


def convert(args) -> int:
    """Turn meeting payloads into chunk files, unless they don't validate."""
    from strataloom.operators import validate as v
    from strataloom.sources import chunks as ch

    spark = session()
    records = ch.from_payload(ch.read_payloads(spark, args.path, args.pattern), args.min_chars)
    lines = records.select(F.col("doc_id").alias("file"), (F.col("index") + 1).alias("line_no"), F.to_json(F.struct(*records.columns)).alias("line"))
    parsed = ch.parse(lines)
    errors = v.validate(parsed).where("level = 'error'").count()
    if not errors and not args.dry_run:
        ch.write_lines(records, args.out)
    print(f"{records.count()} records, {errors} errors")
    return int(errors > 0)


def metrics(args) -> int:
    """Length statistics of chunk files by document."""
    from strataloom.operators.metrics import chunk_metrics
    from strataloom.sources import chunks as ch

    chunk_metrics(ch.chunks(ch.parse(ch.read_lines(session(), args.path))), ["doc_id"]).orderBy("doc_id").show(args.files, truncate=False)
    return 0


def hand_off(args) -> int:
    """Handle pending uploads once, or whenever manifest files arrive."""
    from strataloom.operators.ledger import UPLOADS
    from strataloom.sources.tables import SnapshotTable
    from strataloom.streaming import handoff

    spark = session()
    table = SnapshotTable(spark, args.table, UPLOADS)
    drain = lambda: handoff.drain(table, lambda todo: handoff.check_files(spark, todo, args.store), F.current_timestamp(), args.limit)
    if args.command == "drain":
        print(f"{drain()} handled")
    else:
        drain()
        run = lambda: handoff.listen(spark, args.events, UPLOADS, drain, args.checkpoint, once=False, seconds=args.seconds).awaitTermination()
        handoff.supervise(run, lambda: False)
    return 0


def _settings() -> dict[str, str]:
    """Settings of the model clients: STRATALOOM_LLM_PROVIDER and the like, by their names in lower case."""
    import os

    return {k.removeprefix("STRATALOOM_").lower(): v for k, v in os.environ.items() if k.startswith("STRATALOOM_")}


def _completer(purpose: str):
    from strataloom import models

    client = models.completer(_settings(), purpose)
    if client is None:
        raise SystemExit(f"no model is set for {purpose}: STRATALOOM_PROVIDER and STRATALOOM_MODEL, or with {purpose.upper()}_ before them")
    return client


def _store(spark, folder: str, name: str, schema: str):
    from strataloom.sources.tables import SnapshotTable

    return SnapshotTable(spark, f"{folder.rstrip('/')}/{name}", schema)


def build(args) -> int:
    """Extract and store the graph of chunk files; documents that the ledger holds are left out."""
    from strataloom.operators import build as b
    from strataloom.operators import ledger, reports
    from strataloom.operators import validate as v
    from strataloom.session import materialize
    from strataloom.sources import chunks as ch

    spark, now = session(), F.current_timestamp()
    parsed = ch.parse(ch.read_lines(spark, args.path))
    if v.validate(parsed).where("level = 'error'").count():
        print("invalid chunk files; see the command validate")
        return 1
    rows = materialize(ch.chunks(parsed).withColumn("document_version", F.lit(1)), "chunks")
    digests = ledger.content_digest(rows, ["doc_id", "file"], "chunk_key", "text")
    known = _store(spark, args.store, "ledger", ledger.LEDGER)
    todo = materialize(ledger.pending(digests, known.read(), args.rebuild, args.limit), "pending")
    chunks = rows.join(todo.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("filename"), "document_version", "chunk_pos", "chunk_key", "eligible", "text", F.coalesce("source_path", "doc_id").alias("source"), "source_kind")
    docs = chunks.select(F.col("filename").alias("doc_id"), F.col("source").alias("source_name"), "source_kind").dropDuplicates(["doc_id"])
    marks = todo.select(F.col("doc_id").alias("filename"), F.lit(1).alias("document_version"), "digest")
    raw = b.extract_resumable(chunks, marks, _store(spark, args.store, "raw", b.RAW), _store(spark, args.store, "progress", ledger.PROGRESS), _completer("llm"), now, args.waves, args.rebuild)
    nodes, edges = (materialize(x, "sanitized") for x in b.sanitized(raw.join(docs, "doc_id", "left_semi"), docs))
    stored, links = _store(spark, args.store, "nodes", b.NODES), _store(spark, args.store, "edges", b.EDGES)
    stored.publish(b.store_nodes(stored.read(), nodes, now))
    links.publish(b.store_edges(links.read(), edges))
    built = todo.select("doc_id", "digest", F.lit(None).cast("string").alias("doc_type"), F.col("file").alias("source_file"), "n_chunks", now.alias("built_at"))
    known.publish(ledger.record(known.read(), built))
    reports.skipped_chunks(chunks).orderBy("filename").show(100, truncate=False)
    print(f"{todo.count()} documents, {nodes.count()} nodes, {edges.count()} edges")
    return 0


def _descriptions(spark, args):
    """Stored claims with the vectors that are stored for them."""
    from strataloom.operators import build as b

    found = b.descriptions(_store(spark, args.store, "nodes", b.NODES).read())
    return found.join(_store(spark, args.store, "embeddings", "id string, embedding array<float>").read(), "id", "left")


def embed(args) -> int:
    """Give stored claims that lack one a vector."""
    from strataloom import models
    from strataloom import ontology as o
    from strataloom.config import Settings

    spark = session()
    client = models.embedder(_settings())
    if client is None:
        raise SystemExit("no model is set for embedding")
    done = models.embed_missing(_descriptions(spark, args), client, o.ALLOWED_TYPES, Settings.from_env().embed_with_topic, args.force)
    table = _store(spark, args.store, "embeddings", "id string, embedding array<float>")
    table.publish(done.where("embedding is not null").select("id", "embedding"))
    print(f"{table.read().count()} vectors")
    return 0


def blocking(args) -> int:
    """Find candidate pairs among the stored claims."""
    from strataloom.config import Settings
    from strataloom.operators import blocking as bl
    from strataloom.operators import stages

    spark, s = session(), Settings.from_env()
    stages.run_blocking(_descriptions(spark, args), _store(spark, args.store, "pairs", bl.CANDIDATES), F.current_timestamp(), s.knn, s.similarity_floor).show()
    return 0


def gates(args) -> int:
    """Gate candidate pairs; the model is asked for what no rule rejects."""
    from strataloom.operators import blocking as bl
    from strataloom.operators import stages

    spark = session()
    client = _completer("nli")
    stages.run_gates(_descriptions(spark, args), _store(spark, args.store, "pairs", bl.CANDIDATES), client, args.model, F.current_timestamp(), flush=args.flush, seconds=args.seconds).show()
    return 0


def classify(args) -> int:
    """Judge supersession and clusters of the pairs that passed."""
    from strataloom.operators import blocking as bl
    from strataloom.operators import build as b
    from strataloom.operators import stages

    spark, now = session(), F.current_timestamp()
    client, claims, pairs = _completer("classification"), _descriptions(spark, args), _store(spark, args.store, "pairs", bl.CANDIDATES)
    nodes = _store(spark, args.store, "nodes", b.NODES).read()
    sources = nodes.where("label = 'Source'").select("id", F.col("props")["year"].alias("year"))
    stages.run_supersession(claims, sources, pairs, _store(spark, args.store, "supersedes", stages.SUPERSEDES), client, args.model, seconds=args.seconds)
    tables = [_store(spark, args.store, n, t) for n, t in (("clusters", stages.CLUSTERS), ("contradictions", stages.CONTRADICTIONS), ("claims", stages.CLAIM_EDGES))]
    stages.run_clusters(claims, pairs, *tables, client, args.model, now, seconds=args.seconds).show()
    return 0


def upload(args) -> int:
    """Offer chunk files to the manifest and copy them to the store; one invalid file stops them all."""
    from strataloom.operators import ledger
    from strataloom.operators import validate as v
    from strataloom.sources import chunks as ch
    from strataloom.streaming import handoff

    spark = session()
    parsed = ch.parse(ch.read_lines(spark, args.path))
    about = ch.chunks(parsed).groupBy("file").agg(F.min_by("doc_id", "line_no").alias("doc_id"), F.count(F.lit(1)).alias("n_chunks"))
    ok = v.file_summary(parsed, v.validate(parsed)).select("file", "ok")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(args.path).select(F.col("path").alias("file"), "content")
    name = lambda c: F.regexp_replace(c, "^file:/+", "/")
    rows = files.withColumn("file", name(F.col("file"))).join(about.withColumn("file", name(F.col("file"))), "file", "left").join(ok.withColumn("file", name(F.col("file"))), "file", "left")
    table = _store(spark, args.table.rsplit("/", 1)[0], args.table.rsplit("/", 1)[1], ledger.UPLOADS)
    old = table.read()
    try:
        offered = handoff.offer(rows.withColumnRenamed("file", "path"), old, args.prefix, args.doc_type)
    except ValueError as e:
        print(e)
        return 1
    top = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = offered.withColumns({"id": F.monotonically_increasing_id() + top + 1, "uploaded_at": F.current_timestamp()})
    n = new.count()
    print(f"{n} new files" + (", nothing written" if args.dry_run else ""))
    if n and not args.dry_run:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        at = lambda x: jvm.org.apache.hadoop.fs.Path(x)
        paths = new.select("sha256", "storage_path").join(rows.select(F.sha2("content", 256).alias("sha256"), "file"), "sha256").dropDuplicates(["storage_path"])
        for r in paths.select("file", "storage_path").toLocalIterator():  # a producer's own files, byte for byte
            src, dst = at(r.file), at(f"{args.store.rstrip('/')}/{r.storage_path}")
            jvm.org.apache.hadoop.fs.FileUtil.copy(src.getFileSystem(conf), src, dst.getFileSystem(conf), dst, False, conf)
        table.publish(old.unionByName(new, allowMissingColumns=True))
    return 0


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="strataloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    for name, f in (("validate", validate), ("convert", convert), ("metrics", metrics), ("drain", hand_off), ("listen", hand_off), ("build", build), ("embed", embed), ("blocking", blocking), ("gates", gates), ("classify", classify), ("upload", upload)):
        p = sub.add_parser(name, help=f.__doc__)
        p.set_defaults(run=f)
        if name in ("validate", "convert", "metrics"):
            p.add_argument("path")
            p.add_argument("--files", type=int, default=100)
        if name == "validate":
            p.add_argument("--issues", type=int, default=8)
        if name == "convert":
            p.add_argument("out")
            p.add_argument("--pattern", default="*.chunks.json")
            p.add_argument("--min-chars", type=int, default=70)
            p.add_argument("--dry-run", action="store_true")
        if name in ("drain", "listen"):
            p.add_argument("table")
            p.add_argument("store")
            p.add_argument("--limit", type=int, default=10_000)
        if name == "build":
            p.add_argument("path")
        if name in ("build", "embed", "blocking", "gates", "classify"):
            p.add_argument("store", help="folder of the stored graph and its tables")
        if name == "build":
            p.add_argument("--rebuild", action="store_true")
            p.add_argument("--limit", type=int)
            p.add_argument("--waves", type=int, default=8)
        if name == "embed":
            p.add_argument("--force", action="store_true")
        if name in ("gates", "classify"):
            p.add_argument("--model", default="model", help="the name that cached verdicts are kept under")
            p.add_argument("--seconds", type=float, default=120.0)
        if name == "gates":
            p.add_argument("--flush", type=int, default=25)
        if name == "upload":
            p.add_argument("path")
            p.add_argument("table")
            p.add_argument("store")
            p.add_argument("--prefix", default="inbox")
            p.add_argument("--doc-type", default="paper", choices=("paper", "meeting"))
            p.add_argument("--dry-run", action="store_true")
        if name == "listen":
            p.add_argument("events")
            p.add_argument("checkpoint")
            p.add_argument("--seconds", type=int, default=900)
    args = top.parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
