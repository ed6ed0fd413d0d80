"""The hand-off of uploads: one drain function, run as a batch poll or woken by a stream of manifest rows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.operators import ledger
from strataloom.operators.validate import file_summary, validate
from strataloom.session import materialize
from strataloom.sources import chunks as ch
from strataloom.sources.tables import SnapshotTable

SWEEP_SECONDS, FIRST_WAIT, LONGEST_WAIT = 900, 1.0, 60.0


def check_files(spark: SparkSession, todo: DataFrame, folder: str, out: str | None = None) -> DataFrame:
    """(id, status, error) of pending uploads: the stored bytes must match their digest and validate.

    Bytes are read by Spark, a file to a row; meeting payloads are turned into records first. With ``out``, the records of
    each upload that passes are written below it as lines, in a folder of the document's name, which appears whole or not
    at all: a later upload of the same document takes its place.
    """
    named = todo.withColumn("name", ch.safe_file_name(F.col("storage_path")))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    got = named.join(files, "name", "left").withColumn("digest_ok", F.coalesce(F.sha2("content", 256) == F.lower("sha256"), F.lit(False)))
    text = got.where("digest_ok").withColumn("body", F.col("content").cast("string"))
    payload = text.where(ch.looks_like_payload(F.col("body")))
    whole = payload.select("id", F.from_json("body", ch.PAYLOAD).alias("p"))
    as_lines = whole.select(F.col("id").cast("string").alias("file"), F.size("p.chunks").alias("n"), F.posexplode("p.chunks").alias("at", "c"), F.col("p.metadata.meeting_id").alias("m"))
    record = F.struct(F.col("c.text").alias("text"), F.coalesce("c.meeting_id", "m").alias("doc_id"), F.col("at").alias("index"), F.col("n").alias("n_chunks"), F.lit("transcript").alias("source_kind"))
    from_payload = as_lines.select("file", (F.col("at") + 1).alias("line_no"), F.to_json(record).alias("line"))
    plain = text.where(~ch.looks_like_payload(F.col("body"))).select(F.col("id").cast("string").alias("file"), F.posexplode(F.split("body", "\r?\n")).alias("at", "line")).where(F.trim("line") != "").select("file", (F.col("at") + 1).alias("line_no"), "line")
    lines = plain.unionByName(from_payload)
    parsed = ch.parse(lines)
    summary = file_summary(parsed, validate(parsed)).select(F.col("file").cast("long").alias("id"), "ok", "errors")
    rows = got.join(summary, "id", "left")
    error = (
        F.when(F.col("content").isNull(), "no such object").when(~F.col("digest_ok"), "digest mismatch").when(F.col("ok").isNull(), "no records").when(~F.col("ok"), F.concat(F.lit("invalid: "), F.col("errors"), F.lit(" errors")))
    )
    outcomes = rows.select("id", F.when(error.isNull(), "downloaded").otherwise("failed").alias("status"), error.alias("error"))
    if out is None:
        return outcomes
    outcomes = materialize(outcomes, "hand-off")
    good = outcomes.where("status = 'downloaded'").join(todo.select("id", "doc_id", "uploaded_at"), "id")
    latest = good.groupBy("doc_id").agg(F.max_by("id", F.struct("uploaded_at", "id")).alias("id")).select(F.col("id").cast("string").alias("file"), "doc_id")
    write_folders(spark, lines.join(latest, "file").select(F.col("doc_id").alias("folder"), "line_no", "line"), out)
    return outcomes


def write_folders(spark: SparkSession, lines: DataFrame, out: str) -> None:
    """Lines (folder, line_no, line) in folders below ``out``, each moved there once it is whole, in place of an older one."""
    temp = f"{out.rstrip('/')}/_unfinished-{uuid.uuid4().hex[:12]}"
    ready = lines.withColumn("folder", F.regexp_replace("folder", r"[^\w.-]", "_"))
    ready.repartition("folder").sortWithinPartitions("folder", "line_no").select("folder", F.col("line").alias("value")).write.partitionBy("folder").text(temp)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(temp).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in store.listStatus(path(temp)) if store.exists(path(temp)) else ():
        if status.isDirectory():
            to = path(f"{out.rstrip('/')}/{status.getPath().getName().split('=', 1)[1]}")
            store.delete(to, True)
            store.rename(status.getPath(), to)
    store.delete(path(temp), True)


def drain(table: SnapshotTable, outcomes: Callable[[DataFrame], DataFrame], now: Column, limit: int | None = None) -> int:
    """Handle all pending uploads; returns how many. Running it again handles none.

    They are taken all at once or, with ``limit``, so many at a time, oldest first; each turn rewrites the table. It ends when
    none is left or a turn moves none.
    """
    done = 0
    while True:
        uploads = table.read()
        todo = ledger.uploads_pending(uploads, limit)
        n = todo.count()
        if not n:
            return done
        before = ledger.uploads_pending(uploads).count() if limit else n
        table.publish(ledger.transition(uploads, outcomes(todo), now))
        done += n
        if ledger.uploads_pending(table.read()).count() >= before:  # nothing moved
            return done


def listen(spark: SparkSession, events: str, schema: str, handle: Callable[[], object], checkpoint: str, once: bool = True, seconds: float = SWEEP_SECONDS, wake: float = 1.0):
    """Start a query that calls ``handle`` for each micro-batch of new manifest files; what the events say is ignored.

    ``once`` reads what is there and ends. Otherwise new files wake it within ``wake`` seconds, and without any it sweeps
    every ``seconds``, since an event may be lost: a clock's rows keep the micro-batches coming.
    """
    stream = spark.readStream.schema(schema).parquet(events).select(F.lit(True).alias("event"))
    if once:
        return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda rows, epoch: handle()).trigger(availableNow=True).start()
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.lit(False).alias("event"))
    swept = [time.monotonic()]

    def batch(rows: DataFrame, epoch: int) -> None:
        if not rows.where("event").isEmpty() or time.monotonic() - swept[0] >= seconds:
            handle()
            swept[0] = time.monotonic()

    return stream.union(clock).writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(processingTime=f"{wake} seconds").start()


def distinct_uploads(stream: DataFrame, time_column: str, delay: str = "1 hour") -> DataFrame:
    """Events without repeats of (doc_id, sha256) within the watermark, so that the state stays bounded."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["doc_id", "sha256"])


def supervise(run: Callable[[], object], stop: Callable[[], bool], sleep: Callable[[float], None] = time.sleep, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT) -> None:
    """Run again and again until ``stop``; after a failure wait, twice as long each time, and from the start after a success."""
    wait = first
    while not stop():
        try:
            run()
            wait = first
        except Exception:  # whatever ended the query, it is started again
            sleep(wait)
            wait = min(2 * wait, longest)


def offer(files: DataFrame, uploads: DataFrame, prefix: str, doc_type: str) -> DataFrame:
    """Manifest rows for a producer's files (path, content, doc_id, n_chunks, ok) that aren't known yet.

    One invalid file stops them all: the result is then an error.
    """
    bad = files.where("not coalesce(ok, false)").count()
    if bad:
        raise ValueError(f"{bad} files are invalid; nothing is offered")
    sha = F.sha2("content", 256)
    rows = files.select(
        F.lit(doc_type).alias("doc_type"), "doc_id", sha.alias("sha256"), F.concat(F.lit(prefix.rstrip("/") + "/"), "doc_id", F.lit("__"), F.left(sha, F.lit(8)), F.lit(".jsonl")).alias("storage_path"), "n_chunks",
        F.lit("pending").alias("status"),
    )
    return ledger.new_uploads(uploads, rows)
