"""Clients, resumed builds and gates, and the hand-off's files and sweeps."""

import http.server
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from strataloom import models
from strataloom import ontology as o
from strataloom.operators import blocking, build, ledger, stages
from strataloom.session import materialize, release, settle
from strataloom.sources import chunks as ch
from strataloom.sources.tables import SnapshotTable, widen
from strataloom.streaming import handoff


class Slow:
    def __init__(self, raw=None):
        self.raw = raw
        if raw is not None:
            self.complete_raw = lambda prompt: raw

    def complete(self, prompt):
        time.sleep(30)


def test_calls_end_by_the_clock():
    start = time.monotonic()
    with pytest.raises(models.TimedOut):
        models.complete_or_raw(Slow(), "p", 0.2)
    assert models.complete_or_raw(Slow("raw"), "p", 0.2) == "raw"
    assert time.monotonic() - start < 5
    assert models.within(None, lambda: "x") == models.within(9, lambda: "x") == "x"
    with pytest.raises(ZeroDivisionError):
        models.within(9, lambda: 1 / 0)


def test_clients_by_name():
    c = models.completer({"provider": "OpenAI", "model": "m", "key": "k", "url": "http://h/v1/", "llm_model": "n"})
    assert (c.kind, c.url, c.model, c.headers) == ("openai", "http://h/v1", "n", {"Authorization": "Bearer k"})
    assert models.completer({"provider": "ollama", "model": "m"}).url == "http://localhost:11434"
    assert models.completer({"provider": "nobody", "model": "m"}) is None and models.completer({"provider": "openai"}) is None
    assert models.embedder({"provider": "google", "model": "m"}) is None and isinstance(models.embedder({"provider": "trf", "model": "m"}), models.LocalTransformer)
    with pytest.raises(ValueError):
        models.completer({"provider": "azure-openai", "model": "m"})
    assert models.endpoint({"url": "http://a/", "nli_url": "http://b"}, "nli") == "http://b" and models.endpoint({}, "nli") is None


def test_http_client():
    asked = []

    class Service(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, body))
            say = f"said {body.get('prompt') or body.get('input')}"
            reply = {"/api/generate": {"response": say}, "/api/embed": {"embeddings": [[1.0]]}, "/chat/completions": {"choices": [{"message": {"content": "c"}}]}, "/embeddings": {"data": [{"index": 1, "embedding": [2.0]}, {"index": 0, "embedding": [1.0]}]}}
            reply = reply.get(self.path, {"candidates": [{"content": {"parts": [{"text": "g"}]}}]})
            data = json.dumps(reply).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        made = {n: models.completer({"provider": n, "model": "m", "url": url, "key": "k"}) for n in ("ollama", "openai", "azure-openai", "google")}
        assert [made[n].complete("p") for n in made] == ["said p", "c", "c", "g"]
        assert made["ollama"].complete_raw("p") == "said p" and "format" in asked[0][1] and "format" not in asked[-1][1]
        assert made["ollama"].embed(["a"]) == [[1.0]] and made["openai"].embed(["a", "b"]) == [[1.0], [2.0]]
    finally:
        server.shutdown()


def chunk_table(spark):
    rows = [("a.pdf", i, i % 5 != 4, f"part {i}.") for i in range(10)] + [("b.txt", i, True, f"other {i}.") for i in range(4)]
    return spark.createDataFrame([(f, 1, i, str(i), e, t, f, "pdf") for f, i, e, t in rows], "filename string, document_version int, chunk_pos long, chunk_key string, eligible boolean, text string, source string, source_kind string")


def replies(good):
    out = {}
    for i in range(10):
        for word in ("part", "other"):
            graph = {"nodes": [{"id": f"{word} topic {i % 3}", "type": "Topic", "properties": {"n": str(i)}}, {"id": "Method", "type": "Type", "properties": {}}], "relationships": [{"source": f"{word} topic {i % 3}", "target": "Method", "type": "has_type", "properties": {}}]}
            out[f"{word} {i}."] = graph if good(word, i) else "nothing"
    return out


def test_a_resumed_build_gives_what_an_unbroken_one_gives(spark, tmp_path):
    chunks = chunk_table(spark)
    digests = chunks.select("filename", "document_version", F.lit("x").alias("digest")).distinct()
    docs = chunks.select(F.col("filename").alias("doc_id"), F.col("source").alias("source_name"), "source_kind").distinct()
    log, now = tmp_path / "calls", F.lit("2024-01-01").cast("timestamp")

    def run(at, good, **more):
        raw, progress = (SnapshotTable(spark, f"file://{tmp_path}/{at}/{n}", s) for n, s in (("raw", build.RAW), ("progress", ledger.PROGRESS)))
        log.write_text("")
        out = build.extract_resumable(chunks, more.pop("digests", digests), raw, progress, models.ScriptedCompleter(replies(good), log=str(log)), now, waves=3, **more)
        nodes, edges = build.sanitized(out, docs)
        key = lambda df, cols: sorted(str(tuple(r)) for r in df.select(*cols).collect())
        return len(log.read_text()), key(nodes, ["doc_id", "chunk_pos", "id", "label"]) + key(edges, ["doc_id", "chunk_pos", "src", "dst", "type"]), progress.read().count()

    calls, whole, done = run("one", lambda w, i: True)
    assert (calls, done) == (12, 14) and whole
    first = run("two", lambda w, i: i % 2)
    assert first[0] == 12 and first[2] == 2 + 6 and first[1] != whole
    second = run("two", lambda w, i: True)
    assert second == (6, whole, 14)
    assert run("two", lambda w, i: False)[0] == 0  # all is done
    again = run("two", lambda w, i: True, digests=digests.withColumn("digest", F.when(F.col("filename") == "a.pdf", "y").otherwise("x")))
    assert again[0] == 8 and again[1] == whole  # the changed document anew
    assert run("two", lambda w, i: True, rebuild=True)[0] == 12


def test_gates_that_break_off_keep_what_was_published(spark, tmp_path):
    d = spark.createDataFrame([(f"d{i}", f"the text of claim number {i} is long enough for the gates to ask") for i in range(41)], "id string, text string")
    rows = d.select(F.col("id").alias("description_id_a"), F.lit("d0").alias("description_id_b"), F.lit("s").alias("source_id_a"), F.lit("t").alias("source_id_b"), F.lit("robots").alias("topic_a"), F.lit("robots").alias("topic_b")).where("description_id_a <> 'd0'").withColumn("pair_key", F.col("description_id_a"))
    t = SnapshotTable(spark, f"file://{tmp_path}/pairs", blocking.CANDIDATES)
    t.publish(widen(rows, t.schema))
    log = tmp_path / "calls"
    client = models.ScriptedCompleter({"contradict": {"label": "contradiction", "confidence": 0.9, "rationale": "r"}}, log=str(log))
    now, publish, left = F.lit("2024-01-01").cast("timestamp"), SnapshotTable.publish, [2]

    def breaking(self, df, expect=None):
        if left[0] == 0:
            raise RuntimeError("the machine is gone")
        left[0] -= 1
        return publish(self, df, expect)

    SnapshotTable.publish = breaking
    try:
        with pytest.raises(RuntimeError):
            stages.run_gates(d, t, client, "m", now, flush=10)
    finally:
        SnapshotTable.publish = publish
    kept = t.read().where("gate_status is not null").count()
    assert 0 < kept < 40
    log.write_text("")
    got = {(r.gate_status, r.gate_reason): r.n for r in stages.run_gates(d, t, client, "m", now, flush=10).collect()}
    assert sum(got.values()) == 40 - kept == len(log.read_text())
    assert t.read().where(F.col("gate_status") == "passed").count() == t.read().count() == 40


def uploads(spark, rows):
    schema = ledger.UPLOADS
    return spark.createDataFrame([(i, "meeting", d, None, f"inbox/{n}", sha, None, "pending", None, None, None, None) for i, d, n, sha in rows], schema)


def test_converted_files_appear_whole(spark, tmp_path):
    import hashlib

    store, out = tmp_path / "store", tmp_path / "out"
    store.mkdir()
    payload = json.dumps({"metadata": {"meeting_id": "m-20240102-101010"}, "chunks": [{"text": "erste Zeile ü"}, {"text": "zweite"}]}).encode()
    lines = b'{"text": "t", "doc_id": "p", "index": 0, "source_kind": "pdf"}\n'
    bad = b'{"doc_id": "q"}\n'
    for n, data in (("a.json", payload), ("b.jsonl", lines), ("c.jsonl", bad)):
        (store / n).write_bytes(data)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    todo = uploads(spark, [(1, "m", "a.json", sha(payload)), (2, "p", "b.jsonl", sha(lines)), (3, "q", "c.jsonl", sha(bad)), (4, "r", "d.jsonl", "0"), (5, "s", "b.jsonl", "0")])
    for _ in range(2):  # the second time in place of the first
        got = {r.id: (r.status, r.error) for r in handoff.check_files(spark, todo, f"file://{store}", f"file://{out}").collect()}
        assert got == {1: ("downloaded", None), 2: ("downloaded", None), 3: ("failed", "invalid: 1 errors"), 4: ("failed", "no such object"), 5: ("failed", "digest mismatch")}
        assert sorted(p.name for p in out.iterdir() if not p.name.startswith(".")) == ["m", "p"]
    rows = ch.parse(ch.read_lines(spark, f"file://{out}/m", "part-*"), strict=True).select("r.text", "r.doc_id", "r.index", "r.n_chunks").orderBy("index").collect()
    assert [tuple(r) for r in rows] == [("erste Zeile ü", "m-20240102-101010", 0, 2), ("zweite", "m-20240102-101010", 1, 2)]


def test_a_listener_sweeps_without_events(spark, tmp_path):
    events, calls = tmp_path / "events", []
    spark.createDataFrame([(1,)], "id long").write.parquet(f"file://{events}")
    query = handoff.listen(spark, f"file://{events}", "id long", lambda: calls.append(time.monotonic()), f"file://{tmp_path}/checkpoint", once=False, seconds=2, wake=0.5)
    try:
        end = time.monotonic() + 60
        while len(calls) < 3 and time.monotonic() < end:
            time.sleep(0.2)
    finally:
        query.stop()
    assert len(calls) >= 3 and calls[2] - calls[1] >= 1.9


def test_settled_frames_leave_nothing_behind(spark):
    seen = []

    def make():
        a = materialize(spark.range(5).toDF("id"), "settle-a")
        seen.extend(a.inputFiles())
        return a.where("id > 2")

    out = settle(spark, make, "settle-b")
    assert out.count() == 2 and not any(os.path.exists(f.split("://", 1)[-1]) for f in seen)
    files = [f.split("://", 1)[-1] for f in out.inputFiles()]
    assert files and all(map(os.path.exists, files))
    release(spark, spark.read.parquet(os.path.dirname(files[0])))
    assert not any(map(os.path.exists, files))
    assert o.KNN > 0
