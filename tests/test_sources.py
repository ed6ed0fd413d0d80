import json

import pytest
from pyspark.sql import functions as F

from strataloom.functions import text as tx
from strataloom.operators import validate
from strataloom.sources import chunks as ch
from strataloom.sources.tables import SnapshotTable, keep_first, take_new, upsert


def value(spark, col, **cells):
    rows = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'boolean' if isinstance(v, bool) else 'string'}" for k, v in cells.items()))
    return rows.select(col.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [("Research_Problem", "Research Problem"), ("3d  model's", "3D Model S"), ("a|b o=x", "A|B O=X"), ("ünder-über", "Ünder Über"), ("NER (v2)", "Ner V2"), ("  ", "")])
def test_canonical_ids_are_python_titles(spark, raw, want):
    assert value(spark, tx.canonical_id(F.col("c")), c=raw) == want


def test_title_case_equals_pythons(spark):
    words = ["hello world", "o'neil", "3d a1b", "ÉCOLE élan", "x y", "naïve|test", "中a文b", "HTTP2server", "a.b_c"]
    rows = spark.createDataFrame([(w,) for w in words], "c string")
    assert [r.x for r in rows.select(tx.title_case(F.col("c")).alias("x")).collect()] == [w.title() for w in words]


def test_speech_length_and_cleaning(spark):
    assert value(spark, tx.speech_length(F.col("c")), c="[A] hi there \n[B] ok ") == len("hi there \nok")
    assert value(spark, tx.clean_text(F.col("c")), c="a\x00b   12345 c\t\n") == "a b c"
    assert value(spark, tx.clean_text(F.col("c")), c="x12345y") == "x12345y"


@pytest.mark.parametrize("flag, notes, role, text, want", [
    (True, ["ocr"], None, "x", True), (False, ["pdf_ligature"], None, "x", True), (False, ["pdf_ligature", "ocr"], None, "x", False), (False, [], None, "It shows", False),
    (False, [], "table_artifact", "This SHOWS that", True), (False, [], "table_artifact", "showing 1 2 3", False),
])
def test_eligibility(spark, flag, notes, role, text, want):
    rows = spark.createDataFrame([(flag, notes, role, text)], "f boolean, n array<string>, r string, t string")
    assert rows.select(ch.effective_eligible(F.col("f"), F.col("n"), F.col("r"), F.col("t")).alias("x")).first().x is want


def test_files_become_documents(spark, tmp_path):
    folder = tmp_path / "paper"
    folder.mkdir()
    recs = [{"text": f"t{i}", "doc_id": "d", "index": i, "source_file": "x/y.pdf", "source_type": "pdf", "colour": 1} for i in range(3)] + [{"text": "z", "source_path": "/a/b.c.txt"}]
    (folder / "a.jsonl").write_text("\n\n".join(map(json.dumps, recs)) + "\n", encoding="utf-8")
    (folder / "b.jsonl").write_text(json.dumps(recs[0]) + "\n{oops\n[1]\n" + json.dumps({"doc_id": "e"}), encoding="utf-8")
    (folder / "skip.txt").write_text("no")
    parsed = ch.parse(ch.read_lines(spark, str(tmp_path)))
    rows = ch.chunks(parsed)
    docs = {(r.file[-7:], r.filename): r for r in ch.documents(rows).collect()}
    assert set(docs) == {("a.jsonl", "d"), ("a.jsonl", "b.c"), ("b.jsonl", "d"), ("b.jsonl", "e")}
    assert docs["a.jsonl", "d"].source_kind == "pdf" and docs["a.jsonl", "d"].doc_type == "paper"
    issues = {(r.file[-7:], r.line_no, r.code) for r in validate.validate(parsed).collect()}
    assert {("b.jsonl", 2, "invalid_json"), ("b.jsonl", 3, "invalid_json"), ("b.jsonl", 4, "schema")} <= issues
    assert ("a.jsonl", 1, "unknown_fields") in issues
    summary = validate.file_summary(parsed, validate.validate(parsed))
    assert {r.file[-7:]: r.state for r in summary.collect()} == {"a.jsonl": "warned", "b.jsonl": "failed"}
    assert validate.exit_code(summary) == 1 and validate.exit_code(summary.limit(0)) == 2
    with pytest.raises(Exception):
        ch.parse(ch.lines_of(spark, b"{oops"), strict=True).collect()


def test_payloads(spark, tmp_path):
    body = {"metadata": {"meeting_id": "sync-20240102-101112-x", "input": "in.json"}, "chunks": [{"chunk_id": "c0", "text": "[A] " + "w" * 70}, {"chunk_id": "c1", "meeting_id": "other", "text": "[A] " + "w" * 69}]}
    (tmp_path / "m.chunks.json").write_text(json.dumps(body))
    rows = ch.from_payload(ch.read_payloads(spark, str(tmp_path))).orderBy("index").collect()
    assert [(r.doc_id, r["index"], r.n_chunks, r.extraction_eligible, r.date, r.series) for r in rows] == [("sync-20240102-101112-x", 0, 2, True, "2024-01-02", "sync"), ("other", 1, 2, False, None, None)]
    ch.write_lines(ch.from_payload(ch.read_payloads(spark, str(tmp_path))).drop("speaker_ids"), str(tmp_path / "out"))
    assert ch.chunks(ch.parse(ch.read_lines(spark, str(tmp_path / "out"), "*.txt"))).count() == 2
    bad = spark.createDataFrame([((None, None, None), [("c", None, "t", None, None, None, None, None, None)])], ch.PAYLOAD)
    with pytest.raises(Exception, match="meeting_id"):
        ch.from_payload(bad).collect()


@pytest.mark.parametrize("path", ["/etc/x", "../x", "a/../x", ""])
def test_unsafe_paths(spark, path):
    with pytest.raises(Exception, match="unsafe"):
        value(spark, ch.safe_file_name(F.col("p")), p=path)


def test_snapshot_tables(spark, tmp_path):
    t = SnapshotTable(spark, f"file://{tmp_path}/t", "k long, a string, b string")
    assert t.version() == 0 and t.read().count() == 0
    t.publish(spark.createDataFrame([(1, "x", "y")], "k long, a string, b string"))
    new = spark.createDataFrame([(1, "p", None), (2, "q", "r")], "k long, a string, b string")
    t.publish(upsert(t.read(), new, ["k"], {"a": keep_first, "b": take_new}))
    assert sorted(map(tuple, t.read().collect())) == [(1, "x", None), (2, "q", "r")]
    assert t.version() == 2 and t.read(1).count() == 1
    with pytest.raises(RuntimeError):
        t.publish(new, expect=1)
    (tmp_path / "t" / "_CURRENT").write_text("broken")
    assert SnapshotTable(spark, f"file://{tmp_path}/t", "k long").version() == 0
