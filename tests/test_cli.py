import json

import pytest

from strataloom import models
from strataloom.__main__ import main
from strataloom.operators import ledger
from strataloom.sources.tables import SnapshotTable


def test_validate_and_convert(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.chunks.json").write_text(json.dumps({"metadata": {"meeting_id": "s-20240102-101112-x"}, "chunks": [{"chunk_id": "c", "text": "hi"}]}))
    assert main(["convert", str(tmp_path / "in"), str(tmp_path / "out"), "--dry-run"]) == 0
    assert not (tmp_path / "out").exists()
    assert main(["convert", str(tmp_path / "in"), str(tmp_path / "out")]) == 0
    (tmp_path / "bad.jsonl").write_text("{oops")
    assert main(["validate", str(tmp_path)]) == 1
    assert "invalid_json" in capsys.readouterr().out
    (tmp_path / "empty").mkdir()
    assert main(["validate", str(tmp_path / "empty")]) == 2


def scripted():
    """A client of a class that travels with it, as workers don't have this module."""

    class Scripted:
        """Stands for any service: graphs for extraction, verdicts for the rest."""

        def complete(self, prompt):
            if "Passage" in prompt:
                name = prompt.split("Source: ")[1].split("\n")[0]
                claim = {"text": f"the method under test improves the measured outcome by a wide margin, as {name} has it", "topicName": "Robots", "typeName": "Result", "source_id": name}
                nodes = [{"id": name, "type": "Source", "properties": {"date_raw": "2020"}}, {"id": "Robots", "type": "Topic", "properties": {}}, {"id": "Result", "type": "Type", "properties": {}}, {"id": f"Description Robots {name}", "type": "Description", "properties": claim}]
                ties = [("Robots", "Result", "has_type"), ("Robots", name, "has_source"), ("Result", f"Description Robots {name}", "result_description"), (f"Description Robots {name}", name, "has_source")]
                return json.dumps({"nodes": nodes, "relationships": [{"source": a, "target": b, "type": t, "properties": {}} for a, b, t in ties]})
            return json.dumps({"label": "contradiction", "confidence": 0.9, "rationale": "r", "decision": "no", "resolution_type": "known_controversy", "summary": "they differ", "evidence_used": [], "positions": []})

    return Scripted()


def test_from_files_to_clusters(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(models, "completer", lambda settings, purpose="llm": scripted())
    monkeypatch.setattr(models, "embedder", lambda settings, purpose="embedding": models.HashEmbedder(8))
    (tmp_path / "in").mkdir()
    for d in ("a", "b"):
        (tmp_path / "in" / f"{d}.jsonl").write_text("\n".join(json.dumps({"text": f"text {i} of {d}", "doc_id": d, "index": i, "source_kind": "pdf", "source_path": f"{d}.pdf"}) for i in range(2)))
    store = f"file://{tmp_path}/store"
    assert main(["build", str(tmp_path / "in"), store]) == 0
    assert "2 documents" in capsys.readouterr().out
    assert main(["build", str(tmp_path / "in"), store]) == 0
    assert "0 documents" in capsys.readouterr().out
    for command in ("embed", "blocking", "gates", "classify"):
        assert main([command, store]) == 0
    assert "vectors" in capsys.readouterr().out
    (tmp_path / "in" / "c.jsonl").write_text("{oops")
    assert main(["build", str(tmp_path / "in"), store]) == 1


def test_no_model_is_named(spark, tmp_path):
    with pytest.raises(SystemExit, match="no model"):
        main(["gates", f"file://{tmp_path}/store"])


def test_upload_and_drain(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(json.dumps({"text": "t", "doc_id": "a", "index": 0, "source_kind": "pdf"}) + "\n")
    table, store = f"file://{tmp_path}/tables/uploads", f"file://{tmp_path}/objects"
    assert main(["upload", str(tmp_path / "in"), table, store, "--dry-run"]) == 0 and not (tmp_path / "objects").exists()
    assert main(["upload", str(tmp_path / "in"), table, store]) == 0
    assert "1 new files" in capsys.readouterr().out
    assert main(["upload", str(tmp_path / "in"), table, store]) == 0
    assert "0 new files" in capsys.readouterr().out
    assert main(["drain", table, store]) == 0
    rows = SnapshotTable(spark, table, ledger.UPLOADS).read().collect()
    assert [(r.doc_id, r.status, r.error) for r in rows] == [("a", "downloaded", None)]
    (tmp_path / "in" / "b.jsonl").write_text("{oops")
    assert main(["upload", str(tmp_path / "in"), table, store]) == 1
