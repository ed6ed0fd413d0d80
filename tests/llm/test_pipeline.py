"""The stages against plain versions of their decisions, each on its own input."""

import random

import pytest

import corpus_pipeline as cp
from strataloom.llm import quality

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_quality_keeps_what_it_scores_high(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = cp.good_quality(spark, docs, DATA)
    assert got.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in got.collect()}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert sum(d in kept for d in bad) <= 0.3 * len(bad)
    model = quality.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert kept == {r.doc_id for r in quality.score(docs, model).where("score >= 0.7").collect()}


def test_line_stage(spark):
    run = "\n".join("this line has five words" for _ in range(1)) + "\nand this one has six words\nwhile the third and last line has as many as ten words"
    docs = spark.createDataFrame([(1, f"head\n{run}\ntail", "en", "s", 9), (2, f"{run}\nmine", "en", "s", 9), (3, run, "en", "s", 9), (4, "short\nlines", "en", "s", 9), (5, "short\nlines", "en", "s", 9), (6, None, "en", "s", 0), (7, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in cp.fresh_lines(spark, docs, DATA).collect()}
    assert got == {1: (f"head\n{run}\ntail", 9), 2: ("mine", 4), 4: ("short\nlines", 9), 5: ("short\nlines", 9), 6: (None, 0), 7: ("", 0)}


def test_one_of_each_group_stays(spark):
    rnd = random.Random(6)
    texts = [" ".join(f"w{rnd.randint(0, 99999)}" for _ in range(250)) for _ in range(30)]
    data = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    for i in range(10):
        w = texts[i].split()
        w[100] = "changed"
        data += [(100 + i, " ".join(w), "en", "s", 1), (200 + i, texts[i], "en", "s", 1)]
    data += [(5, texts[5], "en", "s", 1), (None, "", "en", "s", 0), (900, "", "en", "s", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.one_of_each(spark, docs, DATA)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == [*range(30), 900]
    assert sum(r.doc_id is None for r in got.collect()) == 1


def test_rows_and_not_ids_stay(spark):
    rnd = random.Random(8)
    a, b = (" ".join(f"w{rnd.randint(0, 99999)}" for _ in range(200)) for _ in range(2))
    near = a.replace(a.split()[50], "changed")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(3, a, "en", "s", 1), (5, near, "en", "s", 1), (5, b, "en", "s", 2), (5, b, "en", "s", 2), (None, near, "en", "s", 3), (9, "", "en", "s", 0)], schema)
    assert rows(cp.one_of_each(spark, docs, DATA)) == sorted([(3, a, "en", "s", 1), (5, b, "en", "s", 2), (9, "", "en", "s", 0)], key=str)


@pytest.mark.parametrize("name", ["quality", "lines", "near_copies", "mixing", "packing"])
def test_stages_take_empty_tables_and_nulls(spark, name):
    stage = dict(cp.STAGES)[name]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0), (2, "word " * 60_000, "en", None, None), (None, "a b c", "en", "src0", 5)], schema)
    out = stage(spark, docs, DATA)
    assert name == "packing" or out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} <= {None, 1, 2}
    assert stage(spark, docs.limit(0), DATA).count() == 0


def test_mixing_stage_returns_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = cp.mixed(spark, docs, DATA)
    assert got.columns == docs.columns
    count = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert max(count.values()) <= 2
    assert set(rows(got)) <= set(rows(docs))


def test_run(spark):
    out = cp.run(spark, DATA)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    used = {r.sequence_id: r.n for r in out.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert used and max(used.values()) <= 2048
    assert [n for n, _ in cp.STAGES] == ["quality", "lines", "near_copies", "mixing", "packing"]
