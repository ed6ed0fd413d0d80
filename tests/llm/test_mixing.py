import collections

import duckdb
from pyspark.sql import functions as F

from strataloom.llm import mixing

DATA = "/root/testdata/sf0.001"


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    cur = con.execute(mixing.SQL)
    names = [d[0] for d in cur.description]
    df = mixing.mixture(spark.read.parquet(f"{DATA}/documents.parquet"))
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == sorted(cur.fetchall())


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch string")


def taken(df):
    out = collections.Counter()
    for r in df.collect():
        out[r.domain, r.lang, r.source] += r.n_tokens
    return out


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, "en", "a", "") for i in range(2)] + [(100 + i, "w " * 10, "en", "b", "") for i in range(100)] + [(300 + i, "w " * 10, "de", "c", "") for i in range(100)]
    got = taken(mixing.mix_sources(docs(spark, rows), F.lit("d"), budget=800, max_epochs=2))
    # a holds 20 tokens, two epochs of it make 40 of its 200; its sibling b takes the rest of English's 400
    assert got == {("d", "en", "a"): 40, ("d", "en", "b"): 360, ("d", "de", "c"): 400}


def test_shortage_moves_up_when_no_sibling_can_take_it(spark):
    rows = [(1, "w " * 10, "en", "a", "")] + [(300 + i, "w " * 10, "de", "c", "") for i in range(100)]
    got = taken(mixing.mix_sources(docs(spark, rows), F.lit("d"), budget=800, max_epochs=2))
    assert got == {("d", "en", "a"): 20, ("d", "de", "c"): 780}


def test_epochs_are_whole_and_the_prefix_is_seeded(spark):
    rows = [(i, "w " * 10, "en", "a", "") for i in range(50)]
    pick = lambda seed: sorted((r.doc_id, r.epoch) for r in mixing.mix_sources(docs(spark, rows), F.lit("d"), budget=720, seed=seed).collect())
    one, two = pick(1), pick(2)
    for got in (one, two):
        assert len(got) == 72 and {d for d, e in got if e == 0} == set(range(50)) and len({d for d, e in got if e == 1}) == 22
    assert one != two and one == pick(1)


def test_odd_rows(spark):
    rows = [(1, None, None, None, "x"), (2, "", "en", "a", "x"), (None, "one two", "en", "a", "x"), (3, "long " * 20000, "en", "b", "x"), (4, "same text", "en", "c", "x"), (4, "same text", "en", "c", "x")]
    got = mixing.mix_sources(docs(spark, rows), F.lit(None).cast("string"), share=1.0)
    assert {r.domain for r in got.collect()} == {""} and got.columns == ["doc_id", "text", "lang", "source", "domain", "epoch", "n_tokens"]
    assert collections.Counter(r.doc_id for r in got.collect()) >= collections.Counter([None, 3, 4, 4])
    assert mixing.mix_sources(docs(spark, []), F.lit("d")).count() == 0


def test_a_weight_of_nothing_takes_nothing(spark):
    rows = [(i, "w " * 10, "en", "ab"[i % 2], "") for i in range(40)]
    got = taken(mixing.mix_sources(docs(spark, rows), F.lit("d"), budget=100, weights={"source": {"a": 0}}))
    assert got == {("d", "en", "b"): 100}


def test_plan_is_native(spark):
    plan = mixing.mixture(spark.read.parquet(f"{DATA}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
