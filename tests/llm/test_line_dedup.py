import random

from strataloom.llm import line_dedup


def brute(rows, min_words):
    """From the definition: a line goes if some run of enough words that holds it also starts earlier."""
    docs = sorted({(d, t) for d, t in rows}, key=lambda x: (x[0], x[1] or ""))
    seqs = [[(i, x) for i, x in enumerate((t or "").split("\n")) if x.split()] for _, t in docs]
    seen, gone = {}, [set() for _ in docs]
    for k, seq in enumerate(seqs):
        for i in range(len(seq)):
            for j in range(i + 1, len(seq) + 1):
                key = tuple(x for _, x in seq[i:j])
                if sum(len(x.split()) for x in key) >= min_words:
                    if key in seen:
                        gone[k].update(n for n, _ in seq[i:j])
                    else:
                        seen[key] = (k, i)
    return {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in g) for (d, t), g in zip(docs, gone)}


def test_matches_brute_force(spark):
    rnd = random.Random(3)
    lines = [" ".join(rnd.choices("abcdefgh", k=rnd.randint(1, 6))) for _ in range(12)] + ["", "  "]
    rows = [(i, "\n".join(rnd.choices(lines, k=rnd.randint(0, 14)))) for i in range(80)]
    rows += [(i + 100, rows[i][1]) for i in range(20)] + [(200, None), (201, ""), (202, "a b\n" * 3000)]
    rows += rows[:5]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_lines int").repartition(5)
    for least in (1, 8):
        want = brute([r for r in rows if r[0] != 202], least)
        got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df.where("doc_id <> 202"), min_words=least).collect()}
        assert {d: t or "" for d, t in got.items()} == want
    assert line_dedup.dedup_lines(df).count() == len(rows)


def test_long_repeats_within_a_document(spark):
    df = spark.createDataFrame([(1, "a b\n" * 3000)], "doc_id long, text string")
    (row,) = line_dedup.dedup_lines(df, min_words=20).collect()
    assert row.n_lines == 3000 and row.n_removed_lines == 2999


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string, extra int")).count() == 0
