import numpy as np
import xxhash

from strataloom.llm import simhash


def brute(rows):
    """(fingerprint, component) per row from the definition, over all pairs."""
    fps = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps.append(sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    low = {}
    for g, (d, _) in zip(group, rows):
        low[g] = min(low.get(g, d), d)
    return sorted((d, f"{f:016x}", low[g]) for (d, _), f, g in zip(rows, fps, group))


def test_matches_all_pairs(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        w = rng.choice(vocab, 120).tolist()
        rows.append((len(rows), " ".join(w)))
        for k in range(4):
            w = list(w)
            w[int(rng.integers(120))] = "Xx"
            rows.append((len(rows), " ".join(w) + "\n" * k))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \t\v"), (len(rows) + 3, "one"), (len(rows) + 4, "ONE two"), (len(rows) + 5, "x " * 30000)]
    rows += rows[:3]
    df = spark.createDataFrame([(d, t, "e") for d, t in rows], "doc_id long, text string, fp string")
    got = sorted(tuple(r) for r in simhash.near_duplicates(df).collect())
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len(rows)


def test_ball_finds_every_link_of_three_bits():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    near = base ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (200, 3), dtype=np.uint64), axis=1)
    fps = np.unique(np.concatenate([base, near]))
    node, low = simhash.forest(*simhash.star_edges(*simhash.variants(fps)))
    got = dict(zip(node.tolist(), low.tolist()))
    for a, b in zip(base.tolist(), near.tolist()):
        assert got.get(a, a) == got.get(b, b)


def test_dealt_variants_are_all_variants():
    fps = np.unique(np.random.default_rng(2).integers(0, 2**63, 700, dtype=np.uint64))
    blobs = simhash._dealt_variants(fps, 37).column("blob").to_pylist()
    z, code = (np.concatenate(c) for c in zip(*map(simhash._shard_variants, blobs)))
    want_z, want_code = simhash.variants(fps)
    assert sorted(zip(z.tolist(), code.tolist())) == sorted(zip(want_z.tolist(), want_code.tolist()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.near_copies(df).count() == 0


def test_near_copies_groups_edited_texts(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(40):
        w = [f"t{x}" for x in rng.integers(0, 100000, 300)]
        v = list(w)
        v[150] = "edited"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    df = spark.createDataFrame(rows + [(900, ""), (901, None)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
    assert [got[2 * i + 1] for i in range(40)] == [2 * i for i in range(40)] == [got[2 * i] for i in range(40)]
    assert got[900] == 900 and got[901] == 901


def edited(rng, edits):
    """A text of 300 words and the same with ``edits`` words changed, far apart: 296 shingles, of which 5 go with each."""
    w = [f"t{x}" for x in rng.integers(0, 10**9, 300)]
    v = list(w)
    for k in range(edits):
        v[20 + 40 * k] = f"new{k}"
    return " ".join(w), " ".join(v)


def test_near_copies_below_the_similarity_stay(spark):
    """Seven edits leave 261 of 331 shingles, a similarity of 0.789; 14 leave 0.62."""
    rng = np.random.default_rng(8)
    rows = [t for k in (7, 7, 7, 7, 6, 6, 5, 5) for _ in range(15) for t in edited(rng, k)]
    near = [k <= 6 for k in (7, 7, 7, 7, 6, 6, 5, 5) for _ in range(15)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
    assert all(got[2 * i] == 2 * i for i in range(len(near)))
    linked = [got[2 * i + 1] == 2 * i for i in range(len(near))]
    assert not any(a and not b for a, b in zip(linked, near))


def test_near_copies_at_the_similarity_meet(spark):
    """Against all pairs by brute force; six edits leave 266 of 326 shingles, a similarity of 0.816."""
    rng = np.random.default_rng(9)
    texts = [t for _ in range(400) for t in edited(rng, 6)]
    sets = [{" ".join(w[i : i + 5]) for i in range(296)} for w in map(str.split, texts)]
    pairs = [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(pairs) == 400
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
    assert sum(got[i] == got[j] for i, j in pairs) >= 0.99 * len(pairs)


def jaccard(a, b):
    x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_at_and_below_the_threshold(spark):
    """Pairs of known similarity: every one at 0.8 or more is linked and none below, against the exact value."""
    rng = np.random.default_rng(12)
    rows, want, at = [], {}, {}
    for k in (1, 3, 5, 6, 7, 10, 14):
        for _ in range(40):
            a = [f"w{int(x)}" for x in rng.integers(0, 10**6, 300)]
            b = list(a)
            for i in range(k):
                b[5 + i * (290 // k)] = "other"
            j = jaccard(a, b)
            want[len(rows)] = j >= 0.8
            at.setdefault(round(j, 1), []).append(len(rows))
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    assert {0.7, 0.8, 0.9} <= set(at)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
    assert {i: got[i + 1] == i for i in want} == want


def test_near_copies_are_those_of_all_pairs(spark):
    """Documents of the smallest tables against all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sets = {}
    for r in docs.collect():
        h = simhash.shingle_hashes((r.text or "").encode(), 5)
        sets[r.doc_id] = frozenset(h.tolist())
    group = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    assert {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()} == group
