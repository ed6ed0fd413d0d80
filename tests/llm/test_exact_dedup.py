import hashlib
import random

import numpy as np

from strataloom.llm import exact_dedup
from strataloom.llm.suffix_array import permuted_lcp, suffix_array


def brute(rows, length):
    """From the definition, over all windows of all documents."""
    docs = sorted({(-1 if d is None else d, t or "") for d, t in rows})
    seen, out = set(), {}
    for d, t in docs:
        b = t.encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = [True] * length
            seen.add(w)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def texts():
    rnd = random.Random(8)
    noise = lambda n: "".join(rnd.choices("abcdé fgh\n", k=n))
    passages = [noise(rnd.randint(90, 400)) for _ in range(6)]
    rows = []
    for i in range(70):
        parts = [noise(rnd.randint(0, 200))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 60)
            parts += [p[a:], noise(rnd.randint(0, 50))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    return rows + [(200, "ab" * 400), (201, "a" * 700), (202, None), (203, ""), (204, "x" * 99), (None, passages[0])] + rows[:4]


def test_matches_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(d, t, b"") for d, t in rows], "doc_id long, text string, kept binary").repartition(6)
    got = exact_dedup.digest(df).collect()
    assert len(got) == len(rows)
    assert {-1 if r.doc_id is None else r.doc_id: tuple(r)[1:] for r in got} == brute(rows, 100)


def test_common_owners_come_as_windows(spark):
    rnd = random.Random(3)
    shared = "".join(rnd.choices("abcdefgh ", k=400))
    rows = [(i, "".join(rnd.choices("uvwxyz ", k=60)) + shared[rnd.randint(0, 30) : 400 - rnd.randint(0, 200)] + "".join(rnd.choices("uvwxyz ", k=60))) for i in range(300)]
    base = exact_dedup.keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    common = exact_dedup.common_owners(base, 100, 50, 300)
    assert len(common) > 0 and (np.diff(common.astype(np.float64)) > 0).all()
    text, ends = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8), np.cumsum([len(t) for _, t in rows])
    plain, split = exact_dedup.snippets(text, ends, 100, 50), exact_dedup.snippets(text, ends, 100, 50, common)
    windows = lambda s: sorted(x for a, n in zip(s[2].tolist(), s[3].tolist()) for x in range(a, a + n))
    assert windows(plain) == windows(split) and np.bincount(np.unique(split[0], return_inverse=True)[1]).max() <= 300
    assert not np.isin(split[0][split[3] > 1], common).any()


def test_common_owners_change_no_result(spark):
    rows = [(k * 1000 + d if d is not None else None, t) for k in range(50) for d, t in texts()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    a, b = ({(r.doc_id, r.crc, bytes(r.spans)) for part in exact_dedup.later_bytes(df, "doc_id", "text", sample=n) for r in part.collect()} for n in (0, 8192))
    cover = lambda rows: {(d, c): exact_dedup.union([s for e, f, s in rows if (e, f) == (d, c)]) for d, c, _ in rows}
    assert cover(a) == cover(b)


def test_hot_owners_are_dealt_as_windows(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spans = exact_dedup.later_bytes(df, "doc_id", "text", hot=1)
    got = {}
    for part in spans:
        for r in part.collect():
            got.setdefault(r.doc_id, []).append(bytes(r.spans))
    want = brute(rows, 100)
    null = exact_dedup.keyed(df.where("doc_id is null"), "doc_id", "text").first().doc_id
    for d, (_, removed, n, _) in want.items():
        found = exact_dedup.union(got.get(null if d == -1 else d))
        assert (sum(e - s for s, e in found), len(found)) == (removed, n), d


def test_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(exact_dedup, "_CHUNK", 256)
    import pyarrow as pa

    rng = np.random.default_rng(0)
    t = bytes(rng.integers(97, 100, 3000, dtype=np.uint8))
    batch = pa.RecordBatch.from_arrays([pa.array([t, b"short", t[:150]], pa.binary())], ["text"])
    covered = {0: set(), 2: set()}
    for buf, ends, index, offset in exact_dedup._buffers(batch, 100):
        _, _, start, size = exact_dedup.snippets(buf, ends, 100, 50)
        i, s = exact_dedup._place(ends, index, offset, start)
        for k, a, n in zip(i.tolist(), s.tolist(), size.tolist()):
            covered[k] |= set(range(a, a + n))
    assert covered == {0: set(range(2901)), 2: set(range(51))}


def test_empty_table(spark):
    assert exact_dedup.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for t in range(300):
        s = np.append(rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 60))), 0)
        sa = suffix_array(s)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: tuple(s[i:]))
        lcp = permuted_lcp(s, sa, 10)
        for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
            n = 0
            while n < min(len(s) - a, len(s) - b, 10) and s[a + n] == s[b + n]:
                n += 1
            assert lcp[b] == n
    s = np.append(rng.integers(1, 9000, 20000), 0)
    assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: tuple(s[i : i + 8]))


def test_shards_without_questions(spark):
    rows = [(i, "copy " * 50 if i < 3 else f"{i} alone") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: tuple(r)[1:] for r in exact_dedup.digest(df).collect()} == brute(rows, 100)


def test_arrays_of_many_letters():
    """Strings of names, whatever their alphabets, go through the same algorithm all the way down."""
    rng = np.random.default_rng(6)
    for n in (5, 40, 300, 3000):
        for letters in (2, 30, 1500, 10**6):
            s = np.append(rng.integers(1, letters + 1, n), 0)
            s[n // 2 : n - n // 4] = s[: n - n // 4 - n // 2]
            got = suffix_array(s).tolist()
            assert got == sorted(range(len(s)), key=lambda k: s[k:].tolist())
