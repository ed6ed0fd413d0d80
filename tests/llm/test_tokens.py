import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strataloom.llm import packing, pieces, token_counts

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [*"abZé'sstre.,!?;: \n\t\r\v\x1c\x85\xa0​́ΣσİéÀß12½ª日😀_-<|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", " 's", "'ll", "  "]


def test_pieces_give_the_librarys_ids():
    rnd = random.Random(2)
    texts = ["".join(rnd.choices(ODD, k=rnd.randint(0, 16))) for _ in range(4000)]
    for path, cut in ((BYTE, pieces.byte_pieces), (WORD, pieces.word_pieces)):
        tok, get = Tokenizer.from_file(path), pieces.ids_cache(path).__getitem__
        for t in texts:
            assert np.frombuffer(b"".join(map(get, cut(t))), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_special_strings_in_upper_case():
    tok, get = Tokenizer.from_file(WORD), pieces.ids_cache(WORD).__getitem__
    for t in ("<|ENDOFTEXT|>", "a <|EndOfText|> b", "<|STARTOFTEXT|>x", "<|endoftext|>", "A<|B", "É <|ENDOFTEXT|>"):
        assert np.frombuffer(b"".join(map(get, pieces.word_pieces(t))), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_packing_keeps_large_ids_beside_nulls(spark):
    ids = [2**53 + 1, None, -(2**63), 2**63 - 1, None]
    df = spark.createDataFrame([(i, "a b", 0) for i in ids], "doc_id long, text string, length int").coalesce(1)
    got = [r.doc_id for r in packing.pack(df, WORD).collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == sorted(ids, key=lambda x: (x is None, x))


def test_counts(spark):
    rows = [(1, "Hello, world's end."), (2, None), (3, ""), (4, "x y" * 4000), (None, "a"), (1, "Hello, world's end.")]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, n_tokens int")
    tok = Tokenizer.from_file(BYTE)
    want = sorted((d or 0, len((t or "").encode()), n := len(tok.encode(t or "").ids), n > 1024) for d, t in rows)
    assert sorted((r[0] or 0, *r[1:]) for r in token_counts.token_counts(df, BYTE).collect()) == want
    assert token_counts.token_counts(df.limit(0), BYTE).count() == 0


def test_sentencepiece_counts(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id long, text string")
    assert [r.n_tokens for r in token_counts.token_counts(df, path).orderBy("doc_id").collect()] == [len(model.encode("Hello  world")), 0]


def test_packing_holds_every_id_once(spark):
    rnd = random.Random(4)
    words = ["alpha", "Beta,", "gamma", "ünder", "12"]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.choice([0, 3, 50, 700, 5000])))) for i in range(120)] + [(500, None), (None, "x"), (7, "same"), (7, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.asDict() for r in packing.pack(df, WORD, with_ids=True).collect()]
    tok = Tokenizer.from_file(WORD)
    want = sorted((d or -1, *tok.encode(t or "", add_special_tokens=False).ids, 1) for d, t in rows)
    docs = {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        docs.setdefault((r["doc_id"] or -1, r["start"], r["sequence_id"], r["offset"]), r)
    assert len(docs) == len(got)
    whole = {}
    for r in sorted(got, key=lambda r: r["start"]):
        whole.setdefault(r["doc_id"] or -1, []).append(r)
    for d, parts in whole.items():
        ids = [x for r in parts for x in np.frombuffer(r["ids"], "<u4").tolist()]
        assert sorted(ids) == sorted(x for w in want if w[0] == d for x in w[1:])
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in got) > 0.97 * 2048 * len(sequences)
    assert packing.pack(df.limit(0), WORD).count() == 0


def test_differencing_is_near_equal():
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 512) for _ in range(3000)]
    parts = packing.pack_sizes(sizes, 2048)
    assert sorted(i for p in parts for i in p) == list(range(3000))
    assert max(sum(sizes[i] for i in p) for p in parts) <= 2048
    assert len(parts) <= 1.01 * sum(sizes) / 2048 + 1
