import hashlib
import zlib
from collections import Counter

import pyarrow.parquet as pq

from strataloom.llm import media, webp


def test_texts_come_back(spark):
    rows = [(1, "plain words, and more"), (2, None), (3, ""), (4, "Ünï\u0000cödé 日本 " * 500), (5, "A" * 576), (None, "plain words, and more"), (1, "plain words, and more")]
    df = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, media int")
    got = media.read_media(media.encode_media(df), pixels=True).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t in rows:
        b = (t or "").encode()
        b += b"\xff" * (576 - len(b) % 576 if len(b) % 576 or not b else 0)
        want[d] = (len((t or "").encode()), len(b), hashlib.sha256(b).hexdigest(), zlib.crc32(b[-32:]), b)
    for r in got:
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, bytes(r.pixels)) == want[r.doc_id]
    same = [tuple(r)[1:] for r in got if r.doc_id in (1, None)]
    assert len(set(same)) == 1
    assert media.read_media(media.encode_media(df.limit(0))).count() == 0


def test_texts_too_long_for_one_frame():
    payloads = [media.payload(bytes(range(256)) * 150), media.payload(b""), media.payload(b"a line\n" * 30_000)]
    stored = media.to_media(payloads)
    assert stored[0].count(b"ANMF") > 1 and b"VP8X" not in stored[1]
    for m, p, px in zip(stored, payloads, media.from_media(stored)):
        assert m.startswith(b"RIFF") and int.from_bytes(m[4:8], "little") == len(m) - 8
        assert px.tobytes() == p
        assert webp.decode(m)[:, :, :3].tobytes() == p


def test_every_feature_is_used_on_the_documents():
    """The query's own texts go through each part of the format, and both readers agree on them."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    payloads, written, read = [media.payload((t or "").encode()) for t in texts], Counter(), Counter()
    stored = media.to_media(payloads, written)
    got = media.from_media(stored, read)
    assert all(px.tobytes() == p for px, p in zip(got, payloads))
    for name in ("predictor", "cross_colour", "palette", "bundled", "images_with_cache", "cache_hits", "references"):
        assert written[name] > 0, name
    for name in ("predictor_read", "cross_colour_read", "palette_read", "cache_hits_read", "references_read"):
        assert read[name] > 0, name
    assert sum(map(len, stored)) < 0.7 * sum(map(len, payloads))
    for m, p in list(zip(stored, payloads))[::25]:
        assert webp.decode(m)[:, :, :3].tobytes() == p
