from collections import Counter

import numpy as np
import pytest

from strataloom.llm import webp, webp_batch


def file_of(stream):
    """A stream as a file of its own, for the plain reader."""
    body = stream + b"\0" * (len(stream) & 1)
    return b"RIFF" + (12 + len(body)).to_bytes(4, "little") + b"WEBPVP8L" + len(stream).to_bytes(4, "little") + body


def pictures():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, int(n))) for n in rng.integers(2, 9, 400)]
    out = []
    for k in range(120):
        rows = int(rng.integers(1, 6))
        text = b" ".join(words[int(i)] for i in rng.zipf(1.3, rows * 120) % 400)[: rows * 576 - int(rng.integers(0, 500))]
        out.append(np.frombuffer(text + b"\xff" * (rows * 576 - len(text)), np.uint8).reshape(-1, 3))
    out += [np.zeros((192, 3), np.uint8), np.full((192 * 3, 3), 255, np.uint8), rng.integers(0, 256, (192 * 16, 3), dtype=np.uint8)]
    out += [rng.choice([3, 250], (192 * 2, 3)).astype(np.uint8), np.repeat(rng.integers(0, 256, (16, 3), dtype=np.uint8), 24, axis=0)]
    return out


def test_both_readers_read_what_is_written():
    images, written, read = pictures(), Counter(), Counter()
    streams = webp_batch.encode_streams(images, 192, written)
    fast = webp_batch.decode_streams(streams, read)
    for px, s, got in zip(images, streams, fast, strict=True):
        assert (got[:, :, :3].reshape(-1, 3) == px).all() and (got[:, :, 3] == 255).all()
        assert (webp.decode(file_of(s)) == got).all()
    for name in ("predictor", "cross_colour", "palette", "bundled", "plain", "cache_hits", "references"):
        assert written[name] > 0, name
    for name in ("predictor_read", "cross_colour_read", "palette_read", "cache_hits_read", "references_read"):
        assert read[name] > 0, name
    assert webp_batch.encode_streams(images[7:9], 192) == streams[7:9]  # an image's stream hangs on nothing but the image
    assert webp_batch.decode_streams([]) == []


@pytest.mark.parametrize("kinds", [(), (0,), (1,), (2,), (3,), (0, 1, 2), (3, 2, 1, 0)])
@pytest.mark.parametrize("how", [{}, {"refs": True, "cache_bits": 5}, {"groups_bits": 2}])
def test_streams_of_the_plain_writer(kinds, how):
    rng = np.random.default_rng(1)
    streams, want = [], []
    for k, (h, w) in enumerate([(5, 23), (1, 1), (17, 9), (6, 40)]):
        px = rng.integers(0, 256, (40, 4), dtype=np.uint8)[rng.integers(0, 40, (h, w))]
        data = webp.encode(px, kinds, bits=2, seed=k, **how)
        streams.append(data[20 : 20 + int.from_bytes(data[16:20], "little")])
        want.append(px)
    for got, px in zip(webp_batch.decode_streams(streams), want, strict=True):
        assert (got == px).all()


def test_lengths_are_optimal_and_bounded():
    rng = np.random.default_rng(4)
    counts = rng.zipf(1.5, (300, 90)) * (rng.random((300, 90)) < rng.random((300, 1)))
    counts[0], counts[1], counts[2] = 0, 0, 0
    counts[0, 5], counts[1, [3, 9]], counts[2, :30] = 7, (1, 100), 2 ** np.arange(30)
    counts[counts.sum(axis=1) == 0, 0] = 1
    lengths = webp_batch.code_lengths(counts, 11)
    assert lengths.max() <= 11 and ((lengths > 0) == (counts > 0)).all()
    free = webp_batch.code_lengths(counts, 60)
    for c, n in zip(counts.tolist(), free.tolist(), strict=True):
        if sum(x > 0 for x in c) > 1:
            assert sum(2.0**-x for x in n if x) == 1
            want = webp._huffman(c, 60)
            assert sum(x * y for x, y in zip(c, n)) == sum(x * y for x, y in zip(c, want))


def test_broken_streams_are_refused():
    (s,) = webp_batch.encode_streams(pictures()[:1], 192)
    for bad in (s[: len(s) // 2], b"\x2e" + s[1:], s[:6]):
        with pytest.raises(webp.BadImage):
            webp_batch.decode_streams([bad])


def test_every_image_but_noise_is_predicted():
    """No checksum and no height leaves an image out, and an image's choices hang on nothing but the image."""
    images, written, read = pictures(), Counter(), Counter()
    streams = webp_batch.encode_streams(images, 192, written)
    webp_batch.decode_streams(streams, read)
    assert written["plain"] == 1  # of the pictures only the one of random samples
    for name in ("predictor", "cross_colour"):
        assert written[name] == read[f"{name}_read"] == len(images) - 1, name
    for k in (0, 50, 121, 123, 124):
        assert webp_batch.encode_streams(images[k : k + 1], 192) == streams[k : k + 1]


def test_tiles_take_modes_and_factors_that_pay():
    rng, rows = np.random.default_rng(5), 40
    green, noise = np.cumsum(rng.integers(-3, 4, 192 * rows)), rng.integers(0, 3, (2, 192 * rows))
    tied = np.stack([green // 2 + noise[0], green, green // 4 + noise[1]], axis=1)  # red and blue follow green
    tiles = []
    for step in (0, 1, -1):  # like the top, the top left, the top right
        line = rng.integers(0, 256, (32, 3))
        tiles.append(np.stack([np.roll(line, step * k, axis=0) for k in range(rows)]))
    tiles += [np.repeat(rng.integers(0, 256, (rows, 1, 3)), 32, axis=1) for _ in range(3)]  # like the left
    images, written = [(v % 256).astype(np.uint8) for v in (tied, np.concatenate(tiles, axis=1).reshape(-1, 3))], Counter()
    streams = webp_batch.encode_streams(images, 192, written)
    assert written["predictor"] == 2 and written["factored"] > 0 and all(written[f"mode_{k}"] > 0 for k in (1, 2, 3, 4))
    for px, s, got in zip(images, streams, webp_batch.decode_streams(streams), strict=True):
        assert (got[:, :, :3].reshape(-1, 3) == px).all() and (webp.decode(file_of(s)) == got).all()
        assert len(s) < 0.6 * px.size


def test_predictions_are_the_plain_readers():
    near = np.random.default_rng(6).integers(0, 256, (4, 500, 4), dtype=np.uint8)
    near[:, :50] = near[:, :50] // 128 * 255
    packed = [np.ascontiguousarray(v).view(np.uint32).ravel() for v in near]
    for mode in range(16):
        got = np.array(webp_batch.predicted(mode, packed.__getitem__)).view(np.uint8).reshape(-1, 4)
        want = [webp._predict(mode, *(v[i, ::-1].tolist() for v in near))[::-1] for i in range(500)]
        assert (got == np.array(want)).all(), mode


def test_reading_takes_a_turn_per_symbol():
    """What a reference or a cache hit stands for is found for all of them at once, not pixel by pixel."""
    rng, read = np.random.default_rng(7), Counter()
    lines = [rng.integers(0, 256, (24, 3), dtype=np.uint8) for _ in range(3)]
    images = [np.tile(v, (8 * rows, 1)) for v, rows in zip(lines, (8, 20, 3))]
    streams = webp_batch.encode_streams(images, 192)
    for px, s, got in zip(images, streams, webp_batch.decode_streams(streams, read), strict=True):
        assert (got[:, :, :3].reshape(-1, 3) == px).all() and (webp.decode(file_of(s)) == got).all()
    assert 0 < read["turns_read"] < 400  # of 3,840 pixels in the longest


def test_copies_of_cache_hits_and_hits_on_copies():
    rng = np.random.default_rng(8)
    for cache_bits in (1, 3, 11):
        streams, want = [], []
        for h, w, colours in ((9, 31, 5), (20, 20, 40), (2, 300, 9), (1, 1, 1)):
            px = rng.integers(0, 256, (colours, 4), dtype=np.uint8)[rng.integers(0, colours, (h, w))]
            px[h // 2 :, : w // 2] = px[: h - h // 2, : w // 2]
            data = webp.encode(px, cache_bits=cache_bits, refs=True)
            streams.append(data[20 : 20 + int.from_bytes(data[16:20], "little")])
            want.append(px)
        read = Counter()
        for got, px in zip(webp_batch.decode_streams(streams, read), want, strict=True):
            assert (got == px).all()
        assert read["cache_hits_read"] > 0 and read["references_read"] > 0


def test_a_hit_on_an_empty_slot_is_a_black_clear_pixel():
    w = webp._head(4, 1, True)
    for value, n in ((0, 1), (1, 1), (1, 4), (0, 1)):  # no transform, a cache of two, one group
        w.put(value, n)
    codes = [webp._write_code(w, [int(s in mine) for s in range(a)]).codes() for a, mine in zip((282, 256, 256, 256, 40), ((7, 281), (1,), (2,), (255,), (0,)))]
    for s in (281, 7, 281, 281):
        w.put(*codes[0][s])
    data = webp._file(w.bits())
    stream = data[20 : 20 + int.from_bytes(data[16:20], "little")]
    (other,) = webp_batch.encode_streams(pictures()[:1], 192)
    got = webp_batch.decode_streams([other, stream])[1]
    assert (got == webp.decode(data)).all() and (got[0, 0] == 0).all() and (got[0, 1] == (1, 7, 2, 255)).all()


def test_lengths_of_counts_of_any_size():
    counts = np.array([[3, 0, 1 << 40, 2, 1 << 41], [1, 1, 0, 0, 0]])
    assert webp_batch.code_lengths(counts, 60).tolist() == [[3, 0, 2, 3, 1], [1, 1, 0, 0, 0]]
