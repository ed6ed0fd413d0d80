import base64

import numpy as np
import pytest

from strataloom.llm import webp


def image(h, w, colours, seed=0):
    rng = np.random.default_rng(seed)
    table = rng.integers(0, 256, (colours, 4), dtype=np.uint8)
    out = table[rng.integers(0, colours, (h, w))]
    out[h // 2 :, : w // 2] = out[: h - h // 2, : w // 2]  # something to refer back to
    return out


def test_known_file():
    data = base64.b64decode("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA==")
    assert webp.decode(data).shape == (1, 1, 4)


@pytest.mark.parametrize("colours", [1, 2, 4, 13, 40, 5000])
@pytest.mark.parametrize("how", [{}, {"refs": True}, {"cache_bits": 5}, {"refs": True, "cache_bits": 11}, {"groups_bits": 2, "refs": True}])
def test_coding_round_trip(colours, how):
    px = image(17, 23, colours)
    assert (webp.decode(webp.encode(px, **how)) == px).all()


@pytest.mark.parametrize("kinds", [(k,) for k in range(4)] + [(2, 0), (0, 1, 2), (3, 0), (1, 0), (3, 2, 1, 0)])
@pytest.mark.parametrize("colours", [2, 3, 16, 200])
def test_transforms_round_trip(kinds, colours):
    px = image(19, 21, colours, 3)
    assert (webp.decode(webp.encode(px, kinds, bits=2, refs=True, cache_bits=3, seed=5)) == px).all()


def test_frames_lie_on_one_canvas():
    px = image(9, 12, 300)
    stream = lambda p: (f := webp.encode(p, refs=True))[20 : 20 + int.from_bytes(f[16:20], "little")]
    data = webp.stack([stream(px[i : i + 4]) for i in (0, 4, 8)], 12, [4, 4, 1])
    assert (webp.decode(data) == px).all()


def test_broken_files_are_refused():
    data = webp.encode(image(9, 9, 50))
    for bad in (b"", data[:30], b"JUNK" + data[4:], data[:12] + b"VP8 " + data[16:]):
        with pytest.raises((webp.BadImage, KeyError)):
            webp.decode(bad)
