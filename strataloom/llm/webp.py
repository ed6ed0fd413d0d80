"""Lossless WebP (VP8L, RFC 9649): a full decoder, and an encoder that can write every feature the decoder reads.

Pixels are (height, width, 4) arrays of red, green, blue and alpha. Images are read symbol by symbol, in plain Python;
``webp_batch`` reads and writes many at once.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)  # fixed by the format
#: Short distance codes: neighbours by distance, then by column, right before left.
_NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))
_HASH = 0x1E35A7BD
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)


class BadImage(ValueError):
    pass


# --- bits ---------------------------------------------------------------------------------------------------------------


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at, self.size = data, 0, 8 * len(data)

    def peek(self, n: int) -> int:
        byte = self.at >> 3
        return (int.from_bytes(self.data[byte : byte + (n >> 3) + 2], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        v = self.peek(n)
        self.at += n
        if self.at > self.size:
            raise BadImage("the data end early")
        return v


class _Writer:
    def __init__(self):
        self.parts: list[np.ndarray] = []

    def put(self, value: int, n: int) -> None:
        self.parts.append(np.array([value >> i & 1 for i in range(n)], np.uint8))

    def bits(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint8)


# --- prefix codes -------------------------------------------------------------------------------------------------------


class Code:
    """A prefix code from the lengths of its symbols' codes."""

    def __init__(self, lengths: list[int]):
        used = [(n, s) for s, n in enumerate(lengths) if n]
        self.lengths = lengths
        self.single = used[0][1] if len(used) == 1 else None
        if not used:
            raise BadImage("an empty prefix code")
        self.table: dict[int, int] | None = None

    def codes(self) -> dict[int, tuple[int, int]]:
        """symbol -> (code with its first bit lowest, length)."""
        if self.single is not None:
            return {self.single: (0, 0)}
        out, code, last = {}, 0, 0
        for n, s in sorted((n, s) for s, n in enumerate(self.lengths) if n):
            code <<= n - last
            last = n
            if code >> n:
                raise BadImage("too many prefix codes")
            out[s] = int(f"{code:0{n}b}"[::-1], 2), n
            code += 1
        if code != 1 << last:
            raise BadImage("an incomplete prefix code")
        return out

    def read(self, r: _Reader) -> int:
        if self.single is not None:
            return self.single
        if self.table is None:
            self.most = max(self.lengths)
            self.table = {}
            for s, (c, n) in self.codes().items():
                for rest in range(1 << (self.most - n)):
                    self.table[c | rest << n] = s << 4 | n
        hit = self.table[r.peek(self.most)]
        r.at += hit & 15
        if r.at > r.size:
            raise BadImage("the data end early")
        return hit >> 4


def _read_code(r: _Reader, alphabet: int) -> Code:
    lengths = [0] * alphabet
    if r.read(1):
        two = r.read(1)
        first = r.read(8 if r.read(1) else 1)
        both = [first] + ([r.read(8)] if two else [])
        if max(both) >= alphabet:
            raise BadImage("a symbol past its alphabet")
        for s in both:
            lengths[s] = 1
        return Code(lengths)
    meta = [0] * 19
    for i in range(4 + r.read(4)):
        meta[_ORDER[i]] = r.read(3)
    left = alphabet
    if r.read(1):
        left = 2 + r.read(2 + 2 * r.read(3))
        if left > alphabet:
            raise BadImage("more code lengths than symbols")
    code, at, last = Code(meta), 0, 8
    while at < alphabet and left:
        left -= 1
        s = code.read(r)
        if s < 16:
            lengths[at] = s
            at += 1
            last = s or last
            continue
        n, v = (3 + r.read(2), last) if s == 16 else (3 + r.read(3), 0) if s == 17 else (11 + r.read(7), 0)
        if at + n > alphabet:
            raise BadImage("more code lengths than symbols")
        lengths[at : at + n] = [v] * n
        at += n
    return Code(lengths)


def _huffman(counts: list[int], most: int = 15) -> list[int]:
    """Lengths of an optimal code, kept within ``most`` by raising small counts."""
    used = [s for s, c in enumerate(counts) if c]
    lengths = [0] * len(counts)
    if len(used) < 2:
        for s in used or [0]:
            lengths[s] = 1
        return lengths
    floor = 1
    while True:
        heap = [(max(counts[s], floor), s, (s,)) for s in used]
        heapq.heapify(heap)
        depth = dict.fromkeys(used, 0)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in (*a[2], *b[2]):
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(depth.values()) <= most:
            for s, n in depth.items():
                lengths[s] = n
            return lengths
        floor *= 2


def _write_code(w: _Writer, lengths: list[int]) -> Code:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and max(used, default=0) < 256:
        used = used or [0]
        w.put(1, 1)
        w.put(len(used) - 1, 1)
        w.put(1, 1)
        for s in used:
            w.put(s, 8)
        return Code([int(s in used) for s in range(len(lengths))])
    tokens, i, last = [], 0, 8
    while i < len(lengths):
        n, v = 1, lengths[i]
        while i + n < len(lengths) and lengths[i + n] == v:
            n += 1
        i += n
        if v and v != last:
            tokens.append((v, 0, 0))
            n, last = n - 1, v
        while n:
            if v == 0 and n >= 11:
                k = min(n, 138)
                tokens.append((18, k - 11, 7))
            elif n >= 3:
                k = min(n, 10 if v == 0 else 6)
                tokens.append((17, k - 3, 3) if v == 0 else (16, k - 3, 2))
            else:
                k = 1
                tokens.append((v, 0, 0))
            n -= k
    counts = [0] * 19
    for t, _, _ in tokens:
        counts[t] += 1
    meta = _huffman(counts, 7)
    n = max(i for i in range(19) if meta[_ORDER[i]] or i < 4) + 1
    w.put(0, 1)
    w.put(n - 4, 4)
    for i in range(n):
        w.put(meta[_ORDER[i]], 3)
    w.put(0, 1)
    codes = Code(meta).codes()
    for t, extra, bits in tokens:
        w.put(*codes[t])
        w.put(extra, bits)
    return Code(lengths)


# --- entropy-coded images -----------------------------------------------------------------------------------------------


def _span(prefix: int, r: _Reader) -> int:
    if prefix < 4:
        return prefix + 1
    extra = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << extra) + r.read(extra) + 1


def _prefix(value: int) -> tuple[int, int, int]:
    """(prefix, extra bits' value, number of extra bits) of a length or distance."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    top = v.bit_length() - 1
    half = v >> (top - 1) & 1
    return 2 * top + half, v - ((2 + half) << (top - 1)), top - 1


def _read_image(r: _Reader, width: int, height: int, main: bool) -> np.ndarray:
    """Pixels as integers 0xAARRGGBB."""
    cache_bits = r.read(4) if r.read(1) else 0
    if cache_bits > 11:
        raise BadImage("too large a colour cache")
    groups_at, group_bits, n_groups = None, 0, 1
    if main and r.read(1):
        group_bits = r.read(3) + 2
        across = (width + (1 << group_bits) - 1) >> group_bits
        down = (height + (1 << group_bits) - 1) >> group_bits
        groups_at = (_read_image(r, across, down, False) >> 8 & 0xFFFF).tolist()
        n_groups = max(groups_at) + 1
    cache_size = 1 << cache_bits if cache_bits else 0
    groups = [[_read_code(r, a) for a in (280 + cache_size, 256, 256, 256, 40)] for _ in range(n_groups)]
    total = width * height
    out, cache, i, cached = [0] * total, [0] * cache_size, 0, 0
    green, red, blue, alpha, distance = groups[0]
    while i < total:
        if groups_at is not None:
            y, x = divmod(i, width)
            green, red, blue, alpha, distance = groups[groups_at[(y >> group_bits) * across + (x >> group_bits)]]
        s = green.read(r)
        if s < 256:
            out[i] = red.read(r) << 16 | s << 8 | blue.read(r) | alpha.read(r) << 24
            i += 1
        elif s < 280:
            n = _span(s - 256, r)
            d = _span(distance.read(r), r)
            if d > 120:
                d -= 120
            else:
                x, y = _NEAR[d - 1]
                d = max(1, x + y * width)
            if d > i or i + n > total:
                raise BadImage("a back-reference past the image")
            for k in range(i, i + n):
                out[k] = out[k - d]
            i += n
        else:
            while cached < i:
                p = out[cached]
                cache[(p * _HASH & 0xFFFFFFFF) >> (32 - cache_bits)] = p
                cached += 1
            out[i] = cache[s - 280]
            i += 1
    return np.array(out, np.uint32)


def _write_image(w: _Writer, argb: np.ndarray, width: int, main: bool, cache_bits: int = 0, refs: bool = False, groups_bits: int = 0) -> None:
    w.put(cache_bits > 0, 1)
    if cache_bits:
        w.put(cache_bits, 4)
    px, height = argb.tolist(), len(argb) // width
    group = [0] * len(px)
    if main:
        w.put(groups_bits > 0, 1)
        if groups_bits:
            across, down = (width + (1 << groups_bits) - 1) >> groups_bits, (height + (1 << groups_bits) - 1) >> groups_bits
            tiles = np.arange(across * down) % 2
            w.put(groups_bits - 2, 3)
            _write_image(w, (tiles.astype(np.uint32) << 8), across, False)
            group = [int(tiles[((i // width) >> groups_bits) * across + ((i % width) >> groups_bits)]) for i in range(len(px))]
    tokens, cache, seen, i = [], {}, {}, 0
    near = {max(1, x + y * width): k + 1 for k, (x, y) in reversed(list(enumerate(_NEAR)))}
    while i < len(px):
        n, d = 0, 0
        if refs and i + 2 < len(px):
            at = seen.get(tuple(px[i : i + 3]))
            if at is not None:
                d = i - at
                while i + n < len(px) and n < 4096 and px[i + n] == px[i + n - d]:
                    n += 1
        if n >= 3:
            tokens.append(("ref", n, near.get(d, d + 120), i))
        else:
            n = 1
            h = (px[i] * _HASH & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else 0
            tokens.append(("cache", h, 0, i) if cache_bits and cache.get(h) == px[i] else ("pixel", px[i], 0, i))
        for k in range(i, i + n):
            seen[tuple(px[k : k + 3])] = k
            if cache_bits:
                cache[(px[k] * _HASH & 0xFFFFFFFF) >> (32 - cache_bits)] = px[k]
        i += n
    size = 280 + (1 << cache_bits if cache_bits else 0)
    counts = [[[0] * a for a in (size, 256, 256, 256, 40)] for _ in range(max(group, default=0) + 1)]
    for kind, v, d, at in tokens:
        c = counts[group[at]]
        if kind == "pixel":
            for k, s in enumerate((v >> 8 & 255, v >> 16 & 255, v & 255, v >> 24)):
                c[k][s] += 1
        elif kind == "ref":
            c[0][256 + _prefix(v)[0]] += 1
            c[4][_prefix(d)[0]] += 1
        else:
            c[0][280 + v] += 1
    codes = [[_write_code(w, _huffman(c)).codes() for c in five] for five in counts]
    for kind, v, d, at in tokens:
        c = codes[group[at]]
        if kind == "pixel":
            for k, s in enumerate((v >> 8 & 255, v >> 16 & 255, v & 255, v >> 24)):
                w.put(*c[k][s])
        elif kind == "ref":
            for k, (p, extra, bits), base in ((0, _prefix(v), 256), (4, _prefix(d), 0)):
                w.put(*c[k][base + p])
                w.put(extra, bits)
        else:
            w.put(*c[0][280 + v])


# --- transforms ---------------------------------------------------------------------------------------------------------


def _parts(argb: np.ndarray) -> np.ndarray:
    """(..., 4) signed components: alpha, red, green, blue."""
    return np.stack([argb >> np.uint32(s) & np.uint32(255) for s in (24, 16, 8, 0)], axis=-1).astype(np.int32)


def _whole(parts: np.ndarray) -> np.ndarray:
    p = (parts & 255).astype(np.uint32)
    return p[..., 0] << np.uint32(24) | p[..., 1] << np.uint32(16) | p[..., 2] << np.uint32(8) | p[..., 3]


def _predict(mode: int, left, top, top_left, top_right):
    """A pixel's components from its neighbours', by mode."""
    mean = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b, strict=True)]
    clamp = lambda v: 0 if v < 0 else 255 if v > 255 else v
    if mode == 0 or mode > 13:
        return [255, 0, 0, 0]
    if mode < 5:
        return (left, top, top_right, top_left)[mode - 1]
    if mode == 5:
        return mean(mean(left, top_right), top)
    if mode < 10:
        return mean(*((left, top_left), (left, top), (top_left, top), (top, top_right))[mode - 6])
    if mode == 10:
        return mean(mean(left, top_left), mean(top, top_right))
    if mode == 11:  # whichever of left and top is nearer to left + top - top left
        by_left = sum(abs(t - c) for t, c in zip(top, top_left, strict=True))
        by_top = sum(abs(x - c) for x, c in zip(left, top_left, strict=True))
        return left if by_left < by_top else top
    if mode == 12:
        return [clamp(x + t - c) for x, t, c in zip(left, top, top_left, strict=True)]
    m = mean(left, top)
    return [clamp(a + int((a - c) / 2)) for a, c in zip(m, top_left, strict=True)]


def _predictor(px: list, width: int, height: int, bits: int, modes: list[int], invert: bool) -> list:
    """Add (or, for writing, subtract) predictions; px holds lists of four components by row."""
    across = (width + (1 << bits) - 1) >> bits
    out = []
    for i, p in enumerate(px):
        y, x = divmod(i, width)
        src = out if invert else px
        if i == 0:
            guess = [255, 0, 0, 0]
        elif y == 0:
            guess = src[i - 1]
        elif x == 0:
            guess = src[i - width]
        else:
            guess = _predict(modes[(y >> bits) * across + (x >> bits)], src[i - 1], src[i - width], src[i - width - 1], src[i - width + 1])
        out.append([(a + b if invert else a - b) & 255 for a, b in zip(p, guess, strict=True)])
    return out


def _cross(argb: np.ndarray, width: int, height: int, bits: int, blocks: np.ndarray, invert: bool) -> np.ndarray:
    """Add (subtract) what green explains of red and blue, and red of blue."""
    across = (width + (1 << bits) - 1) >> bits
    y, x = np.divmod(np.arange(width * height), width)
    signed = lambda v: (v & 255).astype(np.int8).astype(np.int32)
    m = _parts(blocks)[(y >> bits) * across + (x >> bits)]
    green_red, green_blue, red_blue = signed(m[:, 3]), signed(m[:, 2]), signed(m[:, 1])
    p, sign = _parts(argb), 1 if invert else -1
    old_red = p[:, 1].copy()
    p[:, 1] += sign * (green_red * signed(p[:, 2]) >> 5)
    red = p[:, 1] if invert else old_red
    p[:, 3] += sign * (green_blue * signed(p[:, 2]) >> 5) + sign * (red_blue * signed(red) >> 5)
    return _whole(p)


def _green(argb: np.ndarray, sign: int) -> np.ndarray:
    p = _parts(argb)
    p[:, 1] += sign * p[:, 2]
    p[:, 3] += sign * p[:, 2]
    return _whole(p)


def _palette_bits(size: int) -> int:
    return 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0


# --- files --------------------------------------------------------------------------------------------------------------


def _chunks(data: bytes, at: int, end: int):
    while at + 8 <= end:
        name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
        yield name, data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)


def parts_of(data: bytes) -> tuple[tuple[int, int] | None, list[tuple[int, int, bytes]]]:
    """((width, height) of the canvas, if the file has one, and (x, y, stream) of its lossless images)."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise BadImage("not a WebP file")
    canvas, found = None, []
    three = lambda b, k: int.from_bytes(b[k : k + 3], "little")
    for name, body in _chunks(data, 12, min(len(data), 8 + int.from_bytes(data[4:8], "little"))):
        if name == b"VP8X":
            canvas = three(body, 4) + 1, three(body, 7) + 1
        elif name == b"VP8L":
            found.append((0, 0, body))
        elif name == b"ANMF":
            found += [(2 * three(body, 0), 2 * three(body, 3), b) for n, b in _chunks(body, 16, len(body)) if n == b"VP8L"]
    if not found:
        raise BadImage("no lossless image")
    return canvas, found


def compose(canvas: tuple[int, int] | None, at: list[tuple[int, int]], images: list[np.ndarray]) -> np.ndarray:
    """The canvas once all frames are drawn, none of them blended; without a canvas the only image."""
    if canvas is None:
        return images[0]
    out = np.zeros((canvas[1], canvas[0], 4), np.uint8)
    for (x, y), px in zip(at, images, strict=True):
        if y + len(px) > canvas[1] or x + px.shape[1] > canvas[0]:
            raise BadImage("a frame past the canvas")
        out[y : y + len(px), x : x + px.shape[1]] = px
    return out


def decode(data: bytes) -> np.ndarray:
    """(height, width, 4) red, green, blue and alpha of a lossless WebP file; of an animation, its last state."""
    canvas, found = parts_of(data)
    return compose(canvas, [(x, y) for x, y, _ in found], [_decode_stream(b) for _, _, b in found])


def _decode_stream(data: bytes) -> np.ndarray:
    r = _Reader(data)
    if r.read(8) != 0x2F:
        raise BadImage("no lossless signature")
    width, height, _ = r.read(14) + 1, r.read(14) + 1, r.read(1)
    if r.read(3):
        raise BadImage("unknown version")
    across, todo, met = width, [], set()
    while r.read(1):
        kind = r.read(2)
        if kind in met:
            raise BadImage("a transform twice")
        met.add(kind)
        if kind == PALETTE:
            size = r.read(8) + 1
            table = _whole(np.cumsum(_parts(_read_image(r, size, 1, False)), axis=0))
            todo.append((kind, across, _palette_bits(size), table))
            across = (across + (1 << _palette_bits(size)) - 1) >> _palette_bits(size)
        elif kind == SUBTRACT_GREEN:
            todo.append((kind, across, 0, None))
        else:
            bits = r.read(3) + 2
            side = lambda n: (n + (1 << bits) - 1) >> bits  # noqa: B023, E731
            todo.append((kind, across, bits, _read_image(r, side(across), side(height), False)))
    argb = _read_image(r, across, height, True)
    for kind, wide, bits, extra in reversed(todo):
        if kind == SUBTRACT_GREEN:
            argb = _green(argb, 1)
        elif kind == CROSS_COLOUR:
            argb = _cross(argb, wide, height, bits, extra, True)
        elif kind == PREDICTOR:
            modes = (extra >> np.uint32(8) & np.uint32(15)).tolist()
            argb = _whole(np.array(_predictor(_parts(argb).tolist(), wide, height, bits, modes, True)))
        else:
            index = (argb >> np.uint32(8) & np.uint32(255)).reshape(height, -1)
            if bits:
                each = 8 >> bits
                index = (index[:, :, None] >> (np.arange(1 << bits, dtype=np.uint32) * each) & ((1 << each) - 1)).reshape(height, -1)[:, :wide]
            table = np.concatenate([extra, np.zeros(256, np.uint32)])[:256]
            argb = table[index.ravel()]
    p = _parts(argb).astype(np.uint8).reshape(height, width, 4)
    return p[:, :, [1, 2, 3, 0]]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def still(stream: bytes) -> bytes:
    """A file of one image."""
    chunk = _chunk(b"VP8L", stream)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk


def stack(streams: list[bytes], width: int, heights: list[int]) -> bytes:
    """A file whose frames, none of them blended or taken off again, lie below each other on one canvas."""
    three = lambda v: v.to_bytes(3, "little")
    out, y = [_chunk(b"ANIM", b"\0" * 6)], 0
    for s, h in zip(streams, heights, strict=True):
        out.append(_chunk(b"ANMF", three(0) + three(y // 2) + three(width - 1) + three(h - 1) + three(1) + b"\2" + _chunk(b"VP8L", s)))
        y += h
    body = b"WEBP" + _chunk(b"VP8X", b"\2\0\0\0" + three(width - 1) + three(y - 1)) + b"".join(out)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def _file(bits: np.ndarray) -> bytes:
    return still(np.packbits(bits, bitorder="little").tobytes())


def _head(width: int, height: int, alpha: bool) -> _Writer:
    w = _Writer()
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(alpha, 1)
    w.put(0, 3)
    return w


def encode(pixels: np.ndarray, transforms: tuple = (), bits: int = 3, cache_bits: int = 0, refs: bool = False, groups_bits: int = 0, seed: int = 0) -> bytes:
    """A lossless WebP file by the transforms and coding means named; block modes and factors are drawn by ``seed``."""
    height, width, _ = pixels.shape
    argb = _whole(pixels[:, :, [3, 0, 1, 2]].astype(np.int32).reshape(-1, 4))
    w, wide, rng = _head(width, height, bool((pixels[:, :, 3] != 255).any())), width, np.random.default_rng(seed)
    for kind in transforms:
        w.put(1, 1)
        w.put(kind, 2)
        across, down = (wide + (1 << bits) - 1) >> bits, (height + (1 << bits) - 1) >> bits
        if kind == SUBTRACT_GREEN:
            argb = _green(argb, -1)
        elif kind == PALETTE:
            table, index = np.unique(argb, return_inverse=True)
            if len(table) > 256:
                raise ValueError("too many colours for a palette")
            w.put(len(table) - 1, 8)
            steps = _parts(table)
            steps[1:] -= steps[:-1].copy()
            _write_image(w, _whole(steps), len(table), False)
            shrink = _palette_bits(len(table))
            rows = index.reshape(height, wide)
            wide = (wide + (1 << shrink) - 1) >> shrink
            padded = np.zeros((height, wide << shrink), np.uint32)
            padded[:, : rows.shape[1]] = rows
            each = padded.reshape(height, wide, 1 << shrink) << (np.arange(1 << shrink, dtype=np.uint32) * np.uint32(8 >> shrink))
            argb = (np.bitwise_or.reduce(each, axis=2).ravel() << np.uint32(8) | np.uint32(0xFF000000)).astype(np.uint32)
        else:
            w.put(bits - 2, 3)
            if kind == PREDICTOR:
                blocks = (rng.integers(0, 14, across * down).astype(np.uint32) << np.uint32(8)) | np.uint32(0xFF000000)
                _write_image(w, blocks, across, False)
                modes = (blocks >> np.uint32(8) & np.uint32(15)).tolist()
                argb = _whole(np.array(_predictor(_parts(argb).tolist(), wide, height, bits, modes, False)))
            else:
                blocks = rng.integers(0, 1 << 24, across * down).astype(np.uint32) | np.uint32(0xFF000000)
                _write_image(w, blocks, across, False)
                argb = _cross(argb, wide, height, bits, blocks, False)
    w.put(0, 1)
    _write_image(w, argb, wide, True, cache_bits, refs, groups_bits)
    return _file(w.bits())
