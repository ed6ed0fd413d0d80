"""Lossless WebP for many images at once: every numpy pass handles one step of all of them.

Images of texts are small and many. Writing is free of loops over pixels. Reading is a loop over the symbols of the longest
image in which each step decodes one symbol of every image; what back-references and cache hits stand for is then found for
all of them at once, and transforms are inverted (the predictor by diagonals, of all images together). What this reader doesn't
take (several groups of prefix codes, codes longer than ``BITS``, cache hits on slots still empty) goes to the plain reader in
``webp``, which also checks this one in tests.

Written are, by image: a palette where it pays, with pixels bundled if there are few colours; then, for every image but
noise, of any size, predictor and cross-colour transforms, each tile by the modes and factors that cost it least; a colour
cache where it is hit, and back-references of three pixels or more.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np

from strataloom.llm.webp import _HASH, _NEAR, _ORDER, CROSS_COLOUR, PALETTE, PREDICTOR, SUBTRACT_GREEN, BadImage, _decode_stream, _palette_bits, _prefix

BITS = 11  # longest prefix code written, and read in step
CACHE_BITS = 7
TILE = 5  # tiles of 32 pixels for modes and factors
PIECE = 1 << 14  # pixels whose modes are tried at once, to stay in a core's cache
_U = np.uint64
_NEAR_X, _NEAR_Y = np.array(_NEAR).T
_ALPHABETS = (280, 256, 256, 256, 40)
_OPAQUE = np.uint32(0xFF000000)

# --- bits ---------------------------------------------------------------------------------------------------------------


def _order(key: np.ndarray) -> np.ndarray:
    """Stable order of keys below 2**32; a plain sort of keys with their places is much the fastest."""
    return (np.sort(key.astype(_U) << _U(32) | np.arange(len(key), dtype=_U)) & _U(0xFFFFFFFF)).astype(np.int64)


def _cells(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, symbol, length) of the lengths that aren't zero, in order; np.nonzero of rows is slower."""
    flat = np.ascontiguousarray(lengths).ravel()
    spot = np.flatnonzero(flat)
    r = spot // lengths.shape[1]
    return r, spot - r * lengths.shape[1], flat[spot].astype(np.int64)


def _reverse(v: np.ndarray, n) -> np.ndarray:
    """The low n (at most 16) bits of v in reverse."""
    v = v.astype(np.uint32)
    for s, m in ((1, 0x5555), (2, 0x3333), (4, 0x0F0F), (8, 0x00FF)):
        v = (v >> np.uint32(s)) & np.uint32(m) | (v & np.uint32(m)) << np.uint32(s)
    return v >> (16 - np.asarray(n)).astype(np.uint32)


def pack_bits(parts: list[tuple], streams: int) -> list[bytes]:
    """Streams' bytes from parts that follow each other: (stream, value, size) by stream, of ``size`` bits (64 at most), low bits first."""
    many = [np.bincount(stream, weights=size, minlength=streams).astype(np.int64) for stream, _, size in parts]
    bits = sum(many)
    words = (bits + 63) // 64
    base = np.cumsum(words) - words
    out, at = np.zeros(int(words.sum()) + 2, _U), base * 64
    for (stream, value, size), n in zip(parts, many, strict=True):
        pos = np.cumsum(size)
        pos -= size
        pos += (at - np.cumsum(n) + n)[stream]
        low = pos & 63
        word = pos >> 6
        shift = low.view(_U)
        head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])[: len(word)])
        out[word[head]] |= np.bitwise_or.reduceat(value << shift, head)
        over = np.flatnonzero(low + size > 64)
        out[word[over] + 1] |= value[over] >> (_U(64) - shift[over])
        at = at + n
    raw = out.tobytes()
    return [raw[8 * b : 8 * b + (n + 7) // 8] for b, n in zip(base.tolist(), bits.tolist(), strict=True)]


# --- prefix codes -------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = BITS) -> np.ndarray:
    """Lengths of optimal codes for each row of counts, kept within ``most`` by raising small counts. One symbol has length 1."""
    out = (counts > 0).astype(np.uint8)
    todo, floor = np.flatnonzero(out.sum(axis=1, dtype=np.int64) > 1), 1
    while len(todo):
        c = np.where(counts[todo] > 0, np.maximum(counts[todo], floor), 0)
        got = _optimal(c)
        out[todo] = got
        todo, floor = todo[got.max(axis=1) > most], 2 * floor
    return out


def _optimal(counts: np.ndarray) -> np.ndarray:
    r, s, c = _cells(counts)
    used = np.bincount(r, minlength=len(counts))
    rank = np.argsort(-used, kind="stable")
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    r, used = place[r], used[rank]
    if int(c.max()) < 1 << 34 and len(used) < 1 << 17 and counts.shape[1] <= 1 << 12:
        key = np.sort(r << 46 | c << 12 | s)  # by row, lightest first
        r, s, c = key >> 46, key & 0xFFF, key >> 12 & (1 << 34) - 1
    else:
        order = np.lexsort((s, c, r))
        r, s, c = r[order], s[order], c[order]
    k, n_rows, far = max(int(used[0]), 2), len(used), np.int64(1) << 60
    rows, column = np.arange(n_rows), np.arange(len(r)) - np.repeat(np.cumsum(used) - used, used)
    leaf, node = np.full((2, n_rows, k + 1), far)
    leaf[r, column] = c
    leaves, nodes = leaf.ravel(), node.ravel()
    at_leaf = rows * (k + 1)
    at_node = at_leaf.copy()
    live = np.searchsorted(-used, -np.arange(2, k + 1), "right")  # rows with at least t + 2 symbols
    from_leaf = np.zeros((n_rows, 2 * (k - 1)), bool)
    for t in range(k - 1):  # the two lightest of each row's leaves and nodes are joined
        n, total = live[t], 0
        for turn in (2 * t, 2 * t + 1):
            x, y = leaves.take(at_leaf[:n]), nodes.take(at_node[:n])
            first = x <= y
            from_leaf[:n, turn] = first
            total = total + np.minimum(x, y)
            at_leaf[:n] += first
            at_node[:n] += ~first
        node[:n, t] = total
    taken = np.arange(2 * (k - 1)) < 2 * (used[:, None] - 1)

    def above(picks):
        """Which node each leaf or node, in their order, goes to: as the node's place among rows of equal numbers."""
        spot = np.flatnonzero(picks)
        r = spot // picks.shape[1]
        many = np.bincount(r, minlength=n_rows)
        return r, np.arange(len(r)) - np.repeat(np.cumsum(many) - many, many), ((spot - r * picks.shape[1]) >> 1) * n_rows + r

    up, depth = np.zeros((k, n_rows), np.int64), np.zeros((k, n_rows), np.int64)
    of, which, parent = above(taken & ~from_leaf)
    up[which, of] = parent
    depths = depth.ravel()
    for t in range(k - 3, -1, -1):
        n = live[t + 1]
        depth[t, :n] = depths.take(up[t, :n]) + 1
    _, _, parent = above(from_leaf)  # in the order of the leaves
    out = np.zeros(counts.shape, np.uint8)
    out[rank[r], s] = np.minimum(depths.take(parent) + 1, 255)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by symbol, first bit lowest."""
    out = np.zeros(lengths.shape, np.uint32)
    r, s, n = _cells(lengths)
    most = int(n.max(initial=1))
    key = np.sort(r << 16 | n << 12 | s)
    r, n, s = key >> 16, key >> 12 & 0xF, key & 0xFFF
    room = 1 << (most - n)  # of the longest codes' room, what a code takes
    before = np.cumsum(room) - room
    heads = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])[: len(r)])
    before -= np.repeat(before[heads], np.diff(np.append(heads, len(r))))
    out[r, s] = _reverse(before >> (most - n), n)
    return out


#: Lengths are written with a flat code of 4 bits for 0 to 12, and for repeats (16) and runs of zeros (17 and 18).
_META = [*range(13), 16, 17, 18]
_META_CODE = {s: int(_reverse(np.array([k]), 4)[0]) for k, s in enumerate(_META)}
_META_HEAD = (0 | (19 - 4) << 1 | sum((4 * (s in _META)) << 5 + 3 * i for i, s in enumerate(_ORDER)), 5 + 57 + 1)


def _zeros(n: int) -> tuple[int, int]:
    v = size = 0
    while n:
        k = min(n, 138) if n >= 11 else min(n, 10) if n >= 3 else 1
        token = (18, k - 11, 7) if k >= 11 else (17, k - 3, 3) if k >= 3 else (0, 0, 0)
        v |= (_META_CODE[token[0]] | token[1] << 4) << size
        size += 4 + token[2]
        n -= k
    return v, size


_GAP, _GAP_SIZE = (np.array(c) for c in zip(*map(_zeros, range(280 + (1 << CACHE_BITS) + 1)), strict=True))
_GAP = _GAP.astype(_U)
_LENGTH = np.array([_META_CODE.get(n, 0) for n in range(13)], _U)


def _code_tokens(lengths: np.ndarray, sizes: np.ndarray):
    """(row, value, bits) that write each row's code; ``sizes`` are the alphabets."""
    r, s, n = _cells(lengths)
    many = np.bincount(r, minlength=len(lengths))
    only = np.zeros(len(lengths), bool)
    only[r] = (many[r] == 1) & (s < 256)
    first, one = np.full(len(lengths), -1), only[r]
    first[r[one]] = s[one]
    simple = np.flatnonzero(only)
    r, s, n = r[~one], s[~one], n[~one]
    prev = np.concatenate([[-1], s[:-1]])
    prev[np.concatenate([[True], r[1:] != r[:-1]])[: len(r)]] = -1
    gap = s - prev - 1
    whole = np.flatnonzero(~only)
    last = np.full(len(lengths), -1)
    last[r] = s
    end = (sizes - last - 1)[whole]
    row = np.concatenate([simple, whole, r, whole])
    step = np.concatenate([np.zeros(len(simple) + len(whole), np.int64), np.ones(len(r), np.int64), np.full(len(whole), 2)])
    value = np.concatenate([(first[simple].astype(_U) << _U(3)) | _U(5), np.full(len(whole), _META_HEAD[0], _U), _GAP[gap] | _LENGTH[n] << _GAP_SIZE[gap].astype(_U), _GAP[end]])
    size = np.concatenate([np.full(len(simple), 11), np.full(len(whole), _META_HEAD[1]), _GAP_SIZE[gap] + 4, _GAP_SIZE[end]])
    order = _order(row * 4 + step)
    return row[order], value[order], size[order]


# --- writing entropy-coded images ---------------------------------------------------------------------------------------

_PREFIX, _EXTRA, _EXTRA_SIZE = (np.array(c) for c in zip((0, 0, 0), *(_prefix(v) for v in range(1, 1 << 13)), strict=True))


def _span_code(v: np.ndarray):
    """(prefix, extra bits' value, their number) of lengths or distances of any size."""
    if v.max(initial=0) < len(_PREFIX):
        return _PREFIX[v], _EXTRA[v], _EXTRA_SIZE[v]
    u = v - 1
    top = np.maximum(np.floor(np.log2(np.maximum(u, 1))).astype(np.int64), 1)
    half = u >> (top - 1) & 1
    small = u < 4
    return np.where(small, u, 2 * top + half), np.where(small, 0, u - ((2 + half) << (top - 1))), np.where(small, 0, top - 1)


def _near_codes(width: int) -> np.ndarray:
    """Distance in pixels -> its code, for an image's width."""
    d = np.maximum(1, _NEAR_X + _NEAR_Y * width)
    out = np.arange(8 * width + 9) + 120
    for k in range(len(d) - 1, -1, -1):
        if d[k] < len(out):
            out[d[k]] = k + 1
    return out


def _references(px: np.ndarray, image: np.ndarray, start: np.ndarray):
    """(place, length, distance) of back-references of three pixels or more; they don't overlap."""
    n = len(px)
    if n < 4:
        return (np.zeros(0, np.int64),) * 3
    a = px.astype(_U)
    key = (image[:-2].astype(_U) * _U(0x9E3779B97F4A7C15)) ^ (a[:-2] * _U(0xD6E8FEB86659FD93)) ^ (a[1:-1] * _U(0xC2B2AE3D27D4EB4F)) ^ (a[2:] * _U(0x165667B19E3779F9))
    key >>= _U(32)
    order = _order(key)
    before = np.full(n, -1)
    same = key[order[1:]] == key[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    at = np.flatnonzero(before >= 0)
    b = before[at]
    ok = (image[at] == image[b]) & (image[at + 2] == image[at]) & (image[b + 2] == image[b])
    for k in range(3):
        ok &= px[at + k] == px[b + k]
    at, d = at[ok], (at - b)[ok]
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (d[1:] != d[:-1])]))
    first, end = at[head], at[np.append(head[1:], len(at)) - 1] + 3
    begin = np.maximum(first, np.concatenate([[0], np.maximum.accumulate(end)[:-1]]))
    keep = end - begin >= 3
    return begin[keep], (end - begin)[keep], d[head][keep]


def _cache_hits(px: np.ndarray, image: np.ndarray):
    """(hit, slot): whether a pixel is what the cache of its image holds in its slot when it comes up."""
    slot = (px * np.uint32(_HASH)) >> np.uint32(32 - CACHE_BITS)
    order = _order(image * (1 << CACHE_BITS) + slot.astype(np.int64))
    hit = np.zeros(len(px), bool)
    i, j = order[:-1], order[1:]
    hit[j] = (image[i] == image[j]) & (px[i] == px[j])
    return hit, slot.astype(np.int64)


def code_images(px: np.ndarray, sizes: np.ndarray, widths: np.ndarray, main: bool, used: Counter):
    """Tokens of images that lie one after the other in ``px``: (image, step, value, bits) ahead of the pixels, (image, value, bits) of these."""
    m = len(sizes)
    image = np.repeat(np.arange(m), sizes)
    start = np.cumsum(sizes) - sizes
    place, length, distance = _references(px, image, start)
    covered = np.zeros(len(px) + 1, np.int8)
    covered[place] += 1
    covered[place + length] -= 1
    inside = np.cumsum(covered[:-1], dtype=np.int8) > 0
    hit, slot = _cache_hits(px, image)
    hit &= ~inside
    cached = main & (np.bincount(image[hit], minlength=m) * 20 >= sizes)
    hit &= cached[image]
    lit = np.flatnonzero(~inside & ~hit)
    hits = np.flatnonzero(hit)
    used.update(images_with_cache=int(cached.sum()), cache_hits=len(hits), references=len(place), literals=len(lit))
    near, code = {}, np.zeros(len(place), np.int64)
    for w in np.unique(widths[image[place]]).tolist() if len(place) else ():
        near[w] = _near_codes(w)
        mine = widths[image[place]] == w
        d = distance[mine]
        code[mine] = np.where(d < len(near[w]), near[w][np.minimum(d, len(near[w]) - 1)], d + 120)
    lp, lx, ln = _span_code(length)
    dp, dx, dn = _span_code(code)
    alphabet = 280 + (1 << CACHE_BITS)
    written, of, by = px[lit].view(np.uint8).reshape(-1, 4), image[lit], image[place]
    parts = [of * (256 if k else alphabet) + written[:, s] for k, s in enumerate((1, 2, 0, 3))]
    runs, cache_slots, reach = by * alphabet + 256 + lp, image[hits] * alphabet + 280 + slot[hits], by * 40 + dp
    green = sum(np.bincount(v, minlength=m * alphabet) for v in (parts[0], runs, cache_slots)).reshape(m, alphabet)
    others = [np.bincount(p, minlength=m * 256).reshape(m, 256) for p in parts[1:]]
    far = np.bincount(reach, minlength=m * 40).reshape(m, 40)
    tokens, codes = [(np.arange(m), np.zeros(m, np.int64), np.where(cached, 1 | CACHE_BITS << 1, 0).astype(_U), np.where(cached, 5, 1) + main)], []
    for k, counts in enumerate((green, *others, far)):
        counts[counts.sum(axis=1) == 0, 0] = 1
        lengths = code_lengths(counts)
        row, value, size = _code_tokens(lengths, np.full(m, _ALPHABETS[k]) + (cached << CACHE_BITS if k == 0 else 0))
        tokens.append((row, np.full(len(row), k + 1), value, size))
        several = np.flatnonzero((lengths > 0).sum(axis=1) > 1)
        both = np.zeros(lengths.shape, np.uint16)
        both[several] = canonical(lengths[several]) << np.uint32(4) | lengths[several]
        codes.append(both.ravel() if len(several) else None)  # none: no symbol takes bits

    def join(pairs, n):
        value, size = np.zeros((2, n), np.int64)
        for v, k in pairs:
            value |= v << size
            size += k
        return value, size

    def coded(k, spot):
        if codes[k] is not None:
            both = codes[k].take(spot).astype(np.int64)
            yield both >> 4, both & 15

    value, size = np.zeros((2, len(px)), np.int64)
    value[lit], size[lit] = join((c for k, p in enumerate(parts) for c in coded(k, p)), len(lit))
    value[hits], size[hits] = join(coded(0, cache_slots), len(hits))
    value[place], size[place] = join([*coded(0, runs), (lx, ln), *coded(4, reach), (dx, dn)], len(place))
    spot = np.flatnonzero(size)
    return tuple(np.concatenate(c) for c in zip(*tokens, strict=True)), (image[spot], value[spot].view(_U), size[spot])


def _constant(argb: int) -> tuple[int, int]:
    """(value, bits) of an image within a stream, all pixels of which are alike: no cache, and a code of one symbol five times."""
    value = 0
    for k, shift in enumerate((8, 16, 0, 24)):
        value |= (5 | (argb >> shift & 255) << 3) << 1 + 11 * k
    return value | 5 << 45, 56


# --- transforms ---------------------------------------------------------------------------------------------------------


def _parts(argb: np.ndarray) -> np.ndarray:
    return np.stack([argb >> np.uint32(s) & np.uint32(255) for s in (24, 16, 8, 0)], axis=-1).astype(np.int32)


def _whole(parts: np.ndarray) -> np.ndarray:
    p = (parts & 255).astype(np.uint32)
    return p[..., 0] << np.uint32(24) | p[..., 1] << np.uint32(16) | p[..., 2] << np.uint32(8) | p[..., 3]


def _average(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a & b) + (((a ^ b) & np.uint32(0xFEFEFEFE)) >> np.uint32(1))


def _wide(argb: np.ndarray) -> np.ndarray:
    return argb.view(np.uint8).astype(np.int16)


def _clipped(v: np.ndarray) -> np.ndarray:
    return np.clip(v, 0, 255).astype(np.uint8).view(np.uint32)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of the differences of the components."""
    a, b, low = a.view(np.uint8), b.view(np.uint8), np.uint32(0xFF00FF)
    d = (np.maximum(a, b) - np.minimum(a, b)).view(np.uint32)
    d = (d & low) + (d >> np.uint32(8) & low)
    return (d & np.uint32(0xFFFF)) + (d >> np.uint32(16))


def predicted(mode: int, near) -> np.ndarray:
    """Predictions of many pixels by one mode; ``near`` gives their neighbours: left (0), top, top left and top right (3)."""
    if mode == 0 or mode > 13:
        return np.full(len(near(0)), _OPAQUE)
    if mode < 5:
        return near((0, 1, 3, 2)[mode - 1])
    if mode == 5:
        return _average(_average(near(0), near(3)), near(1))
    if mode < 10:
        a, b = ((0, 2), (0, 1), (2, 1), (1, 3))[mode - 6]
        return _average(near(a), near(b))
    if mode == 10:
        return _average(_average(near(0), near(2)), _average(near(1), near(3)))
    left, top, top_left = near(0), near(1), near(2)
    if mode == 11:
        return np.where(_apart(top, top_left) < _apart(left, top_left), left, top)
    if mode == 12:
        return _clipped(_wide(left) + _wide(top) - _wide(top_left))
    m = _wide(_average(left, top))
    d = m - _wide(top_left)
    return _clipped(m + ((d + (d < 0)) >> 1))


def _cross(parts: np.ndarray, factors: np.ndarray, invert: bool) -> np.ndarray:
    """Add (subtract) what green explains of red and blue, and red of blue; ``factors`` are parts of the tiles' pixels."""
    signed = lambda v: (v & 255).astype(np.int8).astype(np.int32)
    green_red, green_blue, red_blue = signed(factors[:, 3]), signed(factors[:, 2]), signed(factors[:, 1])
    p, sign, green = parts.copy(), 1 if invert else -1, signed(parts[:, 2])
    p[:, 1] += sign * (green_red * green >> 5)
    red = signed(p[:, 1] if invert else parts[:, 1])
    p[:, 3] += sign * ((green_blue * green >> 5) + (red_blue * red >> 5))
    return p & 255


def _tiles(width: int, height: int, bits: int) -> tuple[np.ndarray, int]:
    """(tile of each pixel, number of tiles)."""
    across, down = (width + (1 << bits) - 1) >> bits, (height + (1 << bits) - 1) >> bits
    y, x = np.divmod(np.arange(width * height), width)
    return (y >> bits) * across + (x >> bits), across * down


def _spatial(argb: np.ndarray, rows: np.ndarray, width: int):
    """(residuals, modes, factors, noise) of opaque images of one width and one number of tiles, one after the other.

    All 14 modes are tried on every tile. A byte costs what it would by its image's counts under the one mode that suits the
    whole image best; a tile takes the mode, then the least-squares factors or none, at the least cost. Sums are of integers,
    so that an image's choices hang on nothing but the image. Noise: images that no mode makes smaller.
    """
    n, m = len(argb), len(rows)
    sizes = rows * width
    first, image = np.cumsum(sizes) - sizes, np.repeat(np.arange(m), sizes)
    padded = np.concatenate([np.zeros(width + 1, np.uint32), argb])
    place = np.arange(n)
    row0 = place - first[image] < width
    bound = row0 | (place % width == 0)
    free, fixed = np.flatnonzero(~bound), np.flatnonzero(bound)  # fixed: by their place the same in every mode
    guess = np.where(row0[fixed], padded[fixed + width], padded[fixed + 1])
    guess[fixed == first[image[fixed]]] = _OPAQUE
    less = lambda a, b: (a.view(np.uint8) - b.view(np.uint8)).view(np.uint32)
    p = np.empty(n, np.uint32)
    p[fixed] = less(argb[fixed], guess)

    side = 1 << TILE
    across = (width + side - 1) >> TILE
    tiles = across * _down(int(rows[0]))
    n_tiles = m * tiles
    y, x = np.divmod(place, width)
    tile = image * tiles + ((y - (first // width)[image]) >> TILE) * across + (x >> TILE)

    channel = np.array([[0], [256], [512]])
    of, at, rest = image[free] * 768 + channel, np.empty((14, 3, len(free)), np.int64), np.empty((14, len(free)), np.uint32)
    c = np.arange(int(sizes.max()) + 1)
    log = np.rint(1024 * c * np.log2(np.maximum(c, 1))).astype(np.int64)
    own, around = argb[free], [padded[free + k] for k in (width, 1, 0, 2)]
    always = np.bincount((image[fixed] * 768 + channel + p[fixed].view(np.uint8).reshape(-1, 4).T[:3]).ravel(), minlength=768 * m).reshape(m, 768)
    counts, bits = [], []
    for mode in range(14):
        rest[mode] = less(own, predicted(mode, around.__getitem__))
        np.add(rest[mode].view(np.uint8).reshape(-1, 4).T[:3], of, out=at[mode])
        counts.append(always + np.bincount(at[mode].ravel(), minlength=768 * m).reshape(m, 768))
        bits.append(3 * log[sizes] - log[counts[-1]].sum(axis=1))
    best = np.argmin(bits, axis=0)
    noise = np.min(bits, axis=0) > 1024 * 0.98 * 24 * sizes
    usual = np.stack([counts[k][i] for i, k in enumerate(best.tolist())])
    cost = np.rint(256 * np.log2((sizes[:, None] + 77) / (usual + 0.3))).astype(np.int32).ravel()

    def summer(tile):
        """Sums by tile, where pixels of a tile are neighbours for the most part."""
        runs = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])[: len(tile)])
        by = tile[runs]
        return lambda v: np.bincount(by, weights=np.add.reduceat(v, runs, dtype=np.int64), minlength=n_tiles) if len(v) else np.zeros(n_tiles)

    searched, sums = summer(tile[free]), summer(tile)
    modes = np.argmin([searched(cost.take(v, mode="clip").sum(axis=0, dtype=np.int32)) for v in at], axis=0)
    p[free] = rest[modes[tile[free]], np.arange(len(free))]

    blue, green, red = (np.ascontiguousarray(v).astype(np.int32) for v in p.view(np.int8).reshape(n, 4).T[:3])
    fit = lambda x, y: np.clip(np.round(32 * sums(x * y) / np.maximum(sums(x * x), 1)), -128, 127).astype(np.int32)
    price = lambda v, k: sums(cost[image * 768 + 256 * k + (v & 255)])
    green_red, green_blue = fit(green, red), fit(green, blue)
    by_green = blue - (green_blue[tile] * green >> 5)
    red_blue = fit(red, ((by_green + 128) & 255) - 128)
    less_red, less_blue = red - (green_red[tile] * green >> 5), by_green - (red_blue[tile] * red >> 5)
    green_red *= price(less_red, 2) < price(red, 2)
    pays = price(less_blue, 0) < price(blue, 0)
    green_blue, red_blue = green_blue * pays, red_blue * pays
    factors = np.stack([np.full(len(modes), 255, np.int32), red_blue, green_blue, green_red], axis=1)
    spot = np.flatnonzero(factors[:, 1:].any(axis=1)[tile])
    p[spot] = _whole(_cross(_parts(p[spot]), factors[tile[spot]], False))
    return p, modes, _whole(factors), noise


# --- writing streams ----------------------------------------------------------------------------------------------------


def _down(rows: int) -> int:
    """Tiles below each other."""
    return (rows + (1 << TILE) - 1) >> TILE


def _pieces(sizes: list[int], widths: list[int]):
    """Images of one width and one number of tiles, by number, of about PIECE pixels in sum."""
    alike = {}
    for f, (n, w) in enumerate(zip(sizes, widths, strict=True)):
        alike.setdefault((w, _down(n // w)), []).append(f)
    for _, who in sorted(alike.items()):
        held, size = [], 0
        for f in who:
            held.append(f)
            size += sizes[f]
            if size >= PIECE:
                yield held
                held, size = [], 0
        if held:
            yield held


def encode_streams(images: list[np.ndarray], width: int, used: Counter | None = None) -> list[bytes]:
    """Lossless streams of opaque images of one width, given as (rows x width, 3) samples."""
    used = Counter() if used is None else used
    head, subs, mains, sizes, widths = [], [], [], [], []
    every = np.full((sum(map(len, images)), 4), 255, np.uint8)  # blue lowest, alpha highest
    np.concatenate([np.zeros((0, 3), np.uint8), *images], out=every[:, 2::-1])
    every, at = every.view("<u4").ravel(), 0
    for f, rgb in enumerate(images):
        argb, at = every[at : at + len(rgb)], at + len(rgb)
        rows, wide = len(argb) // width, width
        head.append((f, 0, 0x2F | (width - 1) << 8 | (rows - 1) << 22, 40))
        colours = np.sort(argb)
        colours = colours[np.concatenate([[True], colours[1:] != colours[:-1]])]
        if len(colours) <= 256 and 2 * len(colours) <= len(argb):
            index = np.searchsorted(colours, argb)
            shrink = _palette_bits(len(colours))
            used.update(palette=1, bundled=int(shrink > 0))
            steps = _parts(colours)
            steps[1:] -= steps[:-1].copy()
            head.append((f, 1, 1 | PALETTE << 1 | (len(colours) - 1) << 3, 11))
            subs.append((f, 2, _whole(steps), len(colours)))
            wide = (width + (1 << shrink) - 1) >> shrink
            padded = np.zeros((rows, wide << shrink), np.uint32)
            padded[:, :width] = index.reshape(rows, width)
            each = padded.reshape(rows, wide, 1 << shrink) << (np.arange(1 << shrink, dtype=np.uint32) * np.uint32(8 >> shrink))
            argb = np.bitwise_or.reduce(each, axis=2).ravel() << np.uint32(8) | np.uint32(0xFF000000)
        head.append((f, 7, 0, 1))
        mains.append(argb)
        sizes.append(len(argb))
        widths.append(wide)
    for these in _pieces(sizes, widths):
        wide, each = widths[these[0]], np.array([sizes[f] for f in these])
        rest, modes, factors, noise = _spatial(np.concatenate([mains[f] for f in these]), each // wide, wide)
        modes, factors, taken = modes.reshape(len(these), -1), factors.reshape(len(these), -1), ~noise
        for f, n, e, plain in zip(these, each.tolist(), np.cumsum(each).tolist(), noise.tolist(), strict=True):
            if not plain:
                mains[f] = rest[e - n : e]
        used.update(plain=int(noise.sum()), predictor=int(taken.sum()), cross_colour=int(taken.sum()), factored=int((factors[taken] != _OPAQUE).any(axis=1).sum()))
        used.update({f"mode_{v}": int((modes[taken] == v).any(axis=1).sum()) for v in range(14)})
        for step, kind, tiled in ((3, PREDICTOR, _OPAQUE | modes.astype(np.uint32) << np.uint32(8)), (5, CROSS_COLOUR, factors)):
            alike = (tiled == tiled[:, :1]).all(axis=1).tolist()
            for f, plain, one, first, sub in zip(these, noise.tolist(), alike, tiled[:, 0].tolist(), tiled, strict=True):
                if plain:
                    continue
                head.append((f, step, 1 | kind << 1 | (TILE - 2) << 3, 6))
                if one:
                    head.append((f, step + 1, *_constant(first)))
                else:
                    subs.append((f, step + 1, sub, (wide + (1 << TILE) - 1) >> TILE))
    frame, step, value, size = (np.array(c, t) for c, t in zip(zip(*head, strict=True), (np.int64, np.int64, _U, np.int64), strict=True))
    tokens = [(frame * 128 + step * 8, value, size)]
    for parts, main in ((subs, False), ([(f, 8, a, w) for f, (a, w) in enumerate(zip(mains, widths, strict=True))], True)):
        if parts:
            place = np.array([p[0] * 128 + p[1] * 8 for p in parts])
            (row, step, value, size), pixels = code_images(np.concatenate([p[2] for p in parts]).astype(np.uint32), np.array([len(p[2]) for p in parts]), np.array([p[3] for p in parts]), main, used)
            tokens.append((place[row] + step, value, size))
            if not main:
                tokens.append((place[pixels[0]] + 6, *pixels[1:]))
    key, value, size = (np.concatenate(c) for c in zip(*tokens, strict=True))
    order = _order(key)
    return pack_bits([(key[order] >> 7, value[order], size[order]), pixels], len(images))  # what it ends with is each image's own pixels


# --- reading streams ----------------------------------------------------------------------------------------------------


class _Odd(Exception):
    """Streams (by number) that only the plain reader takes."""


class _Batch:
    def __init__(self, streams: list[bytes]):
        size = np.array([len(s) for s in streams], np.int64)
        base = np.cumsum(size + 8) - size - 8
        raw = b"".join(s + b"\0" * 8 for s in streams) + b"\0" * 16
        self.words = np.empty(len(raw) // 8 * 8 - 8, _U)  # the 64 bits from each byte on
        for k in range(8):
            self.words[k::8] = np.frombuffer(raw, "<u8", len(self.words) // 8, k)
        self.at, self.end = base * 8, (base + size) * 8

    def window(self, at: np.ndarray) -> np.ndarray:
        return self.words[np.minimum(at >> 3, len(self.words) - 1)] >> (at & 7).astype(_U)

    def read(self, who: np.ndarray, n) -> np.ndarray:
        at = self.at[who]
        n = np.broadcast_to(np.asarray(n, np.int64), at.shape)
        v = (self.window(at) & ((_U(1) << n.astype(_U)) - _U(1))).astype(np.int64)
        self.at[who] = at + n
        return v


def _tables(lengths: np.ndarray, bits: int, who: np.ndarray) -> np.ndarray:
    """(rows, 2**bits): symbol << 4 | length, by the next bits, first bit lowest."""
    many = (lengths > 0).sum(axis=1)
    if not many.all():
        raise BadImage("an empty prefix code")
    if lengths.max() > bits:
        raise _Odd(who[(lengths > bits).any(axis=1)])
    lone = many == 1
    r, s, n = _cells(lengths)
    n[lone[r]] = 0
    key = np.sort(r << 16 | n << 12 | s)
    r, s, n = key >> 16, key & 0xFFF, key >> 12 & 0xF
    wide = 1 << (bits - n)
    if (np.bincount(r, weights=wide, minlength=len(lengths)) != 1 << bits).any():
        raise BadImage("an incomplete prefix code")
    table = np.repeat((s << 4 | n).astype(np.uint16), wide).reshape(len(lengths), 1 << bits)
    return table.take(_reverse(np.arange(1 << bits), bits), axis=1)


def _read_codes(b: _Batch, who: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Code lengths of one prefix code for each stream."""
    lengths = np.zeros((len(who), int(alphabet.max())), np.uint8)
    simple = b.read(who, 1) == 1
    i = np.flatnonzero(simple)
    if len(i):
        w = who[i]
        two, wide = b.read(w, 1), b.read(w, 1)
        first = b.read(w, np.where(wide, 8, 1))
        second = b.read(w, 8 * two)
        if (np.maximum(first, second) >= alphabet[i]).any():
            raise BadImage("a symbol past its alphabet")
        lengths[i, first] = 1
        lengths[i[two > 0], second[two > 0]] = 1
    i = np.flatnonzero(~simple)
    if not len(i):
        return lengths
    w = who[i]
    given, meta = 4 + b.read(w, 4), np.zeros((len(i), 19), np.uint8)
    for k in range(19):
        has = np.flatnonzero(given > k)
        if len(has):
            meta[has, _ORDER[k]] = b.read(w[has], 3)
    table = _tables(meta, 7, w)
    left = alphabet[i].copy()
    cut = np.flatnonzero(b.read(w, 1))
    if len(cut):
        left[cut] = 2 + b.read(w[cut], 2 + 2 * b.read(w[cut], 3))
    wide = lengths.shape[1] + 1  # with one to spare, where an ended code writes
    size, flat, words = alphabet[i], np.zeros(len(i) * wide, np.uint8), b.words.view(np.int64)
    live, p, at, table, turn = np.arange(len(i)), b.at[w], np.zeros(len(i), np.int64), table.ravel(), 0
    rows, first = live << 7, live * wide
    while True:
        on = (at < size) & (left > 0)
        if not turn & 15 and not on.all():
            b.at[w[live[~on]]] = p[~on]
            flat[(first + at)[~on]] = 0
            keep = np.flatnonzero(on)
            live, p, at, size, left, rows, first, on = (v[keep] for v in (live, p, at, size, left, rows, first, on))
        if not len(live):
            lengths[i] = flat.reshape(len(i), wide)[:, :-1]
            return lengths
        turn += 1
        v = words.take(p >> 3, mode="clip")
        v >>= p & 7
        s = table.take((v & 127) + rows).astype(np.int64)
        move = s & 15
        s >>= 4
        spot = first + at
        flat[spot] = s
        j = np.flatnonzero((s >= 16) & on)
        if len(j):
            kind = s[j] - 16
            bits = np.array([2, 3, 7])[kind]
            n = np.where(kind == 2, 11, 3) + (v[j] >> move[j] & (1 << bits) - 1)
            if (at[j] + n > size[j]).any():
                raise BadImage("more code lengths than symbols")
            flat[spot[j]] = 0
            for k, m in zip(spot[j[kind == 0]].tolist(), n[kind == 0].tolist(), strict=True):  # the last length but zero, again
                before = flat[k - k % wide : k]
                before = before[before > 0]
                flat[k : k + m] = before[-1] if len(before) else 8
            move[j] += bits
            at[j] += n - 1
        move *= on
        p += move
        at += on
        left -= 1


def _read_images(b: _Batch, who: np.ndarray, widths: np.ndarray, heights: np.ndarray, main: bool, used: Counter) -> list[np.ndarray]:
    """Pixels of one entropy-coded image of each stream."""
    total = widths * heights
    rank = np.argsort(-total, kind="stable")
    who, widths, total = who[rank], widths[rank], total[rank]
    on = b.read(who, 1)
    cache_bits = b.read(who, 4 * on)
    if (cache_bits[on > 0] > 11).any() or (cache_bits[on > 0] < 1).any():
        raise BadImage("a colour cache of a wrong size")
    if main:
        grouped = b.read(who, 1) > 0
        if grouped.any():
            raise _Odd(who[grouped])
    cache_size = np.where(on > 0, 1 << cache_bits, 0)
    flat = []
    for k, a in enumerate(_ALPHABETS):
        lengths = _read_codes(b, who, a + (cache_size if k == 0 else np.zeros_like(cache_size)))
        bits = min(BITS, int(lengths.max()))
        rows = np.arange(len(who)) << bits
        flat.append((_tables(lengths, BITS if (lengths > BITS).any() else bits, who).ravel(), rows, (1 << bits) - 1))
    at, base = b.at[who], np.cumsum(total + 1) - total - 1  # each image has a pixel to spare, where an ended one writes
    out, copies, hits = _symbols(b, flat, at, base, base + total, used)
    if (at > b.end[who]).any():
        raise BadImage("the data end early")
    b.at[who] = at
    used["references_read"] += len(copies[0])
    used["cache_hits_read"] += len(hits[0])
    whence = np.arange(len(out))
    spot, run, code, k = copies
    close = np.minimum(code, 120) - 1
    dist = np.where(code > 120, code - 120, np.maximum(1, _NEAR_X[close] + _NEAR_Y[close] * widths[k]))
    if (dist > spot - base[k]).any():
        raise BadImage("a back-reference past the image")
    copied = np.repeat(spot - np.cumsum(run) + run, run) + np.arange(int(run.sum()))
    whence[copied] = copied - np.repeat(dist, run)
    _to_roots(whence, copied)
    spot, slot, k = hits
    if len(spot):  # a hit is what last came up in its slot: a pixel written out, an earlier hit, or a copy of either
        caching = np.flatnonzero(on)
        many = total[caching]
        px = np.repeat(base[caching] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        slots = np.cumsum(cache_size) - cache_size
        key = np.zeros(len(out), np.int64)
        key[px] = (out[px] * np.uint32(_HASH)) >> np.repeat((32 - cache_bits[caching]).astype(np.uint32), many)
        key[spot] = slot
        order = (key[whence[px]] + np.repeat(slots[caching], many)) << 32 | px
        order.sort()
        hit = np.zeros(len(out), bool)
        hit[spot] = True
        mine = np.flatnonzero(hit[order & 0xFFFFFFFF])
        before = order[mine - 1]
        new = (mine == 0) | (before >> 32 != order[mine] >> 32)
        if new.any():  # of a slot that nothing was put in
            raise _Odd(who[np.searchsorted(base, order[mine[new]] & 0xFFFFFFFF, "right") - 1])
        whence[order[mine] & 0xFFFFFFFF] = before & 0xFFFFFFFF
        copied = np.concatenate([copied, spot])
        _to_roots(whence, copied)
    out[copied] = out[whence[copied]]
    back = np.argsort(rank)
    return [out[s : s + k] for s, k in zip(base[back].tolist(), total[back].tolist(), strict=True)]


def _to_roots(whence: np.ndarray, todo: np.ndarray) -> None:
    """Let pixels that come from earlier ones come from the first of their line, which comes from itself."""
    while len(todo):
        near = whence[todo]
        far = whence[near]
        todo = todo[far != near]
        whence[todo] = far[far != near]


#: By prefix: the number of extra bits of a length or distance, and the least one.
_SPAN_EXTRA = np.array([max(p - 2, 0) >> 1 for p in range(40)])
_SPAN_LEAST = np.array([p + 1 if p < 4 else ((2 + (p & 1)) << ((p - 2) >> 1)) + 1 for p in range(40)])


def _symbols(b: _Batch, codes: list, at: np.ndarray, start: np.ndarray, end: np.ndarray, used: Counter):
    """(pixels written out, (place, length, distance code, image) of references, (place, slot, image) of cache hits).

    A turn reads a symbol of every image; ``at`` moves behind the last. What a reference or a cache hit stands for is nothing
    that reading needs, so it is found later. An image that has ended stays where it is until it is dropped.
    """
    (green, g_rows, g_mask), (red, r_rows, r_mask), (blue, b_rows, b_mask), (alpha, a_rows, a_mask), (far, f_rows, f_mask) = codes
    clear = (alpha[a_rows].astype(np.int64) >> 4) << 24 if not (alpha & 15).any() else None  # one alpha to an image: no bits
    words, out = b.words.view(np.int64), np.zeros(int(end.max()) + 1, np.uint32)
    live, p, spot, turn = np.arange(len(at)), at.copy(), start.copy(), 0
    copies, hits = [], []
    while True:
        on = spot < end
        if not turn & 15 and not on.all():
            at[live[~on]] = p[~on]
            keep = np.flatnonzero(on)
            live, p, spot, end, on, g_rows, r_rows, b_rows, a_rows, f_rows = (v[keep] for v in (live, p, spot, end, on, g_rows, r_rows, b_rows, a_rows, f_rows))
            clear = clear if clear is None else clear[keep]
        if not len(live):
            break
        turn += 1
        w = words.take(p >> 3, mode="clip")
        w >>= p & 7
        s = green.take((w & g_mask) + g_rows).astype(np.int64)
        move = s & 15
        w >>= move
        other = np.flatnonzero(s >= 256 << 4)
        if len(other):
            w_other, move_other = w[other], move[other]
        e = red.take((w & r_mask) + r_rows).astype(np.int64)
        k = e & 15
        move += k
        w >>= k
        px = e >> 4 << 16
        px |= s >> 4 << 8
        e = blue.take((w & b_mask) + b_rows).astype(np.int64)
        k = e & 15
        move += k
        px |= e >> 4
        if clear is None:
            w >>= k
            e = alpha.take((w & a_mask) + a_rows).astype(np.int64)
            move += e & 15
            px |= e >> 4 << 24
        else:
            px |= clear
        out[spot] = px
        if len(other):
            s = s[other] >> 4
            move[other] = move_other
            cached = s >= 280
            j = other[cached & on[other]]
            if len(j):
                hits.append((spot[j], s[cached & on[other]] - 280, live[j]))
            again = np.flatnonzero(~cached & on[other])
            if len(again):
                j, w, s = other[again], w_other[again], s[again] - 256
                extra = _SPAN_EXTRA[s]
                run = _SPAN_LEAST[s] + (w & (1 << extra) - 1)
                w >>= extra
                e = far.take((w & f_mask) + f_rows[j]).astype(np.int64)
                k = e & 15
                w >>= k
                e >>= 4
                more = _SPAN_EXTRA[e]
                copies.append((spot[j], run, _SPAN_LEAST[e] + (w & (1 << more) - 1), live[j]))
                move[j] += extra + k + more
                spot[j] += run - 1
                if (spot[j] >= end[j]).any():
                    raise BadImage("a back-reference past the image")
        move *= on
        p += move
        spot += on
    used["turns_read"] += turn
    join = lambda found, n: tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * n
    return out, join(copies, 4), join(hits, 3)


@lru_cache(64)
def _diagonals(width: int, height: int, bits: int):
    """By pixel: its tile, the mode its place demands (-1: none) and its turn, after those of all its neighbours."""
    y, x = np.divmod(np.arange(width * height), width)
    fixed = np.where(y == 0, np.where(x == 0, 0, 1), np.where(x == 0, 2, -1))
    return _tiles(width, height, bits)[0], fixed, x + 2 * y + 1


def _unpredict(images: list[tuple[np.ndarray, int, int, np.ndarray, int]]) -> list[np.ndarray]:
    """Images from (residuals, width, height, modes, tile bits), one diagonal of all of them at a time, each mode at once."""
    alike = {}
    for k, (_, width, height, _, bits) in enumerate(images):
        alike.setdefault((width, height, bits), []).append(k)
    keys, widths = [], []
    for (width, height, bits), who in alike.items():
        tile, fixed, turn = _diagonals(width, height, bits)
        mode = np.stack([images[k][3] for k in who])[:, tile]
        mode = np.where(fixed >= 0, fixed, np.where(mode > 13, 0, mode))
        keys.append(np.where(mode > 0, turn * 16 + mode, 0).ravel())  # without neighbours: first
        widths.append(np.full(len(keys[-1]), width))
    key, width = np.concatenate(keys), np.concatenate(widths)
    shared = int(width[0]) if (width == width[0]).all() else None
    key = key.astype(np.uint16 if key.max() < 1 << 16 else np.int64)
    order, many = np.argsort(key, kind="stable"), np.bincount(key)
    out = np.concatenate([images[k][0] for who in alike.values() for k in who])
    end = np.cumsum(many)
    for k in np.flatnonzero(many).tolist():
        spot = order[end[k] - many[k] : end[k]]
        w = width[spot] if shared is None else shared
        guess = predicted(k & 15, lambda j: out[spot - (1, w, w + 1, w - 1)[j]])  # noqa: B023
        out[spot] = (out[spot].view(np.uint8) + guess.view(np.uint8)).view(np.uint32)
    result, at = [None] * len(images), 0
    for who in alike.values():
        for k in who:
            result[k] = out[at : at + len(images[k][0])]
            at += len(images[k][0])
    return result


def decode_streams(streams: list[bytes], used: Counter | None = None) -> list[np.ndarray]:
    """(height, width, 4) red, green, blue and alpha of each stream."""
    used = Counter() if used is None else used
    try:
        return _decode(streams, used)
    except _Odd as e:
        odd = set(e.args[0].tolist())
        rest = iter(decode_streams([s for k, s in enumerate(streams) if k not in odd], used))
        return [_decode_stream(s) if k in odd else next(rest) for k, s in enumerate(streams)]


def _decode(streams: list[bytes], used: Counter) -> list[np.ndarray]:
    if not streams:
        return []
    b, every = _Batch(streams), np.arange(len(streams))
    if (b.read(every, 8) != 0x2F).any():
        raise BadImage("no lossless signature")
    width, height = b.read(every, 14) + 1, b.read(every, 14) + 1
    b.read(every, 1)
    if b.read(every, 3).any():
        raise BadImage("unknown version")
    across, todo, met = width.copy(), [[] for _ in streams], np.zeros((len(streams), 4), bool)
    live = every
    while True:
        live = live[b.read(live, 1) > 0]
        if not len(live):
            break
        kind = b.read(live, 2)
        if met[live, kind].any():
            raise BadImage("a transform twice")
        met[live, kind] = True
        for k in np.unique(kind).tolist():
            w = live[kind == k]
            used[("predictor_read", "cross_colour_read", "subtract_green_read", "palette_read")[k]] += len(w)
            if k == SUBTRACT_GREEN:
                for f in w.tolist():
                    todo[f].append((k, int(across[f]), 0, None))
                continue
            if k == PALETTE:
                size = b.read(w, 8) + 1
                bits = np.array([_palette_bits(n) for n in size.tolist()])
                subs = _read_images(b, w, size, np.ones_like(size), False, used)
            else:
                bits = b.read(w, 3) + 2
                side = lambda n: (n + (1 << bits) - 1) >> bits  # noqa: B023, E731
                subs = _read_images(b, w, side(across[w]), side(height[w]), False, used)
            for f, s, sub in zip(w.tolist(), bits.tolist(), subs, strict=True):
                todo[f].append((k, int(across[f]), s, sub))
            if k == PALETTE:
                across[w] = (across[w] + (1 << bits) - 1) >> bits
    images = _read_images(b, every, across, height, True, used)
    while any(todo):
        now = [(f, todo[f].pop()) for f in every.tolist() if todo[f]]
        guessed = [(f, t) for f, t in now if t[0] == PREDICTOR]
        if guessed:
            inputs = [(images[f], wide, int(height[f]), (sub >> np.uint32(8) & np.uint32(15)).astype(np.int64), bits) for f, (_, wide, bits, sub) in guessed]
            for (f, _), px in zip(guessed, _unpredict(inputs), strict=True):
                images[f] = px
        for f, (k, wide, bits, sub) in now:
            if k == SUBTRACT_GREEN:
                p = _parts(images[f])
                p[:, [1, 3]] += p[:, [2]]
                images[f] = _whole(p)
            elif k == CROSS_COLOUR:
                if (sub & ~_OPAQUE).any():  # all factors zero: nothing to add
                    images[f] = _whole(_cross(_parts(images[f]), _parts(sub)[_tiles(wide, int(height[f]), bits)[0]], True))
            elif k == PALETTE:
                table = np.zeros(256, np.uint32)
                table[: len(sub)] = _whole(np.cumsum(_parts(sub), axis=0))
                index = (images[f] >> np.uint32(8) & np.uint32(255)).reshape(int(height[f]), -1)
                if bits:
                    each = 8 >> bits
                    index = (index[:, :, None] >> (np.arange(1 << bits, dtype=np.uint32) * np.uint32(each)) & np.uint32((1 << each) - 1)).reshape(int(height[f]), -1)[:, :wide]
                images[f] = table[index.ravel()]
    low, out = np.uint32(0xFF), []
    for px, h, w in zip(images, height.tolist(), width.tolist(), strict=True):
        turned = px & np.uint32(0xFF00FF00) | px >> np.uint32(16) & low | (px & low) << np.uint32(16)  # red lowest
        out.append(turned.view(np.uint8).reshape(h, w, 4))
    return out
