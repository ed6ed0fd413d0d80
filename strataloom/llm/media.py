"""Media columns: texts as lossless WebP images, and back."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.llm import webp, webp_batch
from strataloom.llm.blocks import slices
from strataloom.session import bound_batches

UNIT, WIDTH = 576, 192
ROWS = 8  # of a frame; even, as frames begin at even rows
AT_ONCE = 2_000_000  # pixels; bounds what a task holds


def _groups(sizes: list[int]):
    """Slices of neighbours of about AT_ONCE pixels in sum, one at least."""
    at, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > AT_ONCE:
            yield slice(at, k)
            at, held = k, 0
        held += n
    if held:
        yield slice(at, len(sizes))


def _pixels(stream: bytes) -> int:
    """Pixels of a lossless image, by its header."""
    v = int.from_bytes(stream[1:5], "little")
    return ((v & 0x3FFF) + 1) * ((v >> 14 & 0x3FFF) + 1)


def together(batches, column: str, most: int = 6 << 20):
    """Arrow batches of about ``most`` bytes in ``column``, from smaller and larger ones."""
    held, size = [], 0
    for b in slices(batches, column, most):
        held.append(b)
        size += b.column(column).nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size or any(len(b) for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def payload(text: bytes) -> bytes:
    """The text with bytes 255 up to a positive multiple of 576."""
    return text + b"\xff" * ((-len(text)) % UNIT if text else UNIT)


def to_media(payloads: list[bytes], used: Counter | None = None) -> list[bytes]:
    """Lossless WebP files 192 pixels wide, three bytes to a pixel; in rows too many for one frame, a canvas of several."""
    frames, many = [], []
    for p in payloads:
        px, step = np.frombuffer(p, np.uint8).reshape(-1, 3), ROWS * WIDTH
        mine = [px[i : i + step] for i in range(0, len(px), step)]
        frames += mine
        many.append(len(mine))
    streams = [s for g in _groups([len(f) for f in frames]) for s in webp_batch.encode_streams(frames[g], WIDTH, used)]
    out, at = [], 0
    for n in many:
        part = streams[at : at + n]
        out.append(webp.still(part[0]) if n == 1 else webp.stack(part, WIDTH, [len(f) // WIDTH for f in frames[at : at + n]]))
        at += n
    return out


def from_media(media: list[bytes], used: Counter | None = None) -> list[np.ndarray]:
    """(rows, width, 3) samples of each media value."""
    files = [webp.parts_of(m) for m in media]
    streams = [s for _, found in files for _, _, s in found]
    images = iter([px for g in _groups([_pixels(s) for s in streams]) for px in webp_batch.decode_streams(streams[g], used)])
    return [webp.compose(canvas, [(x, y) for x, y, _ in found], [next(images) for _ in found])[:, :, :3] for canvas, found in files]


def features(pixels: np.ndarray) -> str:
    """Size, channel sums and a 64-bit average hash: which of 64 equal runs of samples are brighter than the mean."""
    flat = pixels.reshape(-1)
    sums = pixels.sum(axis=0, dtype=np.int64).sum(axis=0)
    edges = np.arange(64) * len(flat) // 64
    means = np.add.reduceat(flat, edges, dtype=np.int64) / np.diff(np.append(edges, len(flat)))
    bits = np.packbits(means > flat.mean()).tobytes().hex()
    return f"{pixels.shape[1]}x{pixels.shape[0]}:{sums[0]}:{sums[1]}:{sums[2]}:{bits}"


def encode_media(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text (null: empty) as one lossless WebP file.

    Equal texts give equal files; repeated rows each get a row and null ids stay null; very long texts become frames of one
    canvas; other columns, whatever their names, are ignored; an empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for b in together(batches, "text"):
            texts = b.column("text").to_pylist()
            media = to_media([payload(t) for t in texts])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def read_media(stored: DataFrame, pixels: bool = False) -> DataFrame:
    """Read the stored bytes back: payload size, hash and tail checksum, the stored form's size and hash, and the feature.

    With ``pixels`` the samples come along as a binary column. Repeated rows each get a row; equal texts have equal values.
    """
    new = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]
    new += [("pixels", T.BinaryType())] * pixels
    schema = T.StructType([stored.schema["doc_id"], stored.schema["n_bytes"], *(T.StructField(n, t) for n, t in new)])
    names = schema.names

    def run(batches):
        for b in together(batches, "media", 3 << 20):
            out = []
            media = b.column("media").to_pylist()
            for m, px in zip(media, from_media(media), strict=True):
                data = px.tobytes()
                row = (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(m), hashlib.sha256(m).hexdigest(), features(px))
                out.append(row + (data,) * pixels)
            cols = list(zip(*out, strict=True)) if out else [()] * len(new)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=False))], names)

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)
