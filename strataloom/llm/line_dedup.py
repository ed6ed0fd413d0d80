"""Line dedup by a suffix array over line-ID sequences, built by distributed prefix doubling.

Every line with a word gets a 128-bit ID. A round of doubling ranks the runs of 2h lines that begin at each line: the pair
of ranks of its two halves is a key, keys are sorted over the whole cluster, and a key's place in that order is the new
rank. The suffixes sorted by rank are the suffix array up to 2h lines. Suffixes whose rank is theirs alone can't begin a
repeated run of that length and drop out, so later rounds shrink to what repeats.

A longest-common-prefix interval is a stretch of the array whose neighbours share at least so many lines. Those that
matter share ``min_words`` words: for each line the shortest run of so many words from it and the shortest one to it. Its
interval is named by its length and the ranks of its first and last 2^k lines, which overlap to cover it. The member at the
smallest place stays, and the later copies are deleted; neighbouring intervals together make up the maximal repeated runs.

Deleted is exactly every line that lies in some run of consecutive lines with at least ``min_words`` words that also
starts earlier (smaller doc_id, or same document and earlier line). Any such run is covered by its shortest sub-runs of
that many words that begin or end at one of its lines; they have ``min_words`` lines at most, so log2(min_words) rounds do.

All rounds are sorts, aggregations and joins of the engine: no interval is ever gathered in a task, as its first member
comes from a partial aggregation, and a rank in a third of all rows is a skewed side of a join that is dealt anew.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.llm.blocks import fresh, slices
from strataloom.llm.repeats import SPANS, keyed, span_rows, union, with_spans
from strataloom.session import materialize

PLACE = ["doc_id", "crc", "i"]


def word_lines(text: bytes) -> list[int]:
    """Indices of the lines (parted by newlines) that hold a word."""
    return [i for i, line in enumerate(text.split(b"\n")) if line.strip()]


def shortest_runs(words: np.ndarray, owner: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first line, number of lines) of the shortest runs of ``min_words`` words from and to each line, by first line.

    owner is each line's document, ascending. Runs never leave their document.
    """
    total = np.concatenate([[0], np.cumsum(words)])
    begin = np.searchsorted(owner, owner, "left")
    end = np.searchsorted(owner, owner, "right")
    to = np.searchsorted(total, total[:-1] + min_words, "left")
    since = np.searchsorted(total, total[1:] - min_words, "right") - 1
    a, b = to <= end, since >= begin
    s = np.concatenate([np.flatnonzero(a), since[b]])
    e = np.concatenate([to[a], np.flatnonzero(b) + 1])
    if not len(s):
        return s, s
    s, e = np.unique(np.stack([s, e]), axis=1)
    return s, e - s


def _lines(docs: DataFrame, id_col: str, text: str, min_words: int) -> DataFrame:
    """(doc_id, crc, i, hi, lo, sizes): a row per line with its ID, and the sizes of the shortest runs from it on."""

    def emit(batches):
        for b in slices(batches, "text"):
            hashes, words, owner, first = [], [], [], []
            for k, t in enumerate(b.column("text").to_pylist()):
                first.append(len(words))
                for line in t.split(b"\n"):
                    if w := len(line.split()):
                        hashes.append(xxhash.xxh3_128_digest(line))
                        words.append(w)
                        owner.append(k)
            if not words:
                continue
            ids = np.frombuffer(b"".join(hashes), ">i8").reshape(-1, 2).astype(np.int64)
            owner = np.array(owner)
            s, size = shortest_runs(np.array(words), owner, min_words)
            cuts = np.searchsorted(s, np.arange(len(words) + 1)).astype(np.int32)
            sizes = pa.ListArray.from_arrays(pa.array(cuts), pa.array(size.astype(np.int32)))
            whose = pa.array(owner.astype(np.int32))
            at = (np.arange(len(words)) - np.array(first)[owner]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(whose), b.column("crc").take(whose), pa.array(at), pa.array(ids[:, 0]), pa.array(ids[:, 1]), sizes], names)

    names = [*PLACE, "hi", "lo", "sizes"]
    return keyed(docs, id_col, text).mapInArrow(emit, "doc_id long, crc long, i int, hi long, lo long, sizes array<int>")


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one place, with the first of them."""
    place = F.struct(*PLACE)
    return rows.groupBy(*keys).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` whose key (hi, lo) repeats, with the key's rank in place of it: its place in the order of all keys."""
    keys = _repeated(rows, ["hi", "lo"]).select("hi", "lo")
    ranks = materialize(keys.repartitionByRange("hi", "lo").sortWithinPartitions("hi", "lo").withColumn("rank", F.monotonically_increasing_id()), f"{name}-ranks")
    return rows.join(ranks.hint("merge"), ["hi", "lo"]).drop("hi", "lo")


def suffix_ranks(lines: DataFrame, rounds: int) -> list[DataFrame]:
    """(doc_id, crc, i, rank) of suffixes whose first 1, 2, 4, ... lines repeat, ``rounds`` doublings from ``lines`` on."""
    levels = [lines.select(*PLACE, "rank")]
    for k in range(rounds):
        ahead = levels[-1].select("doc_id", "crc", (F.col("i") - (1 << k)).alias("i"), F.col("rank").alias("lo"))
        pairs = levels[-1].withColumnRenamed("rank", "hi").join(ahead.hint("merge"), PLACE)
        levels.append(materialize(_ranked(pairs, f"lines-{2 << k}"), f"lines-{2 << k}"))
    return levels


def later_lines(docs: DataFrame, id_col: str, text: str, min_words: int) -> DataFrame:
    """Spans, in lines that hold a word, to delete from each document."""
    lines = materialize(_lines(docs, id_col, text, min_words), "lines")
    alive = materialize(_ranked(lines, "lines-1").dropDuplicates(PLACE), "lines-1")  # rows that repeat a document count once
    most = alive.agg(F.max(F.array_max("sizes"))).first()[0] or 1
    levels = suffix_ranks(alive, int(most).bit_length() - 1)
    runs = alive.select(*PLACE, F.explode("sizes").alias("size"))
    named = None
    for k, level in enumerate(levels):
        some = runs.where((F.col("size") >= 1 << k) & (F.col("size") < 2 << k)).join(level.withColumnRenamed("rank", "hi").hint("merge"), PLACE)
        whole = some.where(F.col("size") == 1 << k).withColumn("lo", F.col("hi"))
        end = level.select("doc_id", "crc", F.col("i").alias("to"), F.col("rank").alias("lo"))
        part = some.where(F.col("size") > 1 << k).withColumn("to", F.col("i") + F.col("size") - (1 << k)).join(end.hint("merge"), ["doc_id", "crc", "to"]).drop("to")
        for more in (whole, part)[: 2 if k else 1]:
            named = more if named is None else named.unionByName(more)
    named = materialize(named, "lines-runs")
    key = ["size", "hi", "lo"]
    groups = materialize(_repeated(named, key), "lines-intervals")  # written, so that a hot interval's side of the join can be split
    late = named.join(groups.hint("merge"), key).where(F.struct(*PLACE) != F.col("first")).select(*PLACE, "size")

    def spans(batches):
        for b in batches:
            doc, crc, i, size = (b.column(c).to_numpy() for c in (*PLACE, "size"))
            yield from span_rows(doc, crc, i.astype(np.int64), i.astype(np.int64) + size)

    return materialize(late.mapInArrow(spans, SPANS), "lines-late")


def without_lines(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(text without the spanned lines, lines deleted, spans); blank lines stay."""
    lines, at, gone = text.split(b"\n"), word_lines(text), set()
    for a, b in spans:
        gone.update(at[a:b])
    return b"\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone), len(spans)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 20) -> DataFrame:
    """All rows and columns of ``docs`` with the text shortened, and the columns n_lines, n_removed_lines and n_line_runs.

    Lines are parted by newlines; lines without a word are ignored and stay. Null texts stay null and have no lines.
    Texts of repeated rows (same doc_id, same text) are one document, so they do not delete each other. A null doc_id
    comes before all others. Very long texts are read whole. Existing columns of the three names are replaced, others keep
    their values whatever their names. An empty table gives an empty result.
    """
    base = docs.drop("n_lines", "n_removed_lines", "n_line_runs")
    schema = T.StructType([*base.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed_lines", T.LongType()), T.StructField("n_line_runs", T.LongType())])

    columns, names, spans_col = base.columns, schema.names, fresh("__spans", base.columns)

    def apply(batches):
        for b in slices(batches, text):
            texts, counts = [], []
            for t, spans in zip(b.column(text).cast(pa.binary()).to_pylist(), b.column(spans_col).to_pylist(), strict=True):
                kept, gone, n = without_lines(t, union(spans)) if t is not None and spans else (t, 0, 0)
                texts.append(kept)
                counts.append((len(word_lines(t or b"")), gone, n))
            cols = [pa.array(texts, pa.binary()).cast(pa.string()) if c == text else b.column(c) for c in columns]
            n = np.array(counts, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(n[:, k]) for k in range(3))], names)

    return with_spans(base, id_col, text, spans_col, later_lines(base, id_col, text, min_words)).mapInArrow(apply, schema)


def digest(docs: DataFrame) -> DataFrame:
    """What dedup_lines leaves of each document, as counts and a hash."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed_lines", "n_line_runs", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))

