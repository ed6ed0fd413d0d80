"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of the lengths of frequent pre-tokens, broadcast once; its size is bounded by
``table_size``. Tier two is a bounded cache in each worker that encodes misses with the library. No pre-token
is ever shuffled: the plan is one scan and one map.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.llm.pieces import byte_pieces, count_cache, load, pack_table
from strataloom.session import bound_batches


def frequent_table(docs: DataFrame, text: str, tokenizer: str, table_size: int, sample_rows: int, partitions: int = 256, most: int = 20_000) -> bytes:
    """Lengths of the most frequent pre-tokens of a bounded sample. It speeds counting up; counts never depend on it.

    The sample is taken from partitions all over the table, of which only the heads are read; texts over ``most`` bytes are
    left out of it.
    """
    rows = docs.select(F.col(text).alias("text"))
    parts = rows.rdd.getNumPartitions()
    stride = max(1, -(-parts // partitions))
    each = max(1, -(-sample_rows // max(1, -(-parts // stride))))

    def peek(batches):
        if TaskContext.get().partitionId() % stride:
            return
        left = each
        for b in batches:
            keep = [t for t in b.column("text").to_pylist() if t and len(t) <= most and len(t.encode()) <= most][:left]
            left -= len(keep)
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.string())], ["text"])
            if left <= 0:
                return

    seen: Counter = Counter()
    for (t,) in rows.mapInArrow(peek, "text string").collect():
        seen.update(byte_pieces(t))
    encode = load(tokenizer)
    return pack_table({p: len(encode(p)) for p, n in seen.most_common(table_size) if n > 1})


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", limit: int = 1024,
    table_size: int = 65_536, sample_rows: int = 1_000, cache_size: int = 700_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row, as the tokenizer's library counts the whole text.

    ``tokenizer`` is the path of a byte-level .json file, or of a .model file, whose texts go to the library whole.
    Null and empty texts have 0 bytes and 0 tokens; null ids stay null; repeated rows each get a row; other columns
    are ignored; an empty table gives an empty result. Very long texts are cut into pieces, never truncated.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    bound_batches(docs.sparkSession)
    whole = tokenizer.endswith(".model")
    table = docs.sparkSession.sparkContext.broadcast(pack_table({}) if whole else frequent_table(docs, text, tokenizer, table_size, sample_rows))
    kind = rows.schema["doc_id"].dataType

    def count(batches):
        lengths = count_cache(tokenizer, table.value, cache_size)
        cut = (lambda t: [t]) if whole else byte_pieces
        get = lengths.__getitem__
        for b in batches:
            n = [sum(map(get, cut(t))) if t else 0 for t in b.column("text").to_pylist()]
            size = pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), size.cast(pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    import pyarrow.compute  # noqa: F401

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
