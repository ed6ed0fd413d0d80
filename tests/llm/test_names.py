"""Columns of a table keep their values, whatever their names."""

from pyspark.sql import functions as F

from strataloom.llm import exact_dedup, line_dedup, media, mixing, packing, quality, simhash, token_counts

OWN = ["__spans", "__doc", "__crc", "__id", "__c", "__domain", "__lang", "__source", "__key", "__whole", "__left", "__stays", "__node", "__score", "fp", "node", "component", "shard", "blob", "hi", "lo", "i", "rank", "size", "v", "n"]


def table(spark):
    line = "one two three four five six seven eight nine ten\n" * 3
    rows = [(k, line + f"tail {k}", "en", "src0", 1) for k in range(4)] + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.coalesce(F.col("doc_id"), F.lit(-1)) * 10 + k for k, c in enumerate(OWN)})


def kept(df):
    for r in df.select("doc_id", *OWN).collect():
        assert [r[c] for c in OWN] == [(r.doc_id if r.doc_id is not None else -1) * 10 + k for k in range(len(OWN))]


def test_own_names_do_not_clash(spark):
    df = table(spark)
    for out in (line_dedup.dedup_lines(df), exact_dedup.dedup_substrings(df), mixing.mix_sources(df, F.lit("d"), share=0.5), simhash.one_of_each(df)):
        assert out.count() > 0
        kept(out)
    labels = spark.createDataFrame([(k, k % 2, 0, 9) for k in range(4)], "doc_id long, quality int, toxic int, text int")
    scored = quality.score(df, quality.fit(df, labels), out="__other")
    kept(scored)
    import public_tokenizers

    assert token_counts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")).count() == 5
    assert packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).count() == 5
    assert media.read_media(media.encode_media(df)).count() == 5
    assert simhash.near_duplicates(df).count() == simhash.near_copies(df).count() == 5
