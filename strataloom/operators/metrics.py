"""Benchmarks of chunkings and graphs: length statistics, duplicate ratio, and recall against a gold set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions import text as tx
from strataloom.session import materialize

TINY, HUGE, LEAST = 120, 3000, 15
SENTENCE_END = "[.?!。？！\"')]$"


def chunk_metrics(chunks: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """n, mean, median, p10, p90 (values at a rank, not interpolated), max, tiny, huge and ends_sentence_pct."""
    rows = chunks.select(*keys, F.length(text).cast("long").alias("len"), F.regexp_replace(text, r"(?U)\s+$", "").rlike(SENTENCE_END).alias("ends"))
    # ranks come from counts by length, so that no group's lengths are collected
    counts = rows.groupBy(*keys, "len").agg(F.count(F.lit(1)).alias("c"), F.count_if("ends").alias("e"))
    w = Window.partitionBy(*keys)
    upto = F.sum("c").over(w.orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = counts.withColumns({"upto": upto, "n": F.sum("c").over(w)})
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("len")))
    n = F.col("n")
    p10 = F.greatest(F.lit(0), F.floor(0.10 * n) - 1)
    p90 = F.least(n - 1, F.floor(0.90 * n))
    return counts.groupBy(*keys).agg(
        F.sum("c").alias("n"), (F.sum(F.col("len") * F.col("c")) / F.sum("c")).alias("mean"), ((at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2).alias("median"),
        at(p10).alias("p10"), at(p90).alias("p90"), F.max("len").alias("max"), F.sum(F.when(F.col("len") < TINY, F.col("c")).otherwise(0)).alias("tiny"),
        F.sum(F.when(F.col("len") > HUGE, F.col("c")).otherwise(0)).alias("huge"), (100.0 * F.sum("e") / F.sum("c")).alias("ends_sentence_pct"),
    )


def stripped_chunks(chunks: DataFrame, text: str = "text") -> DataFrame:
    """Chunks with markup stripped, those with under 15 characters left out."""
    return chunks.withColumn(text, tx.strip_markup(F.col(text))).where(F.length(text) >= LEAST)


def duplicate_ratio(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.count(F.lit(1)).alias("emitted"), F.countDistinct("label", "id").alias("unique_nodes"), (F.count(F.lit(1)) / F.countDistinct("label", "id")).alias("dup_ratio"))


def alias_hits(gold: DataFrame, nodes: DataFrame) -> DataFrame:
    """(gold_id, node) where a gold alias names a node: equal canonical ids, or containment of whole words by aliases of
    two words or eight characters. ``gold`` has gold_id and alias; ``nodes`` has id (canonical).

    Equal names meet in a join on the name. Containment meets on the alias's first word, so it isn't a comparison of all
    pairs; the phrase itself is checked after the join.
    """
    a = gold.select("gold_id", tx.canonical_id(F.col("alias")).alias("alias")).where("alias <> ''").distinct()
    n = nodes.select(F.col("id").alias("node")).distinct()
    same = a.join(n, F.col("alias") == F.col("node")).select("gold_id", "node")
    long = a.where((F.size(F.split("alias", " ")) >= 2) | (F.length("alias") >= 8)).withColumn("word", F.split("alias", " ")[0])
    words = n.select("node", F.explode(F.array_distinct(F.split("node", " "))).alias("word"))
    inside = long.join(words, "word").where(F.contains(F.concat(F.lit(" "), "node", F.lit(" ")), F.concat(F.lit(" "), "alias", F.lit(" ")))).select("gold_id", "node")
    return same.union(inside).distinct()


def entity_recall(gold: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: found, total and recall (1.0 for an empty gold set)."""
    ids = gold.select("gold_id").distinct()
    hit = alias_hits(gold, nodes).select("gold_id").distinct().withColumn("hit", F.lit(1))
    rows = ids.join(hit, "gold_id", "left")
    return rows.agg(F.count("hit").alias("found"), F.count(F.lit(1)).alias("total"), F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0)).alias("recall"))


def relation_recall(gold: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row as entity_recall. ``gold``: gold_id, source_any, target_any (arrays of aliases), relation; ``edges``: src, dst,
    relation. Either direction counts.

    Aliases, each looked up once however many gold rows have it, are put in the place of edges' ends, and gold rows then meet
    (source alias, target alias, relation): edges of a node never meet all gold rows of that node.
    """
    gold = materialize(gold.select("gold_id", "source_any", "target_any", F.lower("relation").alias("relation")), "gold")
    e = materialize(edges.select("src", "dst", F.lower("relation").alias("relation")).distinct(), "relations")
    ends = {}
    for side in ("source_any", "target_any"):
        aliases = gold.select(F.explode(side).alias("alias")).distinct()
        ends[side] = materialize(alias_hits(aliases.select(F.col("alias").alias("gold_id"), "alias"), nodes).select(F.col("gold_id").alias(side), "node"), "aliases")
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "relation"))
    named = both.join(ends["source_any"].withColumnRenamed("node", "src"), "src").join(ends["target_any"].withColumnRenamed("node", "dst"), "dst")
    want = gold.select("gold_id", F.explode("source_any").alias("source_any"), "target_any", "relation").withColumn("target_any", F.explode("target_any"))
    hit = want.join(named.select("source_any", "target_any", "relation"), ["source_any", "target_any", "relation"], "left_semi").agg(F.countDistinct("gold_id").alias("found"))
    total = gold.agg(F.countDistinct("gold_id").alias("total"))
    recall = F.when(F.col("total") > 0, F.col("found") / F.col("total")).otherwise(1.0)
    return hit.crossJoin(total).select("found", "total", recall.alias("recall"))  # one row each
