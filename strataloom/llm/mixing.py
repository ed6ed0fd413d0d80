"""Mixing sources to target weights, by hierarchical budgets. Built-in DataFrame functions only.

A token budget runs down a domain-language-source tree. Each parent's budget is shared among its children by weight; a
child that can't use its share (its tokens times ``max_epochs``) is filled, and the shortage is spread over its siblings by
weight (water filling). A parent holds at most what its children can, so only a shortage that no sibling can take moves
up to the parent's own siblings. Each leaf then takes whole epochs of its documents and, of the next epoch's seeded
order, the prefix that reaches its budget (a document is taken while the tokens before it are fewer than what is left).

The prefix is found without sorting a leaf: tokens are summed by leaf and by the first two hex digits of the order key,
and a running sum over those at most 256 rows names the one digit group the prefix ends in. Two more steps narrow it down
in the same way, to one in 16 million of the leaf's keys, and only that group is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.blocks import fresh
from strataloom.session import materialize

LEVELS = ("domain", "lang", "source")
DIGITS, STEPS = 2, 3  # hex digits to a step, and steps


def word_count(text: str) -> Column:
    """Words parted by blanks, tabs and line ends."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def _weight(name: str, weights: Mapping[str, float]) -> Column:
    out = F.lit(1.0)
    for k, w in weights.items():
        out = F.when(F.col(name) == k, float(w)).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Budgets of children by water filling; ``nodes`` has the parent's budget, w and cap, and gains mine."""
    by = Window.partitionBy(*parent).orderBy("r", nodes.columns[len(parent)])
    rows = nodes.withColumn("r", F.col("cap") / F.col("w"))
    rows = rows.withColumns({
        "place": F.row_number().over(by),
        "lam": (F.col("budget") - F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        / F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    open_ = F.col("lam") < F.col("r")
    level = F.min_by(F.when(open_, F.col("lam")), F.when(open_, F.col("place"))).over(Window.partitionBy(*parent))
    mine = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("w"), F.col("cap").cast("double")))
    return rows.withColumn("mine", F.floor(mine)).drop("r", "place", "lam")


def leaf_budgets(supply: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, float]], max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, mine) from the tokens of each leaf. Leaves without tokens get nothing."""
    leaves = supply.where("tokens > 0").withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(budget.alias("budget"))
    found = total.select(F.lit(0).alias("root"), "budget")
    parent = ["root"]
    for k, level in enumerate(LEVELS):
        cols = [*LEVELS[: k + 1]]
        nodes = leaves.groupBy(*cols).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")).withColumn("root", F.lit(0))
        nodes = nodes.withColumn("w", _weight(level, weights.get(level, {}))).where("w > 0")
        nodes = nodes.join(found.select(*parent, "budget"), parent).select(*parent, level, *(c for c in cols[:-1] if c not in parent), "cap", "tokens", "w", "budget")
        found = _share(nodes, parent).select(*cols, "tokens", F.col("mine"), F.col("mine").alias("budget"))
        parent = cols
    return found.select(*LEVELS, "tokens", "mine")


def mix_sources(
    docs: DataFrame, domain: Column, share: float = 0.6, budget: int | None = None, weights: Mapping[str, Mapping[str, float]] | None = None,
    seed: int = 1, max_epochs: int = 4, tokens: Column | None = None, id_col: str = "doc_id",
) -> DataFrame:
    """Rows of ``docs`` as often as they are taken, with the columns domain, epoch (from 0) and n_tokens.

    ``domain`` is any column expression over ``docs``; lang and source are its columns; nulls in them count as ''. The
    budget is ``budget`` tokens, or ``share`` of all tokens. Weights are by name for each level; names that are not listed
    weigh 1, and a weight of 0 takes nothing. Null and empty texts have no tokens and are taken where the order puts them
    within a prefix or whole epoch. Rows that repeat an id stay neighbours in every order and are taken one by one; a null
    id is ordered as ''. Very long texts count whole. Tokens are words unless ``tokens`` gives another count, such as a
    column of token_counts. Existing columns of the three names are replaced, others stay whatever their names. An empty
    table gives an empty result.
    """
    base = docs.drop("domain", "epoch", "n_tokens")
    own = {x: fresh(f"__{x}", base.columns) for x in (*LEVELS, "id", "key", "whole", "digits", "left", "before")}
    count = word_count("text") if tokens is None else tokens
    leaf = {own["domain"]: F.coalesce(domain, F.lit("")), own["lang"]: F.coalesce(F.col("lang"), F.lit("")), own["source"]: F.coalesce(F.col("source"), F.lit(""))}
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))

    narrow = base.withColumns(leaf).select(*(F.col(own[x]).alias(x) for x in LEVELS), ident.alias("id"), count.alias("n"))
    narrow = materialize(narrow, "mixing")
    supply = narrow.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    goal = F.lit(budget).cast("double") if budget is not None else F.floor(F.sum("tokens") * share).cast("double")
    plan = leaf_budgets(supply, goal, weights or {}, max_epochs)
    plan = materialize(plan.withColumn("whole", F.expr("mine div tokens")).withColumn("rest", F.expr("mine % tokens")), "mixing-plan")

    def key(epoch: Column, ident: Column) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), ident).cast("binary"))

    ends = plan.where("rest > 0").select(*LEVELS, "whole", F.lit("").alias("digits"), F.col("rest").alias("left"))
    rows = narrow.join(ends.select(*LEVELS, "whole"), [*LEVELS]).select(*LEVELS, F.substring(key(F.col("whole"), F.col("id")), 1, DIGITS * STEPS).alias("key"), "n")
    rows = materialize(rows, "mixing-keys")
    for k in range(STEPS):  # the group that the prefix ends in, by a few more digits each time
        inside = rows.join(ends, [*LEVELS]).where(F.startswith("key", "digits"))
        groups = inside.groupBy(*LEVELS, "whole", "left", F.substring("key", 1, DIGITS * (k + 1)).alias("digits")).agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        groups = groups.withColumn("upto", upto).where("upto >= left").groupBy(*LEVELS, "whole")
        found = F.min_by(F.struct("digits", (F.col("left") - F.col("upto") + F.col("n")).alias("left")), "digits").alias("end")
        ends = materialize(groups.agg(found).select(*LEVELS, "whole", "end.digits", "end.left"), "mixing-ends")
    # groups before the end are taken whole, and of the end group what still fits
    cut = plan.join(ends.select(*LEVELS, "digits", "left"), [*LEVELS], "left")
    cut = materialize(cut.select(*(F.col(x).alias(own[x]) for x in LEVELS), F.col("whole").alias(own["whole"]), F.col("digits").alias(own["digits"]), F.col("left").alias(own["left"])), "mixing-cut")

    joined = base.withColumns({**leaf, own["id"]: ident}).join(cut, [own[x] for x in LEVELS])
    joined = joined.withColumn(own["key"], key(F.col(own["whole"]), F.col(own["id"])))
    digits = F.substring(own["key"], 1, DIGITS * STEPS)
    top = F.col(own["whole"]) - F.when(digits < F.col(own["digits"]), 0).otherwise(1)
    sure = joined.where(top >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), top.cast("long"))))
    edge = joined.where(digits == F.col(own["digits"])).withColumn("n_tokens", count)
    order = Window.partitionBy(*(own[x] for x in LEVELS)).orderBy(own["key"], "n_tokens", F.md5(F.coalesce("text", F.lit("")).cast("binary"))).rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.where(F.col(own["left"]) > 0).withColumn(own["before"], F.coalesce(F.sum("n_tokens").over(order), F.lit(0))).where(F.col(own["before"]) < F.col(own["left"]))
    edge = edge.withColumn("epoch", F.col(own["whole"]).cast("long"))
    out = [*base.columns, F.col(own["domain"]).alias("domain"), "epoch"]
    return sure.withColumn("n_tokens", count).select(*out, "n_tokens").unionByName(edge.select(*out, "n_tokens"))


def source_domain(source: str = "source") -> Column:
    """The domain of the synthetic sources: the crawl (src0) and three kinds of others by number."""
    n = F.expr(f"try_cast(substr({source}, 4) as int)") % 3
    return F.when(F.col(source) == "src0", "crawl").when(n == 0, "books").when(n == 1, "forums").otherwise("reference")


WEIGHTS = {"domain": {"crawl": 2, "books": 4, "forums": 3, "reference": 3}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}, "source": {"src0": 3}}


def mixture(docs: DataFrame) -> DataFrame:
    out = mix_sources(docs.select("doc_id", "text", "lang", "source"), source_domain(), weights=WEIGHTS)
    return out.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")


SHARE_SQL = """
{name}_r as (select *, cap / w as r from {nodes}),
{name}_l as (
  select *, row_number() over (partition by {parent} order by r, {level}) as place,
    (budget - coalesce(sum(cap) over (partition by {parent} order by r, {level} rows between unbounded preceding and 1 preceding), 0))
      / sum(w) over (partition by {parent} order by r, {level} rows between current row and unbounded following) as lam
  from {name}_r),
{name}_m as (select *, min(case when lam < r then place end) over (partition by {parent}) as first_open from {name}_l),
{name}_n as (select *, max(case when place = first_open then lam end) over (partition by {parent}) as lev from {name}_m),
{name} as (select *, cast(floor(least(cap, coalesce(lev * w, cap))) as bigint) as mine from {name}_n)
"""

SQL = (
    """
with docs as (
  select doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) as n,
    case when source = 'src0' then 'crawl' when try_cast(substr(source, 4) as int) % 3 = 0 then 'books'
      when try_cast(substr(source, 4) as int) % 3 = 1 then 'forums' else 'reference' end as domain,
    md5(coalesce(text, '')) as body
  from documents),
leaves as (select domain, lang, source, cast(sum(n) as double) as tokens, cast(4 * sum(n) as double) as cap from docs group by all having sum(n) > 0),
total as (select floor(sum(tokens) * 0.6) as budget from leaves),
n1 as (select 0 as root, domain, sum(cap) as cap, case domain when 'crawl' then 2.0 when 'books' then 4.0 when 'forums' then 3.0 when 'reference' then 3.0 else 1.0 end::double as w,
  (select budget from total) as budget from leaves group by domain),
"""
    + SHARE_SQL.format(name="s1", nodes="n1", parent="root", level="domain")
    + """,
n2 as (select l.domain, l.lang, sum(l.cap) as cap, case l.lang when 'en' then 6.0 when 'de' then 2.0 when 'fr' then 2.0 when 'es' then 2.0 else 1.0 end::double as w,
  any_value(s1.mine)::double as budget from leaves l join s1 on l.domain = s1.domain group by l.domain, l.lang),
"""
    + SHARE_SQL.format(name="s2", nodes="n2", parent="domain", level="lang")
    + """,
n3 as (select l.domain, l.lang, l.source, l.cap, l.tokens, case l.source when 'src0' then 3.0 else 1.0 end::double as w, s2.mine::double as budget
  from leaves l join s2 on l.domain = s2.domain and l.lang = s2.lang),
"""
    + SHARE_SQL.format(name="s3", nodes="n3", parent="domain, lang", level="source")
    + """,
plan as (select domain, lang, source, mine // cast(tokens as bigint) as whole, mine % cast(tokens as bigint) as rest from s3),
keyed as (select d.*, p.whole, p.rest, md5('1|' || p.whole || '|' || d.doc_id) as k from docs d join plan p using (domain, lang, source)),
ranked as (select *, coalesce(sum(n) over (partition by domain, lang, source order by k, n, body rows between unbounded preceding and 1 preceding), 0) as before from keyed),
copies as (select *, case when before < rest then whole + 1 else whole end as times from ranked)
select doc_id, domain, lang, source, cast(e as bigint) as epoch, cast(n as bigint) as n_tokens
from (select *, unnest(range(times)) as e from copies)
"""
)
