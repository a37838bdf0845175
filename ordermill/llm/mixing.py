"""Mixing sources to target weights, as a min-cost flow from documents' membership patterns to source quotas.

Documents are added up by the set of sources they belong to. A pattern can give its words once for nothing, a second
and a third time at rising cost; a source takes words from the patterns it is part of up to its quota. The cost of a
word depends only on how often its document has been given already, so the cheapest flow is found tier by tier: all
that first copies can give, then second, then third ones, each by augmenting the flow so far.

Flow only runs within groups of sources that some pattern ties together, each group in a task of its own; a source
whose patterns are of that source alone gives what its quota takes, which Spark SQL works out for any number of
sources. The driver sees two numbers a round of sharing out the targets, however many sources there are.

Within a pattern whole copies go to all documents, and the rest to documents in a seeded order until its words are
reached. That order is a digest of the seed and the id; its first digits make buckets whose sums tell where the rest
ends, and only the documents of that one bucket are put in a row.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.ordering import numbered
from ordermill.llm.store import written

# The contract's weights in turn, and the most copies of a document.
WEIGHTS = (1, 2, 3)
COPIES = 3
SEED = "mix"
#: Hexadecimal digits of a document's place that make its bucket.
DIGITS = 4
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: dict, weights: dict, total: int, copies: int = COPIES) -> dict:
    """Shares of ``total`` by weight, none above ``copies`` times its size; what is over goes to the others by weight."""
    out, left, open_sources = {}, total, set(sizes)
    while open_sources:
        whole = sum(weights[s] for s in open_sources)
        full = {s for s in open_sources if left * weights[s] > copies * sizes[s] * whole}
        if not full:
            return out | {s: left * weights[s] / whole for s in open_sources}
        out |= {s: float(copies * sizes[s]) for s in full}
        left -= sum(copies * sizes[s] for s in full)
        open_sources -= full
    return out


def cheapest_flow(patterns: list[tuple[tuple, int]], quotas: dict, copies: int = COPIES) -> list[dict]:
    """Words that each pattern gives each of its sources: as many as the quotas take, in the fewest repetitions."""
    sources = sorted(quotas, key=lambda s: (s is None, s or ""))
    at = {s: k for k, s in enumerate(sources)}
    room, given = [quotas[s] for s in sources], [{} for _ in patterns]
    members = [[at[s] for s in own] for own, _ in patterns]
    givers: list[set] = [set() for _ in sources]
    for _ in range(copies):
        spare = [size for _, size in patterns]
        while True:
            # breadth first from patterns with spare words over sources, and back over words given, to one with room
            came: dict = {("p", p): None for p, left in enumerate(spare) if left and members[p]}
            queue, end = deque(came), None
            while queue and end is None:
                kind, k = node = queue.popleft()
                for step in members[k] if kind == "p" else givers[k]:
                    following = ("s" if kind == "p" else "p", step)
                    if following not in came:
                        came[following] = node
                        if following[0] == "s" and room[step] > 0:
                            end = following
                            break
                        queue.append(following)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            amount = min([spare[path[0][1]], room[end[1]], *(given[b][a] for (kind, a), (_, b) in zip(path, path[1:]) if kind == "s")])
            spare[path[0][1]] -= amount
            room[end[1]] -= amount
            for (kind, a), (_, b) in zip(path, path[1:]):
                p, s, change = (a, b, amount) if kind == "p" else (b, a, -amount)
                given[p][s] = given[p].get(s, 0) + change
                givers[s].add(p)
                if not given[p][s]:
                    del given[p][s]
                    givers[s].discard(p)
    return [{sources[s]: n for s, n in own.items()} for own in given]


def pattern_key(sources: Column) -> Column:
    """A text that is equal for equal sets of sources; a null source is a source like others."""
    named = F.transform(F.array_distinct(sources), lambda s: F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.coalesce(F.array_join(F.array_sort(named), ""), F.lit(""))


def source_goals(patterns: DataFrame, weights=WEIGHTS, copies: int = COPIES) -> DataFrame:
    """``source, number, source_size, target`` of every source of the stored ``pattern, members, size``.

    Sources are numbered in the order of code points, null last, by ranges. Targets are shared out in rounds: sources
    whose share is above ``copies`` times their size stop there, and what is over goes to the others, until none is.
    """
    big = "decimal(38,0)"
    each = patterns.select(F.explode("members").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("source_size"))
    keys = [F.col("source").isNull().asc(), F.col("source").asc()]
    order = numbered(written(each, "mixing-sources"), keys, "mixing-order").withColumnRenamed("row_number", "number")
    cycle = F.array(*[F.lit(w) for w in weights])
    order = written(order.withColumn("weight", F.get(cycle, (F.col("number") % len(weights)).cast("int"))), "mixing-weights")
    cap, weight = F.col("source_size").cast(big) * copies, F.col("weight").cast(big)
    total = patterns.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    left, open_weight = total, order.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    while True:
        full = F.lit(left).cast(big) * weight > cap * F.lit(open_weight).cast(big)
        found = order.where(full).agg(F.coalesce(F.sum(cap), F.lit(0)).alias("cap"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
        fewer, lighter = total - int(found["cap"]), order.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0] - found["weight"]
        if (fewer, lighter) == (left, open_weight):
            break
        left, open_weight = fewer, lighter
    share = F.lit(left).cast("double") * F.col("weight") / F.lit(open_weight or 1)
    target = F.when(full, (F.col("source_size") * copies).cast("double")).otherwise(share)
    return order.select("source", "number", "source_size", target.alias("target"))


def _flow_of(copies: int):
    def flowed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pattern")
        patterns = [(tuple(str(n) for n in own), int(size)) for own, size in zip(group["numbers"], group["size"])]
        quotas = {str(n): int(q) for own, room in zip(group["numbers"], group["quotas"]) for n, q in zip(own, room)}
        out = [sum(given.values()) for given in cheapest_flow(patterns, quotas, copies)]
        return pd.DataFrame({"pattern": group["pattern"], "words_out": out})

    return flowed


def _tied(members: DataFrame) -> DataFrame:
    """``number, tie``: the sources that patterns of several sources tie together, and the least number of their group.

    ``members`` is a stored ``pattern, number``. Least numbers go from sources to patterns and back until none changes.
    """
    several = members.join(members.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pattern"), "pattern")
    edges = written(several, "mixing-edges")
    ties = written(edges.select("number").distinct().withColumn("tie", F.col("number")), "mixing-ties")
    while True:
        least = edges.join(ties, "number").groupBy("pattern").agg(F.min("tie").alias("least"))
        after = edges.join(least, "pattern").groupBy("number").agg(F.min("least").alias("least")).join(ties, "number")
        after = written(after.select("number", "tie", F.least("least", "tie").alias("least")), "mixing-ties")
        if after.where("least < tie").isEmpty():
            return ties
        ties = after.select("number", F.col("least").alias("tie"))


def mixing_plan(docs: DataFrame, weights=WEIGHTS, copies: int = COPIES, seed: str = SEED) -> DataFrame:
    """What every pattern of the stored ``docs`` (id, sources, size) gives: ``pattern, source_size, target, whole, rest, edge, before``.

    ``whole`` copies of all its documents, and ``rest`` words more, which end within the bucket ``edge`` of the seeded
    order, ``before`` words from its beginning.
    """
    placed = _placed(docs, seed)
    members = F.array_sort(F.array_distinct("sources")).alias("members")
    patterns = written(placed.groupBy("pattern", members).agg(F.sum("size").alias("size")), "mixing-patterns")
    goals = written(source_goals(patterns, weights, copies), "mixing-goals")
    quota = F.bround("target", 0).cast("bigint").alias("quota")

    spread = patterns.select("pattern", "size", F.posexplode("members").alias("at", "source"))
    same = F.col("source").eqNullSafe(F.col("name"))
    named = goals.select(F.col("source").alias("name"), "number", "source_size", "target", quota)
    known = written(spread.join(named, same).drop("name", "source"), "mixing-members")
    first = known.where("at = 0").select("pattern", "source_size", "target")
    ties = _tied(known.select("pattern", "number"))
    tied = known.join(ties, "number").groupBy("tie", "pattern", "size").agg(F.collect_list("number").alias("numbers"), F.collect_list("quota").alias("quotas"))
    flowed = tied.groupBy("tie").applyInPandas(_flow_of(copies), "pattern string, words_out bigint")
    alone = known.join(ties, "number", "left_anti").select("pattern", F.least("quota", F.col("size") * copies).alias("words_out"))
    planned = patterns.select("pattern", "size").join(first, "pattern", "left").join(alone.unionByName(flowed), "pattern", "left")
    some = F.col("size") > 0
    words_out = F.coalesce("words_out", F.lit(0))
    planned = planned.select(
        "pattern",
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        F.when(some, F.floor(words_out / F.col("size")).cast("bigint")).otherwise(0).alias("whole"),
        F.when(some, words_out % F.col("size")).otherwise(0).alias("rest"),
    )
    # running sums over the buckets: within those of one first digit pair, and over these pairs
    each = placed.groupBy("pattern", F.substring("bucket", 1, 2).alias("head"), "bucket").agg(F.sum("size").alias("words"))
    heads = each.groupBy("pattern", "head").agg(F.sum("words").alias("words"))
    earlier = Window.partitionBy("pattern").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("pattern", "head", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("so_far"))
    run = Window.partitionBy("pattern", "head").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (
        each.withColumn("inside", F.sum("words").over(run))
        .join(heads, ["pattern", "head"])
        .withColumn("upto", F.col("so_far") + F.col("inside"))
        .join(planned.select("pattern", "rest"), "pattern")
        .where((F.col("rest") > 0) & (F.col("upto") >= F.col("rest")))
        .groupBy("pattern")
        .agg(F.min_by(F.struct(F.col("bucket").alias("edge"), (F.col("upto") - F.col("words")).alias("before")), "bucket").alias("e"))
        .select("pattern", "e.edge", "e.before")
    )
    return planned.join(edge, "pattern", "left")


def _placed(docs: DataFrame, seed: str) -> DataFrame:
    return (
        docs.withColumn("pattern", pattern_key(F.col("sources")))
        .withColumn("place", F.md5(F.concat(F.lit(seed + ":"), F.coalesce("id", F.lit("null"))).cast("binary")))
        .withColumn("bucket", F.substring("place", 1, DIGITS))
    )


def decided(docs: DataFrame, plan: DataFrame, size: Column, some: Column, copies: int = COPIES, seed: str = SEED) -> DataFrame:
    """``docs`` (id, sources, ...) with ``repeats``, ``source_size`` and ``target`` by a stored ``mixing_plan``.

    ``size`` is only worked out for the documents of each pattern's last bucket, ``some`` (has any words) for all. The
    plan is dealt out over the first digits of the seeded order, so a pattern of very many documents is no hot key.
    """
    salt = F.substring("bucket", 1, 1)
    salts = F.explode(F.array(*[F.lit(c) for c in "0123456789abcdef"]))
    joined = _placed(docs, seed).withColumn("salt", salt).join(plan.withColumn("salt", salts), ["pattern", "salt"]).drop("salt")
    sure = joined.where("edge is null or bucket != edge").withColumn("extra", F.coalesce((F.col("bucket") < F.col("edge")).cast("bigint"), F.lit(0)))
    row = Window.partitionBy("pattern").orderBy("place", "id", "words").rowsBetween(Window.unboundedPreceding, -1)
    near = joined.where("bucket = edge").withColumn("words", size)
    so_far = F.col("before") + F.coalesce(F.sum("words").over(row), F.lit(0))
    near = near.withColumn("extra", (2 * so_far + F.col("words") <= 2 * F.col("rest")).cast("bigint")).drop("words")
    out = sure.unionByName(near)
    repeats = F.when(some, F.col("whole") + F.col("extra")).otherwise(F.least("whole", F.lit(1)))
    return out.withColumn("repeats", F.least(repeats, F.lit(copies)).cast("bigint")).drop(
        "pattern", "place", "bucket", "whole", "rest", "edge", "before", "extra"
    )


def mixed(docs: DataFrame, weights=WEIGHTS, copies: int = COPIES, seed: str = SEED) -> DataFrame:
    """Adds ``source_size``, ``target``, ``repeats`` and ``taken`` to ``docs`` of id, sources (an array) and size.

    ``docs`` is read several times, so it should be a stored table; columns are ``id`` (text), ``sources``, ``size`` and
    any others. Source size and target of a document are those of its first source.
    """
    plan = written(mixing_plan(docs.select("id", "sources", "size"), weights, copies, seed), "mixing-plan")
    out = decided(docs, plan, F.col("size"), F.col("size") > 0, copies, seed)
    return out.withColumn("taken", F.col("repeats") * F.col("size"))


def _sized(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, F.col("doc_id").cast("string").alias("id"), F.array("source").alias("sources"), words(F.col("text")).alias("size"))


def mixture(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): its size in words, its source's size and target, and
    the words the mix takes of it.

    Null texts have no words and are never taken; a null source is a source of its own, the last; rows of equal id
    have the same place in the seeded order. There may be any number of sources, and texts of any length, as only
    their sizes are kept. Without any words all targets are 0. An empty table gives no rows; other columns aren't
    looked at.
    """
    return mixed(written(_sized(docs, "doc_id"), "mixing")).select("doc_id", "size", "source_size", "target", "taken")


def drawn(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns and ``repeats``, the copies of each.

    A column ``repeats`` of ``docs`` is replaced. Words are counted once, into a slim table that the plan is made of;
    the rows then only meet the plan. Nulls, ties and empty tables are as in ``mixture``.
    """
    plan = written(mixing_plan(written(_sized(docs), "mixing")), "mixing-plan")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("string").alias("id"), F.array("source").alias("sources")
    )
    some = F.coalesce(F.rlike("row.text", F.lit(WORD)), F.lit(False))
    out = decided(rows, plan, words(F.col("row.text")), some).where(some & (F.col("repeats") > 0))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "repeats"], "repeats")


ORACLE = f"""
with recursive d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    md5('{SEED}:' || coalesce(doc_id::varchar, 'null')) as place
  from documents),
s as (
  select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
  from d group by source),
ordered as (
  select *, row_number() over (order by {COPIES} * source_size / weight, source nulls last) as k,
    {COPIES} * source_size as cap from s),
cums as (
  select *, (select sum(size) from d) - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0) as left_over,
    sum(weight) over (order by k rows between current row and unbounded following) as weight_left from ordered),
level as (
  select arg_min(left_over, k) as left_over, arg_min(weight_left, k) as weight_left, min(k) as k
  from cums where cap * weight_left >= left_over * weight),
goal as (
  select o.source, o.source_size,
    case when o.k < l.k then o.cap::double else l.left_over::double * o.weight / l.weight_left end as target
  from ordered o, level l),
quota as (
  select *, (case when source_size > 0 then round_even(target, 0)::bigint // source_size else 0 end) as whole,
    (case when source_size > 0 then round_even(target, 0)::bigint % source_size else 0 end) as rest from goal),
placed as (
  select d.doc_id, d.size, q.source_size, q.target, q.whole, q.rest,
    coalesce(sum(d.size) over (partition by d.source order by d.place, d.doc_id::varchar, d.size rows between unbounded preceding and 1 preceding), 0) as so_far
  from d join quota q on d.source is not distinct from q.source)
select doc_id, size, source_size, target,
  (size * least({COPIES}, whole + case when rest > 0 and 2 * so_far + size <= 2 * rest then 1 else 0 end))::bigint as taken
from placed"""
