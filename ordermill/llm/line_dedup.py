"""Removal of repeated runs of lines, by a suffix array over sequences of line ids.

Every line that isn't blank has an id, the first half of the SHA-256 of its bytes; a document is the sequence of its
ids. The suffixes of all sequences are ordered by distributed prefix doubling: they are sorted by ranges of their first
id, then those still tied at depth h by their rank and that of the suffix h lines on, until no two are tied. A rank is the
place at which a suffix's group of ties begins, so it stays when the group is split, and a suffix that is alone has its
place in the suffix array. (A sequence that ends comes before all that go on; ends are told apart by their sequence.)

Where a round splits a group, the two suffixes beside the cut are neighbours in the suffix array whose common prefix has
h lines or more, and less than 2h. Its length is found by going down the depths: at h/2, h/4, ... it grows by the depth
if what follows in both has the same rank there. Places in a row whose common prefixes have ``MIN_LINES`` lines or more
make up an interval. All members of an interval but the first, by document id and line, begin a later copy; copies that
follow each other line by line make up a maximal repeated run, and its lines are deleted. A single line is a run of its
own if it has ``MIN_WORDS`` words: the intervals of common prefixes of one line or more.

Documents of the same sequence are sorted once: those with larger ids than the first lose every line that is in a run.
A suffix that is alone isn't sorted again, and sequences without ties leave, so each round moves only what is still tied
and what stands beside it. No task holds all members of a group: ranges cut through them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.ordering import in_ranges
from ordermill.llm.store import dropped, scratch, written

#: Lines that a repeated run has at least, and words that a run of one line has at least.
MIN_LINES = 2
MIN_WORDS = 5
#: The order of documents without an id: after all others.
LAST = (1 << 63) - 1
BLANK = r"\x20\x09-\x0D"


def _words_at_least(line: Column, n: int) -> Column:
    """Whether a line has ``n`` words; the match stops at the last of them and never goes back."""
    return line.rlike(rf"^[{BLANK}]*+(?:[^{BLANK}]++[{BLANK}]++){{{n - 1}}}[^{BLANK}]" if n > 1 else rf"[^{BLANK}]")


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``docs`` (text, ...) with ``entries``, the numbered lines of the text, and ``longs``, for each that isn't blank whether it has ``min_words``."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    entries = docs.withColumn("entries", F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"), _words_at_least(x, 1).alias("solid"))))
    return entries.withColumn("longs", F.transform(F.filter("entries", lambda e: e["solid"]), lambda e: _words_at_least(e["x"], min_words)))


def _sequences(docs: DataFrame, min_words: int) -> DataFrame:
    """``docs`` (text, ...) with ``ids`` of the lines that aren't blank, and ``digest`` of all ids."""
    solid = F.filter("entries", lambda e: e["solid"])
    ids = F.zip_with(solid, "longs", lambda e, long: F.struct(F.unhex(F.substring(F.sha2(e["x"], 256), 1, 32)).alias("id"), long.alias("long")))
    found = _lines(docs, min_words).withColumn("ids", ids).drop("entries", "longs")
    return found.withColumn("digest", F.unhex(F.sha2(F.array_join(F.transform("ids", lambda x: F.hex(x["id"])), ""), 256)))


def _ranked(suffixes: DataFrame, key: str, name: str) -> DataFrame:
    """Suffixes (d, ord, k, long, rank, key), tied by ``rank``, with the rank that ``key`` gives them within their ties.

    ``alone``: no other has that rank; ``cut``: the first of its new rank, but not of its old one; then ``e, m`` are
    sequence and line of the suffix before it. A null key is like no other.
    """
    dealt = in_ranges(suffixes, [F.col(c).asc() for c in ("rank", key, "d", "k")], f"{name}-sorted")
    cell = F.struct("rank", key, "d", "k")
    own, parts = Window.partitionBy("part").orderBy("at"), Window.orderBy("part")
    # one row for each range, of which there are at most as many as shuffle partitions
    ends = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min_by(cell, "at").alias("first"), F.max_by(cell, "at").alias("last"))
    before = F.coalesce(F.sum("rows").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select("part", before.alias("before"), F.lag("last").over(parts).alias("earlier"), F.lead("first").over(parts).alias("later"))
    beside = {"prior": F.coalesce(F.lag(cell).over(own), F.col("earlier")), "next": F.coalesce(F.lead(cell).over(own), F.col("later"))}
    met = dealt.join(F.broadcast(ends), "part").withColumns(beside).withColumn("place", F.col("before") + F.col("at"))
    tied = F.coalesce(F.col("prior.rank") == F.col("rank"), F.lit(False))
    same = {c: F.coalesce((F.col(f"{c}.rank") == F.col("rank")) & (F.col(f"{c}.{key}") == F.col(key)), F.lit(False)) for c in beside}
    flagged = met.select(
        "part", "place", "d", "ord", "k", "long", "rank", (~same["prior"] & ~same["next"]).alias("alone"), (tied & ~same["prior"]).alias("cut"),
        F.col("prior.d").alias("e"), F.col("prior.k").alias("m"), (~tied).alias("opens"), (~same["prior"]).alias("begins"),
    )
    started = _started(flagged, ["opens", "begins"], name)
    out = written(started.withColumn("rank", F.col("rank") + F.col("begins") - F.col("opens")).drop("part", "place", "opens", "begins"), name)
    dropped(dealt)
    return out


def _started(placed: DataFrame, marks: list[str], name: str) -> DataFrame:
    """``placed`` (part, place, ...) with each of ``marks`` replaced by the last place up to a row's own at which it holds."""
    flagged = written(placed.withColumns({c: F.when(F.col(c), F.col("place")) for c in marks}), f"{name}-marks")
    upto = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = flagged.groupBy("part").agg(*[F.max(c).alias(c) for c in marks]).select("part", *[F.max(c).over(parts).alias(f"{c}_before") for c in marks])
    started = {c: F.coalesce(F.max(c).over(upto), F.col(f"{c}_before")) for c in marks}
    return flagged.join(F.broadcast(ends), "part").withColumns(started).drop(*[f"{c}_before" for c in marks])


def _doubled(ranked: DataFrame, others: DataFrame | None, depth: int) -> DataFrame:
    """All suffixes of sequences that still have ties, with ``second``, the rank of the suffix ``depth`` lines on."""
    every = ranked.select("d", "ord", "k", "long", "rank", "alone")
    if others is not None:
        every = every.unionByName(others.where("alone").drop("second"))
    own = Window.partitionBy("d").orderBy("k")
    ahead = {"second": F.first("rank").over(own.rangeBetween(depth, depth)), "open": F.max(~F.col("alone")).over(Window.partitionBy("d"))}
    return written(every.withColumns(ahead).where("open").drop("open"), f"lines-{depth}-pairs")


def _common_prefixes(rounds: list[DataFrame]) -> DataFrame:
    """``place`` and ``lcp``, the lines that the suffix at a place has in common with the one before, where there are any.

    ``rounds`` are the ranks at depth 1, 2, 4, ...
    """
    cuts = [r.where("cut").select(F.col("rank").alias("place"), "d", "k", "e", "m", F.lit(1 << t).cast("bigint").alias("lcp")) for t, r in enumerate(rounds[1:])]
    if not cuts:
        return rounds[0].select(F.col("rank").alias("place"), F.lit(0).cast("bigint").alias("lcp")).limit(0)
    # those that a round has split wait until the depths below that of their round
    pairs = cuts[-1]
    for t in range(len(cuts) - 2, -1, -1):
        names = rounds[t].where("not alone")
        here = names.select("d", F.col("k").alias("k_on"), F.col("rank").alias("rank_d"))
        there = names.select(F.col("d").alias("e"), F.col("k").alias("m_on"), F.col("rank").alias("rank_e"))
        ahead = pairs.withColumns({"k_on": F.col("k") + F.col("lcp"), "m_on": F.col("m") + F.col("lcp")})
        met = ahead.join(here, ["d", "k_on"], "left").join(there, ["e", "m_on"], "left")
        longer = F.when(F.col("rank_d") == F.col("rank_e"), F.lit(1 << t)).otherwise(F.lit(0))
        pairs = written(met.select("place", "d", "k", "e", "m", (F.col("lcp") + longer).alias("lcp")), f"lines-{1 << t}-common").unionByName(cuts[t])
    return pairs.select("place", "lcp")


def suffix_array(sequences: DataFrame) -> DataFrame:
    """From sequences (d, ord, ids): ``place, d, ord, k, long`` of every suffix, and its ``lcp`` with that of the place before.

    Suffixes whose first line stands nowhere else, and have nothing in common with any, are left out; their places stay free.
    """
    lines = sequences.select("d", "ord", F.posexplode("ids").alias("at", "line")).select("d", "ord", F.col("at").cast("bigint").alias("k"), "line.id", "line.long")
    rounds, state = [_ranked(lines.withColumn("rank", F.lit(0).cast("bigint")), "id", "lines-1")], None
    while not rounds[-1].where("not alone").isEmpty():
        depth = 1 << (len(rounds) - 1)
        state = _doubled(rounds[-1], state, depth)
        rounds.append(_ranked(state.where("not alone").drop("alone"), "second", f"lines-{2 * depth}"))
    done = [r.where("alone").select(F.col("rank").alias("place"), "d", "ord", "k", "long") for r in (rounds[1:] or rounds)]
    every = done[0]
    for own in done[1:]:
        every = every.unionByName(own)
    return every.join(_common_prefixes(rounds), "place", "left").withColumn("lcp", F.coalesce("lcp", F.lit(0)))


def _later(members: DataFrame, interval: str) -> DataFrame:
    """The suffixes that aren't the first of their interval, by document id and line."""
    least = members.groupBy(interval).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("least")).where("n > 1").drop("n")
    own = Window.partitionBy("d", interval).orderBy("k")
    return members.join(least, interval).withColumn("nth", F.row_number().over(own)).where("ord > least or nth > 1")


def repeated_lines(sequences: DataFrame, min_lines: int) -> DataFrame:
    """From sequences (d, ord, ids), ``d`` telling them apart: ``d`` and ``gone``, the places of lines in later copies.

    Sequences that lose nothing have no row.
    """
    placed = in_ranges(written(suffix_array(sequences), "line-suffixes"), [F.col("place").asc()], "line-array").drop("at")
    marked = placed.withColumns({"one": F.col("lcp") < 1, "run": F.col("lcp") < min_lines}).drop("lcp")
    members = written(_started(marked, ["one", "run"], "line-array"), "line-intervals")
    hits = _later(members, "run").select("d", F.explode(F.sequence("k", F.col("k") + F.lit(min_lines - 1))).alias("k"))
    if min_lines > 1:
        hits = hits.unionByName(_later(members.where("long"), "one").select("d", "k"))
    return hits.groupBy("d").agg(F.array_sort(F.collect_set("k")).alias("gone"))


def line_runs(docs: DataFrame, kept: list[str], min_lines: int, min_words: int) -> DataFrame:
    """Columns ``kept`` of ``docs`` in a struct ``row``, counts, and the remaining ``text``."""
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("ord")
    rows = _sequences(docs.select(row, order, F.col("text").cast("string").alias("text")), min_words)
    with scratch(docs.sparkSession):
        distinct = rows.where(F.size("ids") > 0).groupBy("digest").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("copies"), F.first("ids").alias("ids"))
        stored = written(distinct.withColumn("d", F.monotonically_increasing_id()), "line-sequences")
        own = written(repeated_lines(stored.select("d", "ord", "ids"), min_lines), "line-copies")
        found = stored.select("d", "digest", F.col("ord").alias("first"), "copies").join(own, "d", "left").where("copies > 1 or gone is not null")
        # only a copy of a sequence with a larger id than the first loses lines that the first keeps
        in_runs = F.filter(
            F.transform("longs", lambda long, k: F.when((F.size("longs") >= min_lines) | long, k.cast("bigint"))), lambda k: k.isNotNull()
        )
        gone = F.when(F.col("ord") > F.col("first"), in_runs).otherwise(F.coalesce("gone", F.array().cast("array<bigint>")))
        # texts are cut into lines again, so that these don't move beside them
        met = rows.drop("ids").join(found.drop("d", "copies").hint("shuffle_hash"), "digest", "left").transform(_lines, min_words).withColumn("gone", gone)
        flags = F.concat(
            F.flatten(F.transform("gone", lambda g, i: F.concat(F.array_repeat(F.lit(False), (g - F.when(i > 0, F.get("gone", i - 1)).otherwise(-1) - 1).cast("int")), F.array(F.lit(True))))),
            F.array_repeat(F.lit(False), (F.size("longs") - 1 - F.when(F.size("gone") > 0, F.element_at("gone", -1)).otherwise(-1)).cast("int")),
        )
        flagged = met.withColumn("flags", F.when(F.size("gone") > 0, flags))
        # zipped, as an expression looked up within a lambda may be worked out for each element
        solid = F.filter(F.zip_with(F.filter("entries", lambda e: e["solid"]), "flags", lambda e, f: F.when(~f, e)), lambda e: e.isNotNull())
        rest = F.array_sort(F.concat(F.filter("entries", lambda e: ~e["solid"]), solid))
        out = flagged.select(
            "row",
            F.size("longs").cast("bigint").alias("n_lines"),
            F.size("gone").cast("bigint").alias("n_deleted"),
            F.size(F.filter("gone", lambda g, i: (i == 0) | (F.get("gone", i - 1) != g - 1))).cast("bigint").alias("n_runs"),
            F.when(F.size("gone") > 0, F.array_join(F.transform(rest, lambda e: e["x"]), "\n")).otherwise(F.col("text")).alias("text"),
        )
        return written(out, "line-dedup", keep=True)


def line_report(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its lines that aren't blank, those deleted, the maximal runs
    these make, and the digest of the remaining text.

    A line is deleted if it lies in a run of ``min_lines`` lines (blank ones not counted) that also begins earlier, in
    a document with a smaller id or further up in the same one, or if it has ``min_words`` words and stands earlier
    itself. Blank lines stay. Null texts have no lines; a null id counts as larger than all others; rows of equal id
    leave each other alone. Empty tables give no rows. A text is handled whole, as one row, whatever its length; its
    lines are rows of their own in between.
    """
    found = line_runs(docs, ["doc_id"], min_lines, min_words)
    return found.select("row.doc_id", "n_lines", "n_deleted", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from ``text`` and, where there is a column ``n_chars``, that set anew.

    Documents of which no line is left, having had some, go; documents without lines stay as they are.
    """
    others = [c for c in docs.columns if c != "text"]
    found = line_runs(docs, others, min_lines, min_words).where("n_lines = 0 or n_deleted < n_lines")
    fresh = {"text": F.col("text"), "n_chars": F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("row.n_chars")) if "n_chars" in others else None}
    return found.select(*[(fresh[c] if c in fresh else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


ORACLE = f"""
with d as (
  select row_number() over () as rid, coalesce(doc_id, 9223372036854775807) as ord, doc_id, coalesce(text, '') as text
  from documents),
every as (
  select rid, ord, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from d),
counted as (
  select *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as words from every),
solid as (
  select *, row_number() over (partition by rid order by n) as k from counted where words > 0),
pairs as (
  select *, lead(line) over (partition by rid order by k) as next from solid),
runs as (
  select rid, ord, k, 1 as depth, line as a, '' as b from pairs where words >= {MIN_WORDS}
  union all
  select rid, ord, k, 2, line, next from pairs where next is not null),
ranked as (
  select *, row_number() over (partition by depth, a, b order by ord, k) as copy from runs),
hit as (
  select distinct rid, k + extra as k from ranked, (values (0), (1)) as e(extra) where copy > 1 and extra < depth),
marked as (
  select s.*, h.k is not null as gone from solid s left join hit h on s.rid = h.rid and s.k = h.k),
begun as (
  select *, gone and not coalesce(lag(gone) over (partition by rid order by k), false) as begins from marked),
counts as (
  select rid, count(*) as n_lines, count(*) filter (gone) as n_deleted, count(*) filter (begins) as n_runs from begun group by rid),
kept as (
  select e.rid, string_agg(e.line, chr(10) order by e.n) as text
  from every e left join marked m on e.rid = m.rid and e.n = m.n where m.gone is null or not m.gone group by e.rid)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_deleted, 0)::bigint as n_deleted,
  coalesce(n_runs, 0)::bigint as n_runs, sha256(coalesce(kept.text, '')) as kept_sha256
from d left join counts using (rid) left join kept using (rid)"""
