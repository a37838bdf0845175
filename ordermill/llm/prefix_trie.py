"""Prefix trie of conversations: every distinct beginning of one is a node, aggregated by Spark SQL's ROLLUP.

Turns have ids, the first 120 bits of a digest of role and text. A conversation lies in blocks of eight positional turn-id columns;
``GROUP BY block, node before the block, ROLLUP(t1, ..., t8)`` aggregates all prefixes of all blocks together, and
``grouping_id()`` tells how deep each is. The node before a block is named by a sum, modulo 2^30 in four lanes, of
digests of the blocks before it; sums run over ranges, so a conversation of any length is blocked without one task
that holds it. A node is known by its depth and its smallest conversation.

Sums over subtrees need no descent. The smallest member of a node owns it. Going down from a node of depth d, every
member but its owner walks over turns that others own until it comes to its own ones; with ``unowned``, the bytes up
to there, and ``before``, those of the first d - 1 turns, what is saved below the node is the sum of
``unowned - before`` over these members. A second ROLLUP adds that up, and counts the members that own a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.ordering import in_ranges
from ordermill.llm.sharding import CRC_STEPS, crc32_sql
from ordermill.llm.store import scratch, written

#: Turns of a block, each a column of the ROLLUP.
BLOCK = 8
#: Blocks of one conversation that are summed up in one window.
SPAN = 512
#: Turns of one conversation that are joined with what is known of it as one key.
CHUNK = 4096
#: Ids of ended conversations that are put together before they are hashed.
ENDS = 512
LANES = 4
LANE = 1 << 30
#: A parent with over one in so many of all links has its children joined by broadcast; there are fewer such parents than this.
HEAVY = 1000
NAMES = [f"t{k + 1}" for k in range(BLOCK)]
SUMS = [f"s{k + 1}" for k in range(LANES)]


def _hex(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def placed(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, high, low, bytes``: the place of every turn in its conversation from 1 on, its id and text length.

    Turns go by ``turn``, nulls first, and those of one number by a digest of role and text; null roles and texts are
    empty. Rows without a conversation are of none and left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    slim = conversations.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes"))
    slim = slim.select("conv_id", "turn", _hex(F.col("digest"), 1, 15).alias("high"), _hex(F.col("digest"), 16, 15).alias("low"), "bytes")
    keys = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("high").asc(), F.col("low").asc()]
    dealt = in_ranges(written(slim, "trie-turns"), keys, "trie-order")
    runs = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    position = F.col("before") + F.col("at") - F.col("first") + 1
    return written(dealt.join(runs, ["conv_id", "part"]).select("conv_id", position.alias("position"), "high", "low", "bytes"), "trie-places")


def spliced(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """``placed`` turns with the first h of every conversation replaced by those of the first one of its ``family``.

    h is the unsigned CRC-32 of the id modulo ``most``. A conversation left without turns has one row of position 0.
    """
    conv = F.col("conv_id")
    known = turns.groupBy("conv_id").agg(F.max("position").alias("n")).withColumn("h", F.crc32(conv.cast("string").cast("binary")) % most)
    known = known.withColumn("base", conv - conv % family)
    bases = known.where(conv == F.col("base")).select(F.col("conv_id").alias("base"), F.col("n").alias("offered"))
    known = known.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("offered", F.lit(0))))
    known = written(known.select("conv_id", "base", "n", "h", "lent"), "trie-heads")

    chunk = F.floor(F.col("position") / CHUNK).cast("bigint")
    chunks = known.select("conv_id", "h", "lent", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / CHUNK).cast("bigint"))).alias("chunk"))
    own = turns.withColumn("chunk", chunk).join(chunks, ["conv_id", "chunk"]).where("position > h")
    own = own.withColumn("position", F.col("position") - F.col("h") + F.col("lent")).select(*turns.columns)
    heads = turns.where((conv == conv - conv % family) & (F.col("position") < most)).withColumnRenamed("conv_id", "base")
    lent = known.select("conv_id", "base", "lent").join(heads, "base").where("position <= lent").select(*turns.columns)
    none = F.lit(None).cast("bigint")
    empty = known.where("n <= h and lent = 0").select("conv_id", F.lit(0).cast("bigint").alias("position"), none.alias("high"), none.alias("low"), none.alias("bytes"))
    return own.unionByName(lent).unionByName(empty)


def blocked(turns: DataFrame) -> DataFrame:
    """Conversations in blocks: ``conv_id, block, span, s1..s4, start, size, last, total, t1..t8``.

    ``s1..s4`` name the node before the block, ``start`` is the bytes of its turns, ``size`` the turns of the block,
    ``last`` tells whether the conversation ends in it, ``total`` is the bytes to its end. A turn column is a struct of
    the turn's id and the bytes of the conversation up to and with it.
    """
    at = F.greatest(F.col("position") - 1, F.lit(0))
    spot, block = at % BLOCK, ((at - at % BLOCK) / BLOCK).cast("bigint")
    cells = []
    for k, name in enumerate(NAMES):
        here = spot == k
        cells += [F.max(F.when(here, F.col(c))).alias(f"{name}_{c}") for c in ("high", "low", "bytes")]
    span = ((F.col("block") - F.col("block") % SPAN) / SPAN).cast("bigint")
    rows = turns.withColumn("block", block).withColumn("span", span).repartition("conv_id", "span")
    rows = rows.groupBy("conv_id", "span", "block").agg(F.count("high").alias("size"), *cells)
    ids = [F.concat_ws(".", f"{t}_high", f"{t}_low") for t in NAMES]
    rows = rows.withColumn("digest", _block_digest(F.col("block"), ids))
    rows = rows.withColumn("bytes", sum((F.coalesce(f"{t}_bytes", F.lit(0)) for t in NAMES), F.lit(0).cast("bigint")))
    inside = Window.partitionBy("conv_id", "span").orderBy("block")
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    for k, name in enumerate(SUMS):
        rows = rows.withColumn(f"{name}_own", _lane(F.col("digest"), k))
        rows = rows.withColumn(name, F.coalesce(F.sum(f"{name}_own").over(so_far), F.lit(0)))
    rows = rows.withColumn("start", F.coalesce(F.sum("bytes").over(so_far), F.lit(0)))
    rows = written(rows.withColumn("next", F.lead("block").over(inside)).drop("digest"), "trie-blocks")

    # only conversations of several spans have sums to carry on
    spans = rows.groupBy("conv_id", "span").agg(F.sum("bytes").alias("bytes"), *[F.sum(f"{s}_own").alias(s) for s in SUMS])
    by_span = Window.partitionBy("conv_id").orderBy("span")
    before = by_span.rowsBetween(Window.unboundedPreceding, -1)
    giants = spans.withColumn("spans", F.count(F.lit(1)).over(Window.partitionBy("conv_id"))).where("spans > 1")
    giants = giants.select(
        "conv_id",
        "span",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start_before"),
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before") for s in SUMS],
        F.lead("span").over(by_span).isNotNull().alias("goes_on"),
    )
    rows = rows.join(giants, ["conv_id", "span"], "left")
    upto, turns_of = F.col("start") + F.coalesce("start_before", F.lit(0)), []
    out = rows.withColumn("start", upto)
    total = F.col("start")
    for name in NAMES:
        total = total + F.coalesce(f"{name}_bytes", F.lit(0))
        id_ = F.struct(F.col(f"{name}_high").alias("high"), F.col(f"{name}_low").alias("low"), total.alias("upto"))
        turns_of.append(F.when(F.col(f"{name}_high").isNotNull(), id_).alias(name))
    sums = [((F.col(s) + F.coalesce(f"{s}_before", F.lit(0))) % LANE).alias(s) for s in SUMS]
    last = F.col("next").isNull() & ~F.coalesce("goes_on", F.lit(False))
    return written(out.select("conv_id", "block", "span", *sums, "start", "size", last.alias("last"), total.alias("total"), *turns_of), "trie-columns")


def _block_digest(block: Column, ids: list[Column]) -> Column:
    return F.sha2(F.concat_ws(",", block, *ids).cast("binary"), 256)


def _lane(digest: Column, k: int) -> Column:
    return _hex(digest, 1 + 8 * k, 8) % LANE


def _name(columns: int) -> Column:
    """The node after so many turn columns of a block, as a text: that before the next block if all are taken."""
    ids = [F.concat_ws(".", F.col(t)["high"], F.col(t)["low"]) for t in NAMES[:columns]]
    if columns == 0:
        return F.concat_ws(":", "block", *SUMS)
    if columns < BLOCK:
        return F.concat_ws(":", "block", F.lit("in"), F.substring(F.sha2(F.concat_ws(",", *SUMS, *ids).cast("binary"), 256), 1, 32))
    digest = _block_digest(F.col("block"), ids)
    return F.concat_ws(":", F.col("block") + 1, *[(F.col(s) + _lane(digest, k)) % LANE for k, s in enumerate(SUMS)])


def _by_level(level: Column, values: list[Column]) -> Column:
    out = F.lit(None)
    for k, value in enumerate(values):
        out = F.when(level == k, value).otherwise(out)
    return out


def _rolled(rows: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes within blocks: ``block, s1..s4, start, level, t1..t8`` and aggregates over the conversations of each."""
    keys = ", ".join(["block", *SUMS, "start"])
    turns = ", ".join(NAMES)
    real = " ".join(f"when {k + 1} then {t} is not null" for k, t in enumerate(NAMES))
    return rows.sparkSession.sql(
        f"""select * from (
          select {keys}, {turns}, {BLOCK} - bit_count(grouping_id()) as level, {aggregates}
          from {{rows}} group by {keys}, rollup ({turns}))
        where case level when 0 then block = 0 {real} end""",
        rows=rows,
    )


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the texts of each node, whose rows stand together and in order."""
    node, state, names, digests = None, None, [], []
    for batch in batches:
        for name, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if name != node:
                if state is not None:
                    names.append(node)
                    digests.append(state.hexdigest())
                node, state = name, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        names, digests = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.string()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def _ended(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` from the stored ``node, conv_id``: ids are sorted by ranges and put together by the hundreds,
    and the few texts of a node that follow each other are hashed as they come, without being held together."""
    dealt = in_ranges(ends, [F.col("node").asc(), F.col("conv_id").asc()], "trie-ends")
    piece = (F.col("at") - F.col("at") % ENDS).alias("piece")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    texts = dealt.groupBy("node", "part", piece).agg(ids.alias("ids"))
    texts = texts.repartition("node").sortWithinPartitions("node", "part", "piece").select("node", "ids")
    return texts.mapInArrow(_sections, "node string, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations given as turns (see ``placed``), position 0 standing for one without turns.

    Columns: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. The node is
    the first ``depth`` turns of its smallest member ``conv_id``.
    """
    rows = blocked(turns)
    level = F.col("level")
    depth = F.col("block") * BLOCK + level
    before = _by_level(level, [F.lit(0).cast("bigint"), F.col("start"), *[F.col(t)["upto"] for t in NAMES[:-1]]])
    names = [_name(k) for k in range(BLOCK + 1)]
    nodes = _rolled(rows, "min(conv_id) as conv_id").select(
        "conv_id",
        depth.alias("depth"),
        _by_level(level, names).alias("node"),
        _by_level(level, [F.lit(None).cast("string"), *names[:-1]]).alias("up"),
        before.alias("before"),
    )
    nodes = written(nodes, "trie-nodes")
    children = nodes.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")

    leaf = F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf")
    top = [F.min("before").alias("unowned"), F.min("depth").alias("from_depth"), F.min_by("up", "depth").alias("up"), leaf]
    owners = nodes.groupBy("conv_id").agg(*top)
    end = _by_level(F.col("size"), [_name(k) for k in range(BLOCK + 1)])
    ends = written(rows.where("last").select("conv_id", "span", "total", end.alias("node")), "trie-ended")
    walks = ends.join(owners, "conv_id", "left").select(
        "conv_id", "span", F.coalesce("unowned", "total").alias("unowned"), F.coalesce("leaf", F.lit(0)).alias("leaf"), "from_depth", "up"
    )
    walks = written(walks, "trie-walks")
    # one row for each span of a conversation, so that the blocks of a long one don't meet under one key
    spread = walks.select("conv_id", "unowned", "leaf", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("span"))).alias("span"))
    sums = "min(conv_id) as conv_id, count(*) as n_convs, sum(unowned) as unowned, min_by(unowned, conv_id) as owner, sum(leaf) as n_leaves"
    totals = _rolled(rows.join(spread, ["conv_id", "span"]), sums)
    saved = F.col("unowned") - F.col("owner") - (F.col("n_convs") - 1) * before
    totals = totals.select("conv_id", depth.alias("depth"), "n_convs", "n_leaves", saved.alias("saved_tokens"))

    # a node below one of the same owner has that owner for its parent; the topmost of each owner looks it up
    links = walks.where("up is not null").select("conv_id", F.col("from_depth").alias("depth"), "up")
    # by its definition fewer than HEAVY rows
    busy = links.groupBy("up").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * HEAVY > links.count()).select("up")
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent"))
    heavy = written(parents.join(F.broadcast(busy), "up"), "trie-heavy")
    below_heavy = links.join(F.broadcast(heavy), "up")
    below_light = links.join(F.broadcast(heavy), "up", "left_anti").join(parents, "up")
    above = below_heavy.unionByName(below_light).select("conv_id", "depth", "parent")

    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id"))
    nothing = F.lit(hashlib.sha256().hexdigest())
    return (
        nodes.select("conv_id", "depth", "node", "n_children")
        .join(_ended(ends.select("node", "conv_id")), "node", "left")
        .join(totals, ["conv_id", "depth"])
        .join(above, ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            parent.alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of ``trie`` for conversations (conv_id, turn, role, text) as they are."""
    with scratch(conversations.sparkSession):
        return written(trie(placed(conversations)), "trie", keep=True)


def spliced_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of ``trie`` for conversations (conv_id, turn, role, text) rebuilt by ``spliced``.

    Turns go by number, nulls first, and equal numbers by a digest of role and text, so repeated rows are turns of
    their own. Null roles and texts are empty. Rows without a conversation id are left out. A conversation may have
    any number of turns and a node any number of members and children; texts only enter by digest and length. An
    empty table has no root and gives no rows; other columns aren't looked at.
    """
    with scratch(conversations.sparkSession):
        return written(trie(spliced(placed(conversations))), "trie", keep=True)


ORACLE = f"""
with {CRC_STEPS},
own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as turns
  from conversations where conv_id is not null group by conv_id),
heads as (
  select c.conv_id, c.turns, coalesce(b.turns, []) as base, {crc32_sql("c.conv_id::varchar")} % 9 as h
  from own c left join own b on b.conv_id = c.conv_id - c.conv_id % 5, crc_steps),
rebuilt as (select conv_id, list_concat(base[1:h], turns[h + 1:]) as turns from heads),
paths as (select conv_id, len(turns) as n, unnest(range(len(turns) + 1)) as depth, turns from rebuilt),
prefixes as (select conv_id, n, depth, turns[1:depth] as prefix, strlen(turns[depth].text) as bytes from paths),
nodes as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, coalesce(min(bytes), 0) as bytes,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '')) as ends_sha256
  from prefixes group by depth, prefix),
members as (select p.conv_id as member, p.depth, o.conv_id from prefixes p join nodes o using (depth, prefix)),
parents as (
  select n.depth, n.conv_id, m.conv_id as parent_conv_id from nodes n join members m on m.member = n.conv_id and m.depth = n.depth - 1),
children as (select depth - 1 as depth, parent_conv_id as conv_id, count(*) as n_children from parents group by all),
sized as (
  select n.depth, n.conv_id, n.n_convs, n.ends_sha256, coalesce(c.n_children, 0) as n_children, (n.n_convs - 1) * n.bytes as saved
  from nodes n left join children c using (depth, conv_id)),
below as (
  select m.depth, m.conv_id, sum((u.n_children = 0)::int)::bigint as n_leaves, sum(u.saved)::bigint as saved_tokens
  from sized u join members m on m.member = u.conv_id and m.depth <= u.depth group by all)
select s.conv_id, s.depth, p.parent_conv_id, s.n_convs, s.n_children, b.n_leaves, b.saved_tokens, s.ends_sha256
from sized s join below b using (depth, conv_id) left join parents p using (depth, conv_id)"""
