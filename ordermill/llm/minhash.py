"""Near-duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidates.

A document's set is that of its five-word shingles, as 64-bit hashes. One pass makes its signature: the range of hash
values is cut into bins and each bin keeps its least value; an empty bin borrows that of the first full bin in an
order of bins drawn for it alone. Bands of the signature are buckets. Documents of equal sets are one class, and only
classes go on.

In each bucket the smallest class is the centre and the others are candidates with it alone, so pairs grow with the
documents, not with their square. Each candidate pair is confirmed on the full sets. A link between two members that
aren't the centre isn't lost: where the members of a bucket are in different components after that, they are compared
with each other. Such a bucket is first cut where distances from the centre leave a gap of more than the link
distance, since Jaccard distance is a metric: members on two sides of such a gap can't be linked. Then blocks of
bounded size meet in pairs, a matrix product of their sets gives all intersections, and only links that join
components leave the task.

With ``BANDS`` = 26 bands of ``ROWS`` = 5 a pair at 0.85 shares no bucket with a chance of 2e-7, one at 0.8 of 3e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm import text as tx
from ordermill.llm.ordering import numbered
from ordermill.llm.store import scratch, written

SHINGLE = 5
#: Documents are linked if 100 * intersection >= SIMILAR * union; without_near_duplicates links from STAGE_SIMILAR on.
SIMILAR, STAGE_SIMILAR = 85, 80
BANDS, ROWS = 26, 5
BINS = BANDS * ROWS
#: Bytes of sets and number of documents of a block, and numbers of a matrix, where members are compared.
BLOCK_BYTES, BLOCK_ROWS = 1 << 22, 1 << 11
WIDE = 1 << 22

#: First hash value of each bin, and for each bin the order in which it looks for a full one.
EDGES = ((np.arange(BINS + 1, dtype=object) * (1 << 64)) // BINS)[:-1].astype(np.uint64)
LOOK = np.argsort(tx.mix(np.arange(1, BINS * BINS + 1, dtype=np.uint64)).reshape(BINS, BINS), axis=1)


def sets_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, in ascending order."""
    hashes, first = tx.words(data, offsets, tx.BY_BLANKS)
    grams = tx.grams(hashes, SHINGLE)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(grams[a : b - SHINGLE + 1])
        elif b > a:
            yield tx.grams(hashes[a:b], b - a)
        else:
            yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each bin, empty bins densified. ``shingles`` ascend and aren't empty."""
    at = np.searchsorted(shingles, EDGES)
    full = np.diff(np.append(at, len(shingles))) > 0
    empty = np.flatnonzero(~full)
    at[empty] = at[LOOK[empty, np.argmax(full[LOOK[empty]], axis=1)]]
    return shingles[at]


def bands_of(signatures: np.ndarray) -> np.ndarray:
    """A bucket for each band of each signature."""
    rows = signatures.reshape(-1, BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        out = tx.mix(out * np.uint64(tx.MULTIPLIER) + rows[:, :, k])
    return out.astype(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in tx.text_slices(batch, "text"):
            sizes, digests, signed, which = [], [], [], []
            for k, shingles in enumerate(sets_of(data, offsets)):
                sizes.append(len(shingles))
                digests.append((int(np.sum(tx.mix(shingles))), int(np.sum(tx.mix(shingles ^ np.uint64(tx.MULTIPLIER))))))
                if len(shingles):
                    signed.append(signature(shingles))
                    which.append(k)
            bands = dict(zip(which, bands_of(np.array(signed)), strict=True)) if signed else {}
            a, b = (np.array([d[k] for d in digests], dtype=np.uint64).view(np.int64) for k in (0, 1))
            values = [batch.column("doc_id").slice(row, end - row), pa.array(sizes, pa.int64()), pa.array(a), pa.array(b)]
            values.append(pa.array([bands.get(k) for k in range(len(sizes))], pa.list_(pa.int64())))
            values.append(batch.column("text_hash").slice(row, end - row))
            yield pa.RecordBatch.from_arrays(values, names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands", "text_hash"])


def _own(docs: DataFrame, name: str = "doc_id") -> DataFrame:
    """Id and text of each row, and a hash of the text that tells rows of one id apart."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias(name), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def signed(docs: DataFrame) -> DataFrame:
    """Set size, set digest and buckets of each document, written to the shared folder."""
    schema = "doc_id bigint, n_shingles bigint, digest_a bigint, digest_b bigint, bands array<bigint>, text_hash bigint"
    return written(_own(docs).mapInArrow(_sign, schema), "minhash-signatures")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in tx.text_slices(batch, "text"):
            sets = [s.tobytes() for s in sets_of(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, end - row), pa.array(sets, pa.binary())], names=["id", "shingles"])


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common = []
        for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            one, other = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            one, other = sorted((one, other), key=len)
            at = np.minimum(np.searchsorted(other, one), len(other) - 1)
            common.append((int(np.count_nonzero(other[at] == one)), len(one) + len(other)))
        inter, both = np.array(common, dtype=np.int64).reshape(-1, 2).T
        values = [batch.column("a"), batch.column("b"), pa.array(inter), pa.array(both - inter)]
        yield pa.RecordBatch.from_arrays(values, names=["a", "b", "common", "joint"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Intersection and union of the full sets for pairs (a, b) of classes.

    Sets are large, so they are joined by key at any size and never sent to all tasks.
    """
    sets = sets.hint("merge")
    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    with_both = with_b.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    schema = "a bigint, b bigint, common bigint, joint bigint"
    return with_both.select("a", "b", "set_a", "set_b").mapInArrow(_overlap, schema)


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable from each id of ``links`` (a, b): rows (id, component). ``links`` is a stored table.

    Every root hooks onto its smallest neighbouring root, chains of hooks are shortened, and links move up to the
    roots, until none joins two of them. All steps are joins and groups of tables in the shared folder.
    """
    ids = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).distinct()
    labels, edges = ids.withColumn("component", F.col("id")), links.select("a", "b")
    while True:
        higher, lower = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        edges = written(edges.where("a != b").select(higher, lower).distinct(), "links")
        if edges.isEmpty():
            return labels
        hooks = edges.groupBy("a").agg(F.min("b").alias("up"))
        for _ in range(2):
            hooks = written(hooks, "hooks")
            above = hooks.select(F.col("a").alias("up"), F.col("up").alias("higher"))
            hooks = hooks.join(above, "up", "left").select("a", F.coalesce("higher", "up").alias("up"))
        hooks = written(hooks, "hooks")
        moved = labels.join(hooks.withColumnRenamed("a", "component"), "component", "left")
        labels = moved.select("id", F.coalesce("up", "component").alias("component"))
        for end, other in (("a", "b"), ("b", "a")):
            own = hooks.select(F.col("a").alias(end), "up")
            edges = edges.join(own, end, "left").select(F.coalesce("up", end).alias(end), other)


def _cut(members: DataFrame, similar: int) -> DataFrame:
    """Buckets cut where the distances from the centre leave a gap wider than that of linked documents."""
    row = Window.partitionBy("bucket").orderBy("far", "id")
    gap = (F.col("far") - F.lag("far").over(row) > 1 - similar / 100 + 1e-9).cast("int")
    part = F.sum(F.coalesce(gap, F.lit(0))).over(row)
    return members.withColumn("part", part).withColumn("bucket", F.xxhash64("bucket", "part")).drop("part")


def _rest(group: pa.Table, similar: int) -> pa.Table:
    """Links between documents of different components, of one block or of two: as few as join what they join."""
    block, component = group.column("block").to_numpy(), group.column("component").to_numpy()
    ids, sets = group.column("id").to_numpy(), [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("shingles")]
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    one, other = np.flatnonzero(block == low), np.flatnonzero(block == high)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[number]
    order = np.flatnonzero(shared[number])
    order = order[np.argsort(column[order], kind="stable")]
    column, owner = column[order], owner[order]
    common = np.zeros((len(one), len(other)), np.float32)
    n_shared = int(shared.sum())
    width = max(1, min(n_shared, WIDE // len(sets)))
    for first in range(0, n_shared, width):
        a, b = np.searchsorted(column, [first, first + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[a:b], column[a:b] - first] = 1
        common += has[one] @ has[other].T
    joint = size[one][:, None] + size[other][None, :] - common
    x, y = np.nonzero((100 * common >= similar * joint) & (component[one][:, None] != component[other][None, :]))
    up: dict = {}

    def root(c: int) -> int:
        while up.get(c, c) != c:
            c = up[c]
        return c

    found = []
    for i, j in zip(x.tolist(), y.tolist()):
        a, b = root(int(component[one[i]])), root(int(component[other[j]]))
        if a != b:
            up[max(a, b)] = min(a, b)
            found.append((int(ids[one[i]]), int(ids[other[j]]), int(common[i, j]), int(joint[i, j])))
    columns = list(zip(*found, strict=True)) if found else [[]] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "common", "joint"])


def linked_classes(docs: DataFrame, classes: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Confirmed links (a, b) among ``classes`` (id, doc_id, text_hash, repeated, bands, n_shingles): enough to join all that are linked.

    ``classes`` is a stored table; doc_id and text_hash name the rows that have the set of the class, of which there
    are several if ``repeated``. Only such texts are shuffled to be made one.
    """
    spread = classes.select("id", F.explode("bands").alias("bucket"))
    centres = spread.groupBy("bucket").agg(F.min("id").alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = written(spread.join(centres, "bucket").where("id != centre"), "members")
    pairs = members.select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    wanted = written(members.select("id").union(members.select(F.col("centre").alias("id"))).distinct(), "wanted")
    wanted = written(classes.select("id", "doc_id", "text_hash", "repeated").join(wanted, "id"), "wanted")
    # by the ids alone first, a table of one column: what is joined by more than them is small then
    ids = written(wanted.select("doc_id").distinct(), "wanted-ids")
    texts = _own(docs).join(ids, "doc_id", "left_semi").join(wanted, ["doc_id", "text_hash"]).select("id", "text", "repeated")
    once = texts.where("not repeated").select("id", "text")
    if not wanted.where("repeated").isEmpty():
        once = once.unionByName(texts.where("repeated").select("id", "text").dropDuplicates(["id"]))
    sets = written(once.mapInArrow(_sets, "id bigint, shingles binary"), "sets")
    tested = written(confirmed(pairs, sets), "tested")
    links = written(tested.where(100 * F.col("common") >= similar * F.col("joint")).select("a", "b"), "links")

    # what is left: buckets whose members, without the centre, are in different components
    known = tested.select(F.col("a").alias("centre"), F.col("b").alias("id"), (1 - F.col("common") / F.col("joint")).alias("far"))
    groups = components(links)
    state = _cut(members.join(known, ["centre", "id"]), similar).join(groups, "id", "left")
    state = state.select("bucket", "id", F.coalesce("component", "id").alias("component")).join(classes.select("id", "n_shingles"), "id")
    state = written(state.withColumn("weight", F.greatest(8 * F.col("n_shingles"), F.lit(BLOCK_BYTES // BLOCK_ROWS))), "members")
    several = state.groupBy("bucket").agg(
        F.min("component").alias("lowest"), F.max("component").alias("highest"), F.bit_xor(F.xxhash64("id")).alias("mark"),
        F.count("*").alias("n"), F.sum("weight").alias("weight"),
    )
    # buckets of the same members count once
    several = several.where("lowest != highest").groupBy("mark", "n").agg(F.min("bucket").alias("bucket"), F.min_by("weight", "bucket").alias("total"))
    left = state.join(several.select("bucket", F.ceil(F.col("total") / BLOCK_BYTES).alias("blocks")), "bucket")
    left = left.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    met = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    left = left.select("bucket", "id", "component", "block", met.alias("other"))
    left = left.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).join(sets.hint("merge"), "id")
    rest = left.groupBy("bucket", "low", "high").applyInArrow(lambda group: _rest(group, similar), "a bigint, b bigint, common bigint, joint bigint")
    return written(links.unionByName(rest.select("a", "b")), "links")


def grouped(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, class, keeps`` of each row of ``docs``, stored; see ``near_duplicates``.

    ``class`` numbers the different sets in the order of their smallest ids, and so tells texts of one id apart;
    ``keeps`` is true for rows of that smallest id in the class that a component is named by.
    """
    with scratch(docs.sparkSession):
        signs = signed(docs)
        full = signs.where("n_shingles > 0 and doc_id is not null")
        key = ["n_shingles", "digest_a", "digest_b"]
        first = F.struct("doc_id", "text_hash")
        classes = full.groupBy(*key).agg(F.min(first).alias("first"), F.min_by("bands", first).alias("bands"))
        classes = written(classes.select(*key, "first.doc_id", "first.text_hash", "bands"), "classes")
        repeated = full.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "text_hash", F.lit(True).alias("r"))
        classes = classes.join(repeated, ["doc_id", "text_hash"], "left").withColumn("repeated", F.coalesce("r", F.lit(False))).drop("r")
        classes = numbered(classes, [F.col(c).asc() for c in ("doc_id", *key)], "class-order").withColumnRenamed("row_number", "id")
        classes = written(classes, "classes")
        found = components(linked_classes(docs, classes, similar))
        named = classes.select(*key, "id", F.col("doc_id").alias("least")).join(found, "id", "left")
        named = named.withColumn("component", F.coalesce("component", "id"))
        roots = classes.select(F.col("id").alias("component"), F.col("doc_id").alias("component_id"))
        named = named.join(roots, "component").withColumn("root", F.col("id") == F.col("component"))
        in_set = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
        out = signs.drop("bands").join(named, key, "left").select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(in_set, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(in_set, F.col("id")).alias("class"),
            F.when(in_set, F.col("root") & (F.col("doc_id") == F.col("least"))).alias("keeps"),
        )
        return written(out, "near-duplicates", keep=True)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): the size of its set, its component, and whether it is kept.

    Documents whose sets have a Jaccard similarity of 0.85 or more are linked; a component is named by its smallest
    id, and that document is the one kept. Null and empty texts, and texts without words, have no set and are linked
    with nothing, and neither are rows with a null id (they are kept, in no component). Rows of equal id are linked
    by their own texts. An empty table gives no rows. Texts are handled whole.
    """
    return grouped(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, similar: int = STAGE_SIMILAR) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the first of their component.

    Documents are linked from a similarity of ``similar`` percent on. It goes by row: of rows of one id and the same
    set of shingles one stays, those of one id and different texts stand or fall each by its own. Rows with a null id
    and rows without words all stay. An empty table stays one.
    """
    rows = grouped(docs, similar).where("class is not null").groupBy("doc_id", "text_hash", "class", "keeps").agg(F.count(F.lit(1)).alias("n"))
    rows = written(rows, "near-duplicate-rows", keep=True)
    each = rows.groupBy("doc_id", "class", "keeps").agg(F.sum("n").alias("n")).where("not keeps or n > 1").drop("n", "keeps")
    # what to do with the rows that aren't simply kept, a table of its own whose size Spark knows
    rules = rows.join(each, ["doc_id", "class"]).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "class", "keeps")
    rules = written(rules, "near-duplicate-rules", keep=True)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    ruled = docs.select(row, F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    ruled = ruled.join(rules, ["id", "hash"], "left")
    nth = F.row_number().over(Window.partitionBy("id", "class").orderBy("hash", F.length("row.text")))
    repeated = ruled.where("keeps").withColumn("nth", nth).where("nth = 1")
    return ruled.where("keeps is null").select("row").union(repeated.select("row")).select("row.*")


ORACLE = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents),
every as (
  select doc_id, unnest(case when len(w) >= {SHINGLE}
    then list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from d),
sets as (select distinct doc_id, g from every),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
copies as (select doc_id, md5(string_agg(g, '|' order by g)) as m from sets group by doc_id),
reps as (select m, min(doc_id) as rep from copies group by m),
rep_sets as (select s.doc_id, s.g from sets s join reps on s.doc_id = reps.rep),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as inter
  from rep_sets x join rep_sets y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
links as (
  select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * inter >= {SIMILAR} * (p.n + q.n - inter)
  union all
  select rep, doc_id from copies join reps using (m) where rep < doc_id),
both_ways as (select a, b from links union select b, a from links),
reach as (
  select a as doc_id, a as other from both_ways
  union
  select r.doc_id, e.b from reach r join both_ways e on r.other = e.a),
least as (select doc_id, min(other) as component_id from reach group by doc_id)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, coalesce(l.component_id, d.doc_id) as component_id,
  coalesce(l.component_id, d.doc_id) = d.doc_id as kept
from d left join sizes s using (doc_id) left join least l using (doc_id)"""
