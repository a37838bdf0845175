"""Fingerprints of documents: sums of vectors hashed from their paragraphs, modulo powers of two.

A paragraph is a line, cut once more after each sentence, so that short texts have several too. Its vector has two
parts. The dense part has eight lanes of 32 bits, all of them hashed anew: the sums tell equal texts, or texts of the
same paragraphs in any order, from all others. The sparse part has tiers of 16 lanes of 16 bits; a paragraph falls into
one tier (the first with chance 1/2, each next one half as often) and adds to one of its lanes. Where two documents
share a paragraph its lane stays equal, so the share of equal lanes, in the first tier that isn't crowded and those
after it, estimates how much the two have in common.

A fingerprint has ``TIERS`` tiers, and more where a document reaches them: tiers after those are left out if no
paragraph falls into them or later ones, and count as zeros. So some tier isn't crowded at any length.

Sums don't depend on order, and a paragraph is added to or taken from a fingerprint by adding or subtracting its
vector; ``added`` and ``removed`` do so. Everything is Spark SQL on arrays within a row: no shuffle but the one that
brings neighbouring documents together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DENSE, DENSE_BITS = 8, 32
TIERS, MOST_TIERS, LANES, LANE_BITS = 9, 32, 16, 16
#: Lanes of a tier in use (by either document) above which it counts as crowded.
CROWDED = 11
PARAGRAPHS = "(?<=[.!?])[ \\t]+|\\n+"
#: Characters of text in a range of neighbouring ids, and ranges whose borders are quantiles of the ids.
RANGE_CHARS, MOST_BORDERS = 4_000_000, 1_000


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def total(numbers: Column, bits: int) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: (a + x).bitwiseAND((1 << bits) - 1))


def _halves(hashes: Column) -> Column:
    """Sums of the low and of the high 32 bits of hashes."""
    low = F.transform(hashes, lambda x: x.bitwiseAND((1 << DENSE_BITS) - 1))
    high = F.transform(hashes, lambda x: F.shiftrightunsigned(x, DENSE_BITS))
    return F.array(total(low, DENSE_BITS), total(high, DENSE_BITS))


def _hashed(paragraphs: Column, seed) -> Column:
    return F.transform(paragraphs, lambda p: F.xxhash64(F.lit(seed), p))


def _dense(paragraphs: Column) -> list[Column]:
    return [let(_hashed(paragraphs, seed), _halves) for seed in range(DENSE // 2)]


def _tier(hashes: Column, bit: Column) -> Column:
    """The lanes of one tier. The lowest bit of a hash tells the tier, bits 32 to 35 the lane, the top 16 what is added."""
    own = F.filter(hashes, lambda x: x.bitwiseAND(bit * 2 - 1) == bit)
    add = lambda rows, k: total(
        F.transform(
            F.filter(rows, lambda x: F.shiftright(x, MOST_TIERS).bitwiseAND(LANES - 1) == k),
            lambda x: F.shiftrightunsigned(x, 64 - LANE_BITS).bitwiseOR(1),
        ),
        LANE_BITS,
    )
    return let(own, lambda rows: F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda k: add(rows, k)))


def _bit(tier: int) -> Column:
    return F.lit(1 << tier).cast("bigint")


def _more_tiers(hashes: Column) -> Column:
    """The lanes of the tiers from ``TIERS`` on that ``hashes`` reach."""
    highest = lambda rows: F.coalesce(F.array_max(F.transform(rows, lambda x: x.bitwiseAND(-x))), F.lit(0))
    reached = lambda top: F.filter(F.array(*[_bit(t) for t in range(TIERS, MOST_TIERS)]), lambda b: b <= top)
    lanes = lambda rows: F.flatten(F.transform(let(highest(rows), reached), lambda b: _tier(rows, b)))
    none = F.array().cast("array<bigint>")
    rare = F.filter(hashes, lambda x: x.bitwiseAND((1 << TIERS) - 1) == 0)
    return let(rare, lambda rows: F.when(F.size(rows) == 0, none).otherwise(lanes(rows)))


def _trimmed(fingerprint: Column) -> Column:
    """``fingerprint`` without the tiers after the first ``TIERS`` that are all zeros up to its end."""
    used = lambda v: F.array_max(F.transform(v, lambda x, k: F.when(x != 0, k + 1).otherwise(0)))
    size = lambda v: F.greatest(F.lit(TIERS), F.ceil((used(v) - DENSE) / LANES).cast("int")) * LANES + DENSE
    return let(fingerprint, lambda v: F.when(F.size(v) == DENSE + TIERS * LANES, v).otherwise(F.slice(v, 1, size(v))))


def vector(text: Column) -> Column:
    """A document's fingerprint as an array of ``DENSE + TIERS * LANES`` numbers, and ``LANES`` more for each further tier
    up to the last that it reaches. A null text is empty: all zeros."""
    paragraphs = F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPHS), lambda p: p != "")
    # the bit of the last tier is set in every hash
    hashes = lambda p: F.transform(_hashed(p, "tier"), lambda x: x.bitwiseOR(1 << (MOST_TIERS - 1)))
    sparse = lambda p: let(hashes(p), lambda h: F.concat(*[_tier(h, _bit(t)) for t in range(TIERS)], _more_tiers(h)))
    return let(paragraphs, lambda p: _trimmed(F.concat(*_dense(p), sparse(p))))


def _combined(one: Column, other: Column, sign: int) -> Column:
    bits = lambda k: F.when(k < DENSE, F.lit((1 << DENSE_BITS) - 1)).otherwise(F.lit((1 << LANE_BITS) - 1))
    summed = F.zip_with(one, other, lambda x, y: F.coalesce(x, F.lit(0)) + sign * F.coalesce(y, F.lit(0)))
    return _trimmed(F.transform(summed, lambda x, k: x.bitwiseAND(bits(k).cast("bigint"))))


def added(fingerprint: Column, part: Column) -> Column:
    """The fingerprint of a document and one more text."""
    return _combined(fingerprint, part, 1)


def removed(fingerprint: Column, part: Column) -> Column:
    """The fingerprint of a document without one of its parts."""
    return _combined(fingerprint, part, -1)


def as_text(fingerprint: Column) -> Column:
    """Lower-case hexadecimal digits of all lanes."""
    digits = lambda x, k: F.lower(F.when(k < DENSE, F.lpad(F.hex(x), DENSE_BITS // 4, "0")).otherwise(F.lpad(F.hex(x), LANE_BITS // 4, "0")))
    return F.array_join(F.transform(fingerprint, digits), "")


def likeness(one: Column, other: Column) -> Column:
    """How much two documents have in common by their fingerprints, from 0 to 1; 1 if these are equal."""
    # for each lane 0 if neither uses it, 1 if they differ, and 1 in a second counter 16 bits up if they agree
    same = lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 65537).otherwise(1)
    mark = lambda x, y: same(F.coalesce(x, F.lit(0)), F.coalesce(y, F.lit(0)))
    lanes = F.zip_with(F.slice(one, DENSE + 1, MOST_TIERS * LANES), F.slice(other, DENSE + 1, MOST_TIERS * LANES), mark)
    summed = lambda rows: F.aggregate(rows, F.lit(0), lambda a, x: a + x)
    tiers = let(lanes, lambda z: F.transform(F.sequence(F.lit(0), (F.size(z) / LANES).cast("int") - 1), lambda t: summed(F.slice(z, LANES * t + 1, LANES))))
    open_tier = lambda v: F.array_position(F.transform(v, lambda x: x.bitwiseAND(65535) <= CROWDED), F.lit(True))
    first = lambda v: F.when(open_tier(v) == 0, F.size(v)).otherwise(open_tier(v).cast("int"))
    rate = lambda n: F.when(n.bitwiseAND(65535) == 0, F.lit(0.0)).otherwise(F.shiftright(n, 16) / n.bitwiseAND(65535))
    sparse = let(tiers, lambda v: let(let(first(v), lambda f: summed(F.slice(v, f, MOST_TIERS))), rate))
    return F.when(one == other, F.lit(1.0)).otherwise(sparse)


def ranges(docs: DataFrame, order: str, chars: str) -> tuple[list[int], int]:
    """Borders that cut the ids into ranges of about equal counts, and the parts to cut each range into by value."""
    size = docs.agg(F.sum(chars)).first()[0] or 0
    wanted = max(1, math.ceil(size / RANGE_CHARS))
    n = min(MOST_BORDERS, wanted)
    borders = docs.agg(F.percentile_approx(order, [k / n for k in range(n + 1)], 100 * n).alias("b")).first()["b"] or [0]
    return sorted(set(borders)), max(1, math.ceil(wanted / n))


def with_next(docs: DataFrame, order: str, text: str, chars: str, more: dict) -> DataFrame:
    """Adds the columns of ``more`` (name: function of the text), and a struct ``next`` with the text and those columns
    of the document that follows by ``order`` (a long; ties by digests of the text); after the last comes the first.

    Documents are dealt out by ranges of the order. The last one of each range gets the first of the next range that
    has any; these few rows alone are joined.
    """
    borders, parts = ranges(docs, order, chars)
    above = F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in borders]), lambda b: b <= F.col(order)))
    low = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in [borders[0], *borders]]), above + 1)
    high = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in [*borders, borders[-1]]]), above + 1)
    wide = F.greatest((high - low).cast("double"), F.lit(1.0))
    part = F.least(F.floor((F.col(order) - low).cast("double") * parts / wide), F.lit(parts - 1)) if parts > 1 else F.lit(0)
    spread = docs.withColumn("range", above.cast("bigint") * parts + F.greatest(part, F.lit(0)).cast("bigint"))
    ties = [F.col(order), F.xxhash64(text), F.md5(F.col(text).cast("binary"))]
    row = Window.partitionBy("range").orderBy(*ties)
    rich = spread.withColumns({name: use(F.col(text)) for name, use in more.items()})
    seen = rich.withColumn("next", F.lead(F.struct(text, *more)).over(row))
    # one row for each range: a few bytes for every RANGE_CHARS of text
    filled = spread.groupBy("range").agg(F.lit(1).alias("one"))
    # each task sends on one text for each range at most
    heads = spread.withColumn("nth", F.row_number().over(row)).where("nth = 1")
    heads = heads.select(F.col("range").alias("following"), F.struct(F.col(text), *[use(F.col(text)).alias(n) for n, use in more.items()]).alias("first"))
    after = filled.withColumn("following", F.lead("range").over(Window.partitionBy("one").orderBy("range")))
    after = after.select("range", F.coalesce("following", filled.agg(F.min("range")).scalar()).alias("following"))
    inner = seen.where("next is not null")
    last = seen.where("next is null").drop("next").join(after, "range").join(heads, "following").withColumnRenamed("first", "next")
    return inner.unionByName(last.drop("following")).drop("range")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its fingerprint, that of its edited text, and likenesses.

    The edited text has the last half of the code points replaced by as many first ones of the next document, by
    ascending id (null ids last, equal ids in the order of a digest of their texts). Null texts are empty; a single
    document is its own next one. Empty tables give no rows.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("order"),
        F.length("text").cast("bigint").alias("n_chars"),
        "text",
    )
    return _compared(base)


def _compared(base: DataFrame) -> DataFrame:
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = with_next(base, "order", "text", "n_chars", {"own": vector}).select(
        "doc_id",
        "n_chars",
        "own",
        F.col("next.own").alias("next_own"),
        F.concat(F.expr("substring(text, 1, int(n_chars - floor(n_chars / 2)))"), F.substring(F.col("next.text"), F.lit(1), half)).alias("edited"),
    )
    both = edited.withColumn("edited_own", vector(F.col("edited")))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
