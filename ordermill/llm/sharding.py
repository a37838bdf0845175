"""Shards by a Feistel permutation of global row numbers: a shuffle that repeats and can be computed for any row.

Rows are numbered in the order of their ids. A number under ``a * b`` is split into two halves, under a and under b,
and in turn each half is moved around its own size by a digest of the other; every round can be undone, so the whole
is a permutation. ``a`` and ``b`` are about the square root of the number of rows n, so fewer than ``a`` numbers aren't
under n; a number that lands on one is permuted again until it doesn't (cycle walking). Shard and slot follow from the
permuted number alone, and ``row_at`` goes back from them to the row.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.ordering import numbered
from ordermill.llm.store import written

SHARDS = 16
SEED = "shards"
ROUNDS = 6
#: Steps of a walk. Up to 4,096 rows there are fewer numbers to walk over; beyond, a walk goes on with a chance under
#: 1/64 for each step. A longer one would end the query rather than give a wrong place.
STEPS = 64


def sides(n: int) -> tuple[int, int]:
    """How many values each half has."""
    a = isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def feistel(x: Column, n: int, seed: str, back: bool = False) -> Column:
    """A permutation of the numbers under ``a * b``, or with ``back`` the one that undoes it."""
    a, b = sides(n)

    def moved(half: Column, other: Column, turn: Column, size: int) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(seed), turn, other).cast("binary"))
        by = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % size
        return (half + (size - by if back else by)) % size

    def turned(at: Column, turn: Column) -> Column:
        high = F.struct(moved(at.high, at.low, turn, a).alias("high"), at.low.alias("low"))
        low = F.struct(at.high.alias("high"), moved(at.low, at.high, turn, b).alias("low"))
        return F.when(turn % 2 == 0, high).otherwise(low)

    low = x % b
    halves = F.struct(((x - low) / b).cast("bigint").alias("high"), low.cast("bigint").alias("low"))
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, halves, turned, lambda at: at.high * b + at.low)


def permuted(x: Column, n: int, seed: str = SEED, back: bool = False) -> Column:
    """Where the number ``x`` under n goes among them, or with ``back`` which number goes to ``x``."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        feistel(x, n, seed, back),
        lambda y, _: F.when(y < n, y).otherwise(feistel(y, n, seed, back)),
        lambda y: F.when(y < n, y).otherwise(F.raise_error(F.lit("a cycle walk didn't end")).cast("bigint")),
    )


def places(rows: DataFrame, keys: list, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``rows`` with ``row_number`` in the order of ``keys``, ``shard`` and ``slot``.

    Counts of shards are at most one apart and the slots of each have no gaps. Rows that are equal in all keys are
    numbered as they stand. No row stays without a place, null keys go first, and an empty table gives no rows. The
    rows go through two shuffles and a stored table, so what is long in them should be joined later.
    """
    slim = written(rows, "sharding")
    n = slim.count()
    order = numbered(slim, keys, "sharding-order").withColumn("place", permuted(F.col("row_number"), n, seed))
    shard = (F.col("place") % shards).cast("int")
    slot = ((F.col("place") - F.col("place") % shards) / shards).cast("bigint")
    return order.withColumn("shard", shard).withColumn("slot", slot).drop("place")


def row_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, seed: str = SEED) -> Column:
    """The row number at a slot of a shard of n rows, without looking at any row."""
    return permuted(slot * shards + shard, n, seed, back=True)


def sharded(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, text, ...) with all their columns and ``shard`` and ``slot``, sorted by them in ranges.

    Numbered as in ``shard_report``. Whole rows are stored, sorted by id and dealt out once more by place; columns that
    are called shard or slot are replaced.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keys = [F.col("row.doc_id").asc_nulls_first(), F.xxhash64("row.text").asc()]
    placed = places(docs.select(kept), keys, shards, seed)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return placed.select(*own, "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: str = SEED) -> None:
    """A folder of Parquet files for each shard, written by many tasks; within and between its files rows are in slot order."""
    sharded(docs, shards, seed).write.partitionBy("shard").parquet(folder)


def shard_report(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``rows``: of 16 shards none has over one row more than another. Size is the bytes of the text and one;
    a null text has none and the check sum of no bytes. Rows are numbered by id, nulls first, and those of one id by a
    hash of their text, so the file a row lies in doesn't matter; equal rows share out their places. Only these few
    columns are sorted, so very long texts don't move. An empty table gives no rows, and other columns aren't looked at.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = places(slim, [F.col("doc_id").asc_nulls_first(), F.col("text_hash").asc()])
    none = F.lit(None).cast("int")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard"), "row_number")


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of the bytes of a text, beside the one row of ``crc_steps``."""
    data = f"hex(encode({text}))"
    octets = f"list_transform(range(length({data}) // 2), lambda k: ('0x' || substring({data}, 2 * k + 1, 2))::bigint)"
    step = "xor(a >> 8, steps[(xor(a, o) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda a, o: {step}), 4294967295::bigint)"


#: The 256 steps of a CRC-32, from its polynomial.
CRC_STEPS = """crc_steps as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
    order by i) as steps from (select unnest(range(256)) as i))"""


def _walked_sql() -> str:
    """Rounds of the permutation as nested selects over ``halves`` (high, low, a, b)."""
    out = "halves"
    for turn in range(ROUNDS):
        half, other, size = ("high", "low", "a") if turn % 2 == 0 else ("low", "high", "b")
        by = f"('0x' || md5('{SEED}:{turn}:' || {other})[1:15])::bigint % {size}"
        out = f"(select * replace (({half} + {by}) % {size} as {half}) from {out})"
    return out


ORACLE = f"""
with recursive {CRC_STEPS},
total as (select count(*)::bigint as n, greatest(ceil(sqrt(count(*)))::bigint, 1) as a from documents),
sides as (select n, a, greatest((n + a - 1) // a, 1) as b from total),
rows as (
  select doc_id, text, row_number() over (order by doc_id nulls first, text) - 1 as row_number from documents),
walk as (
  select row_number, row_number as x, 0 as steps from rows
  union all
  select row_number, high * b + low, steps + 1 from (
    with halves as (select row_number, steps, a, b, n, x // b as high, x % b as low from walk, sides where steps = 0 or x >= n)
    select * from {_walked_sql()})),
placed as (select row_number, arg_max(x, steps) as place from walk group by row_number)
select doc_id, strlen(coalesce(text, '')) + 1 as size, {crc32_sql("coalesce(text, '')")} as text_crc32, 'rows' as law,
  (place % {SHARDS})::int as shard, place // {SHARDS} as slot, null::int as grown_shard, row_number
from rows join placed using (row_number), crc_steps"""
