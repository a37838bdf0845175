import hashlib
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.llm import fill_in_middle as fim
from ordermill.llm import sharding
from tests.llm import brute

HARD = ["", None, "a", "ab", "x<P>y", "<S", "P>", "a<", "é漢😀\r\n \x00z", "$1 \\2 (.*) {3}", "😀" * 5000, "line\n" * 3000, "a" * 4096, "b" * 8193]


def test_cuts_agree_with_slices(docs):
    rows = [(None if k == 77 else k, HARD[k % len(HARD)]) for k in range(400)] + [(3, "again"), (3, "again")]
    got = Counter(tuple(r) for r in fim.cut_report(docs(*rows)).collect())
    assert got == Counter((i, *brute.middle(i, t)) for i, t in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="<>PSM/\n😀a", max_size=12), min_size=100, max_size=400))
def test_pieces_next_to_sentinels_come_back(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    out = fim.fill_in_middle(df, cut_percent=100).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert {r["doc_id"]: r["back"] for r in out.collect()} == dict(enumerate(texts))


def test_a_very_long_text_is_cut(docs):
    text = "é😀b\n" * 1_000_000
    got = {r["doc_id"]: r for r in fim.cut_report(docs(*[(k, text) for k in range(3)])).collect()}
    assert all((r["n"], r["restored_sha256"]) == (4_000_000, brute.sha(text)) for r in got.values())
    assert [tuple(got[k])[1:] for k in range(3)] == [brute.middle(k, text) for k in range(3)]


def test_permutation_is_one_and_can_be_undone(spark):
    for n in (1, 2, 3, 5, 16, 17, 99, 1000, 4099):
        x = spark.range(n).select("id", sharding.permuted(F.col("id"), n).alias("to"))
        back = x.select("id", "to", sharding.permuted(F.col("to"), n, back=True).alias("back")).collect()
        assert sorted(r["to"] for r in back) == list(range(n))
        assert all(r["id"] == r["back"] for r in back)
    moved = [r["to"] for r in x.orderBy("id").collect()]
    assert sum(abs(a - b) == 1 for a, b in zip(moved, moved[1:])) < 20


def test_big_numbers_are_permuted_exactly(spark):
    n = 10**11 + 7
    x = spark.range(n - 200, n).select("id", sharding.permuted(F.col("id"), n).alias("to"))
    back = x.select("id", "to", sharding.permuted(F.col("to"), n, back=True).alias("back")).collect()
    assert all(0 <= r["to"] < n and r["id"] == r["back"] for r in back) and len({r["to"] for r in back}) == 200


def _shards(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["shard"]].append(r["slot"])
    return out


def test_shards_are_even_and_without_gaps(docs, spark):
    # a third of the rows has one id, and a third of them one text
    rows = [(k if k % 3 else 5, "same" if k % 9 == 0 else f"t{k}" if k % 10 else None) for k in range(1, 1001)]
    first = sharding.shard_report(docs(*rows)).collect()
    again = sharding.shard_report(docs(*rows).repartition(11)).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))
    slots = _shards(first)
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 16 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in first) == want
    assert {(r["law"], r["grown_shard"]) for r in first} == {("rows", None)}
    at = spark.createDataFrame([(r["shard"], r["slot"], r["row_number"]) for r in first], "shard int, slot bigint, row_number bigint")
    at = at.select("row_number", sharding.row_at(F.col("shard"), F.col("slot"), len(rows)).alias("found"))
    assert at.where("row_number != found").count() == 0


def test_few_null_long_and_no_documents(docs):
    some = sharding.shard_report(docs((None, None), (None, "a"), (1, "x" * 3_000_000))).collect()
    assert sorted(r["row_number"] for r in some) == [0, 1, 2] and {r["slot"] for r in some} == {0}
    assert next(r for r in some if r["row_number"] == 2)["size"] == 3_000_001
    assert sharding.shard_report(docs((1, "a")).where("false")).count() == 0
    assert fim.cut_report(docs((1, "a")).where("false")).count() == 0


def test_whole_rows_go_to_their_shard(docs, spark, tmp_path):
    rows = [(k, f"text {k}") for k in range(200)]
    table = docs(*rows).withColumn("shard", F.lit("clash")).withColumn("place", F.lit(1))
    sharding.write_shards(table, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_report(docs(*rows)).collect()}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got.collect()} == want
    assert set(got.columns) == set(table.columns) | {"slot"}
    assert hashlib.sha256("".join(sorted(r["text"] for r in got.collect())).encode()).hexdigest() == brute.sha("".join(sorted(t for _, t in rows)))
