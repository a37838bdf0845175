"""MinHash near-deduplication, suffix deduplication and line deduplication against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ordermill.llm import blocks, line_dedup, minhash, store, suffix_dedup
from ordermill.llm import text as tx
from tests.llm import brute
from tests.llm.brute import by_id

NEAR = ("n_shingles", "component_id", "kept")


def _words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def _changed(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"n{rng.randrange(10**9)}"
    return out


@pytest.fixture(scope="module")
def corpus():
    """Bases with copies, copies of copies, unrelated and short documents."""
    rng, rows = random.Random(5), []
    for _ in range(12):
        base = _words(rng, rng.randrange(20, 300))
        rows.append(base)
        for _ in range(rng.randrange(0, 12)):
            base_or_copy = rows[-1] if rng.random() < 0.4 else base
            rows.append(_changed(rng, base_or_copy, rng.randrange(0, 1 + len(base) // 40)))
    rows += [_words(rng, n, 3) for n in (1, 2, 3, 4, 5, 6, 7) for _ in range(4)]
    rng.shuffle(rows)
    return [(k, " ".join(w)) for k, w in enumerate(rows)]


def test_near_duplicates(docs, corpus):
    assert by_id(minhash.near_duplicates(docs(*corpus)), *NEAR) == brute.near(corpus)


@pytest.mark.parametrize("block", [1 << 22, 4096])
def test_copies_linked_only_through_one_that_is_no_centre(docs, block, monkeypatch):
    """The original has the largest id; its copies are linked with it but not with each other.

    With small blocks the members of a bucket meet in many pairs of blocks.
    """
    monkeypatch.setattr(minhash, "BLOCK_BYTES", block)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block >> 11)
    rng = random.Random(3)
    base = _words(rng, 200, 10**6)
    # nine shingles in ten in common with the original, eight in ten with another copy
    copies = []
    for k in range(40):
        at = (k * 5) % 180
        copies.append(base[:at] + _words(rng, 14, 10**9) + base[at + 14 :])
    rows = [(k, " ".join(w)) for k, w in enumerate([*copies, base])]
    want = brute.near(rows)
    linked = [100 * len(a & b) >= 85 * len(a | b) for a in map(brute.shingles, (rows[0][1],)) for b in [brute.shingles(r[1]) for r in rows[1:]]]
    assert linked[-1] and not all(linked[:-1])
    assert by_id(minhash.near_duplicates(docs(*rows)), *NEAR) == want


def test_near_duplicate_edges(docs):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (9, "a b c d e"), (8, "a b c d e"), (7, "A  b\tc d E")]
    got = by_id(minhash.near_duplicates(docs(*rows)), *NEAR)
    assert got == brute.near(rows)
    assert got[4][1] == got[5][1] == 4 and got[2] == (0, 2, True) and got[9] == (1, 7, False)


def test_null_ids_and_repeated_rows(docs):
    got = minhash.near_duplicates(docs((None, "a b c"), (None, "a b c"), (2, "a b c"), (2, "a b c"))).collect()
    assert sorted((repr(r["doc_id"]), r["component_id"], r["kept"]) for r in got) == [("2", 2, True), ("2", 2, True), ("None", None, True), ("None", None, True)]
    left = minhash.without_near_duplicates(docs((None, "a b c"), (None, "a b c"), (2, "a b c"), (2, "a b c"), (3, "A b c")))
    assert sorted(repr(r["doc_id"]) for r in left.collect()) == ["2", "None", "None"]
    assert left.columns == docs((1, "")).columns


def test_rows_of_one_id_stand_by_their_own_texts(docs):
    one, other, third = ("a b c d e f", "v w x y z", "k l m n o")
    rows = [(1, one), (5, one), (5, other), (5, third), (5, third + " "), (9, other), (7, ""), (7, "")]
    left = sorted((r["doc_id"], r["text"]) for r in minhash.without_near_duplicates(docs(*rows)).collect())
    # 5 loses its copy of 1's text and one of its two equal ones; 9 is a copy of what 5 still has
    assert [(i, t.strip()) for i, t in left] == [(1, one), (5, third), (5, other), (7, ""), (7, "")]
    got = minhash.near_duplicates(docs(*rows)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (5, 1), (5, 5), (5, 5), (5, 5), (7, 7), (7, 7), (9, 5)]


def test_the_stage_links_pairs_from_eight_tenths_on(spark, docs):
    """Pairs at 0.79, 0.80, 0.82, 0.84 and 0.90 of texts without a repeated word: the stage drops all but the first."""
    rng, rows = random.Random(9), []
    for k, (own, cut) in enumerate([(79, 21), (80, 20), (82, 18), (84, 16), (90, 10)]):
        base = [f"b{k}x{n}" for n in range(104)]
        # the second text is a prefix of the first: own of its 100 shingles
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[: 104 - cut]))]
        a, b = (brute.shingles(r[1]) for r in rows[-2:])
        assert (len(a & b), len(a | b)) == (own, 100)
    rng.shuffle(rows)
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs(*rows), "").collect()}
    assert got == {0, 1, 2, 4, 6, 8}
    kept = {r["doc_id"] for r in minhash.near_duplicates(docs(*rows)).where("kept").collect()}
    assert kept == set(range(10)) - {9}


def test_empty_tables(docs):
    none = docs((1, "a")).where("false")
    for run in (minhash.near_duplicates, minhash.without_near_duplicates, suffix_dedup.deduplicated, line_dedup.line_report, line_dedup.without_repeated_lines):
        assert run(none).collect() == []


def test_densified_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(1)
    for size in (8, 60, 500):
        same = []
        for _ in range(60):
            common = rng.integers(0, 2**63, size, dtype=np.uint64)
            a, b = (np.unique(np.append(common, rng.integers(0, 2**63, size // 4, dtype=np.uint64))) for _ in range(2))
            same.append(np.mean(minhash.signature(a) == minhash.signature(b)))
        assert abs(np.mean(same) - size / (size + 2 * (size // 4))) < 0.06


def test_components_of_a_long_chain(spark, docs):
    ids = list(range(0, 120))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame([*zip(ids, ids[1:]), (500, 501), (501, 502), (502, 500)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in minhash.components(links).collect()}
    assert got == {**dict.fromkeys(ids, 0), 500: 500, 501: 500, 502: 500}


def _passages(rng, n):
    alphabet = "ab" if rng.random() < 0.3 else "abcdefgh é漢\n"
    pool = ["".join(rng.choices(alphabet, k=rng.randrange(30, 120))) for _ in range(8)]
    out = []
    for k in range(n):
        parts = [rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choices(alphabet, k=rng.randrange(0, 90))) for _ in range(rng.randrange(0, 5))]
        out.append((k * 3, "".join(parts)))
    return out + [(1000, out[1][1]), (1001, out[1][1]), (1002, "a" * 200), (1003, "a" * 130), (1004, None), (1005, "")]


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup(docs, seed, monkeypatch):
    rows = _passages(random.Random(seed), 40)
    got = by_id(suffix_dedup.deduplicated(docs(*rows)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.repeats(rows)


def test_sliding_least():
    x = np.random.default_rng(0).integers(0, 99, 40)
    for width in (1, 2, 3, 5, 8, 23, 40):
        assert suffix_dedup.sliding_least(x, width).tolist() == [x[k : k + width].min() for k in range(41 - width)]


def test_suffix_dedup_over_chunks_and_blocks(docs, monkeypatch):
    """Small chunks and blocks on the driver's side of the code give the same windows."""
    from ordermill.llm.blocks import Block

    import pyarrow as pa

    rows = _passages(random.Random(9), 30)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    block = Block(sink.getvalue())
    gone = np.zeros(len(rows), bool)
    whole = suffix_dedup.Windows(block, gone, 50, 28)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    cut = suffix_dedup.Windows(block, gone, 50, 28)
    assert whole.anchors.tolist() == cut.anchors.tolist() and whole.shared.tolist() == cut.shared.tolist()
    every = np.ones(len(whole.anchors), bool)
    assert whole.places(every).tolist() == cut.places(every).tolist()
    assert len(whole.places(every)) == sum(max(0, len((t or "").encode()) - 49) for _, t in rows)


def test_equal_ids_leave_each_other_alone(docs):
    text = "0123456789" * 8
    got = sorted(tuple(r) for r in suffix_dedup.deduplicated(docs((5, text), (5, text), (5, "x" + text))).collect())
    assert [r[2] for r in got] == [0, 0, 0]
    got = suffix_dedup.deduplicated(docs((None, text), (5, text))).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {5: 0, None: 80}


LINES = ["one two three four five", "short", "", "  ", "a b", "x y z u v w", "end", "a b c d e f g\r", "é 漢 b c d"]


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup(docs, seed):
    rng = random.Random(seed)
    rows = [(k, "\n".join(rng.choice(LINES) if rng.random() < 0.7 else f"own line number {rng.randrange(10**6)} of it" for _ in range(rng.randrange(1, 9)))) for k in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, rows[3][1])]
    got = by_id(line_dedup.line_report(docs(*rows)), "n_lines", "n_deleted", "n_runs", "kept_sha256")
    assert got == {i: (*r[:3], brute.sha(r[3])) for i, r in brute.lines(rows).items()}


def test_line_dedup_keeps_columns_and_drops_emptied_documents(docs):
    rows = [(1, "one two three four five\nown"), (2, "one two three four five"), (3, None), (4, ""), (5, "one two three four five\nother\n")]
    got = line_dedup.without_repeated_lines(docs(*rows))
    assert got.columns == docs((1, "")).columns
    assert by_id(got, "text", "n_chars", "row") == {1: (rows[0][1], 27, "x"), 3: (None, None, "x"), 4: ("", 0, "x"), 5: ("other\n", 6, "x")}


@pytest.mark.parametrize("least", [1, 3, 4, 7])
def test_longer_runs_by_doubling(docs, least):
    """Rounds beyond the first, and depths for which the last pair overlaps."""
    rng, pool = random.Random(least), ["a", "b", "c d", "e f g h i"]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for k in range(25)]
    rows += [(100, "\n".join(["a", "b"] * 9)), (101, rows[5][1]), (102, "\n" + rows[5][1].replace("\n", "\n\n"))]
    got = by_id(line_dedup.line_report(docs(*rows), least, 5 if least > 1 else 1), "n_lines", "n_deleted", "n_runs", "kept_sha256")
    assert got == {i: (*r[:3], brute.sha(r[3])) for i, r in brute.lines(rows, least, 5 if least > 1 else 1).items()}


def test_suffix_array_of_lines(spark):
    """Every suffix that begins with a repeated line has its place, and the exact prefix it shares with its neighbour."""
    rng = random.Random(4)
    seqs = {d: [rng.choice("abc") if d < 9 else f"{rng.choice('ab')}{rng.randrange(30)}" for _ in range(rng.randrange(0, 12))] for d in range(14)}
    seqs |= {20: ["a"] * 9, 21: list("abcabcabcabc") + ["own"], 22: list("bcabcabcabc"), 23: ["alone"], 24: seqs[3] + ["x"]}
    rows = [(d, 100 - d, [(line.encode(), False) for line in own]) for d, own in seqs.items()]
    lines = spark.createDataFrame(rows, "d bigint, ord bigint, ids array<struct<id:binary,long:boolean>>").repartition(5)
    with store.scratch(spark):
        got = [tuple(r) for r in line_dedup.suffix_array(lines).select("place", "d", "k", "lcp", "ord").orderBy("place").collect()]
    every = sorted(([*own[k:], ""], d, k) for d, own in seqs.items() for k in range(len(own)))
    counts = Counter(line for own in seqs.values() for line in own)

    def common(a, b):
        return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y or x == ""), min(len(a), len(b)))

    expected = [(p, d, k, common(s, every[p - 1][0]) if p else 0, 100 - d) for p, (s, d, k) in enumerate(every) if counts[s[0]] > 1]
    assert got == expected
    assert max(r[3] for r in got) > 8


def test_suffix_array_without_lines(spark):
    lines = spark.createDataFrame([(1, 1, [])], "d bigint, ord bigint, ids array<struct<id:binary,long:boolean>>")
    with store.scratch(spark):
        assert line_dedup.suffix_array(lines).collect() == []


def test_lines_of_one_id_and_of_no_id(docs):
    long, pair = "one two three four five six", "x\ny"
    rows = [(3, long), (3, long), (3, pair), (3, pair + "\nz"), (None, long + "\nown"), (None, pair), (4, "")]
    got = sorted((repr(r["doc_id"]), r["n_lines"], r["n_deleted"]) for r in line_dedup.line_report(docs(*rows)).collect())
    assert got == [("3", 1, 0), ("3", 1, 0), ("3", 2, 0), ("3", 3, 0), ("4", 0, 0), ("None", 2, 1), ("None", 2, 2)]


def test_lines_that_sums_of_powers_confuse(docs):
    """A Thue-Morse word and its complement are different lines and different words."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two three four {word}"), (2, f"one two three four {other}")]
    assert by_id(line_dedup.line_report(docs(*rows)), "n_deleted") == {1: (0,), 2: (0,)}


def test_a_text_of_very_many_lines_and_one_very_long_line(docs):
    every = [f"line {k}" for k in range(60_000)]
    rows = [(1, "\n".join(every)), (2, "\n".join(["new", *every[20_000:], "end"])), (3, "w" * 1_000_000), (4, "w" * 1_000_000 + "\nx")]
    got = by_id(line_dedup.line_report(docs(*rows)), "n_lines", "n_deleted", "n_runs")
    assert got == {1: (60_000, 0, 0), 2: (40_002, 40_000, 1), 3: (1, 0, 0), 4: (2, 0, 0)}


def test_one_text_of_two_million_characters(docs):
    rng = random.Random(2)
    text = " ".join(_words(rng, 400_000, 10**5))
    rows = [(1, text), (2, text[:1_000_000]), (3, "tiny")]
    got = by_id(suffix_dedup.deduplicated(docs(*rows)), "n_bytes", "n_removed")
    assert got == {1: (len(text), 0), 2: (1_000_000, 1_000_000), 3: (4, 0)}
    assert by_id(minhash.near_duplicates(docs(*rows)), "component_id") == {1: (1,), 2: (2,), 3: (3,)}
    assert tx.PIECE < len(text)


def test_files_of_blocks_have_short_row_groups(spark, docs):
    """A reader decodes a few blocks at once, however many a file has."""
    import glob

    import pyarrow.parquet as pq

    corpus = blocks.Corpus(docs(*[(i, random.Random(i).randbytes(2000).hex()) for i in range(200)]).coalesce(1), block_bytes=4000)
    try:
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{corpus.path.removeprefix('file:')}/*.parquet")]
        groups = [m.row_group(k) for m in files for k in range(m.num_row_groups)]
        assert sum(g.num_rows for g in groups) == 200
        corpus.close()
        corpus = blocks.Corpus(docs(*[(i, random.Random(i).randbytes(1 << 19).hex()) for i in range(24)]).coalesce(1), block_bytes=1 << 20)
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{corpus.path.removeprefix('file:')}/*.parquet")]
        groups = [m.row_group(k) for m in files for k in range(m.num_row_groups)]
        # sizes count as they are stored; 24 blocks are under the 100 rows after which a writer looks by default
        stored = [sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in groups]
        assert sum(g.num_rows for g in groups) == 24 and len(groups) > 1 and max(stored) < 5 * blocks.BLOCK
    finally:
        corpus.close()
