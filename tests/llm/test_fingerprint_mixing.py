"""Fingerprints, mixing, the pipeline and all oracles."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import canonical
from ordermill.llm import fingerprint, mixing, toxicity
from ordermill.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.brute import by_id

SMALL = "/root/testdata/sf0.001"


def _edited(rows):
    rows = sorted(rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        h = len(t) // 2
        out[i] = (len(t), brute.sha(t[: len(t) - h] + following[:h]))
    return out


@pytest.mark.parametrize("chars", [4_000_000, 500])
def test_edited_texts_across_ranges(docs, monkeypatch, chars):
    monkeypatch.setattr(fingerprint, "RANGE_CHARS", chars)
    monkeypatch.setattr(fingerprint, "MOST_BORDERS", 5)
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("ab. é漢😀\n", k=rng.randrange(0, 150)))) for i in [*range(0, 100), 5000, 10**15, -7]] + [(200, None), (201, ""), (202, "x")]
    got = by_id(fingerprint.fingerprints(docs(*rows)), "n_chars", "edited_sha256")
    assert got == _edited(rows)


def test_one_document_none_and_null_ids(docs):
    one = fingerprint.fingerprints(docs((4, "abcd"))).collect()[0]
    assert (one["n_chars"], one["edited_sha256"], one["near_next"]) == (4, brute.sha("abab"), 1.0)
    assert fingerprint.fingerprints(docs((1, "a")).where("false")).collect() == []
    got = fingerprint.fingerprints(docs((None, "abcd"), (1, "wxyz"), (1, "wxyz"))).collect()
    assert len(got) == 3 and {r["edited_sha256"] for r in got if r["doc_id"] is None} == {brute.sha("abwx")}


def _vectors(spark, *texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    return [r["v"] for r in df.orderBy("k").select(fingerprint.vector(F.col("text")).alias("v")).collect()]


def test_fingerprints_don_t_depend_on_order_and_can_be_changed(spark):
    a, b, c = (f"Paragraph {x} of some length, with words." for x in "abc")
    one, other, ab, alone, none = _vectors(spark, "\n".join([a, b, c, a]), "\n".join([c, a, a, b]), "\n".join([a, b, a]), c, None)
    assert one == other != ab and set(none) == {0} and len(one) == fingerprint.DENSE + fingerprint.TIERS * fingerprint.LANES
    row = spark.createDataFrame([(one, ab, alone)], "one array<bigint>, ab array<bigint>, c array<bigint>")
    got = row.select(fingerprint.added(F.col("ab"), F.col("c")).alias("p"), fingerprint.removed(F.col("one"), F.col("c")).alias("m")).first()
    assert got["p"] == one and got["m"] == ab


def test_likeness_follows_shared_paragraphs(spark):
    rng = random.Random(1)
    for n in (20, 400, 3000):
        lines = [f"line {rng.randrange(10**9)} of this text." for _ in range(n)]
        others = [f"line {rng.randrange(10**9)} of that text." for _ in range(n)]
        texts = ["\n".join(lines[: n * k // 4] + others[n * k // 4 :]) for k in range(5)]
        whole = spark.createDataFrame([("\n".join(lines), t) for t in texts], "a string, b string")
        near = [r["x"] for r in whole.select(fingerprint.likeness(fingerprint.vector(F.col("a")), fingerprint.vector(F.col("b"))).alias("x")).collect()]
        assert near[4] == 1.0 and near[0] <= 0.15 and near[3] > near[1] and abs(near[3] - 0.6) < 0.35


def test_likeness_of_very_long_documents(spark):
    rng = random.Random(7)
    whole = []
    for n in (50_000, 120_000):
        for shared, true in ((n // 2, 1 / 3), (n * 19 // 20, 19 / 21), (0, 0.0)):
            for _ in range(6):
                lines = [f"line {rng.randrange(10**12)}" for _ in range(2 * n - shared)]
                whole.append((n, true, "\n".join(lines[:n]), "\n".join(lines[n - shared :])))
    pairs = spark.createDataFrame(whole, "n int, true double, a string, b string").repartition(8)
    near = fingerprint.likeness(fingerprint.vector(F.col("a")), fingerprint.vector(F.col("b")))
    got = pairs.select("n", "true", near.alias("x")).groupBy("n", "true").agg(F.avg("x").alias("x")).collect()
    assert len(got) == 6 and all(abs(r["x"] - r["true"]) < 0.15 for r in got), got


def test_long_fingerprints_can_be_changed(spark):
    """Tiers that only one part reaches come and go with it."""
    long = "\n".join(f"line {k}" for k in range(40_000))
    both, alone, other = _vectors(spark, long + "\nshort", "short", long)
    assert len(both) > len(alone) and (len(both) - fingerprint.DENSE) % fingerprint.LANES == 0
    row = spark.createDataFrame([(both, alone, other)], "one array<bigint>, c array<bigint>, o array<bigint>")
    got = row.select(
        fingerprint.added(F.col("o"), F.col("c")).alias("p"),
        fingerprint.removed(F.col("one"), F.col("c")).alias("m"),
        fingerprint.removed(F.col("one"), F.col("o")).alias("s"),
    ).first()
    assert got["p"] == both and got["m"] == other and got["s"] == alone


def _cheapest(patterns, quotas, copies):
    """Most words, then fewest repeats, by trying all amounts."""
    edges = [(p, s) for p, (own, _) in enumerate(patterns) for s in own]
    best = (0, 0)
    for amounts in itertools.product(*[range(min(copies * patterns[p][1], quotas[s]) + 1) for p, s in edges]):
        by_p, by_s = {}, {}
        for (p, s), n in zip(edges, amounts):
            by_p[p], by_s[s] = by_p.get(p, 0) + n, by_s.get(s, 0) + n
        if all(n <= copies * patterns[p][1] for p, n in by_p.items()) and all(n <= quotas[s] for s, n in by_s.items()):
            cost = sum(max(0, n - k * patterns[p][1]) for p, n in by_p.items() for k in range(1, copies))
            best = max(best, (sum(amounts), -cost))
    return best


@pytest.mark.parametrize("seed", range(25))
def test_cheapest_flow(seed):
    rng = random.Random(seed)
    names = ["a", "b", None][: rng.randrange(1, 4)]
    patterns = [(tuple(rng.sample(names, rng.randrange(0, len(names) + 1))), rng.randrange(0, 4)) for _ in range(3)]
    patterns = [(own[:2], size) for own, size in patterns]
    quotas = {s: rng.randrange(0, 6) for s in names}
    given = mixing.cheapest_flow(patterns, quotas, 3)
    by_p = [sum(g.values()) for g in given]
    assert all(set(g) <= set(own) and n <= 3 * size for g, n, (own, size) in zip(given, by_p, patterns))
    assert all(sum(g.get(s, 0) for g in given) <= q for s, q in quotas.items())
    cost = sum(max(0, n - k * size) for n, (_, size) in zip(by_p, patterns) for k in (1, 2))
    assert (sum(by_p), -cost) == _cheapest(patterns, quotas, 3)


def test_mixture(docs):
    rng = random.Random(6)
    rows = []
    for k in range(300):
        source = rng.choice(["big"] * 20 + ["é", "a", "漢", "Z", None, "😀", "｡"])
        rows.append((k, rng.choice([None, "", " ".join(["w"] * rng.randrange(1, 60))]) if rng.random() < 0.9 else "x " * 500, source))
    got = by_id(mixing.mixture(docs(*rows)), "size", "source_size", "target", "taken")
    want = brute.mix([(i, s, t) for i, t, s in rows])
    assert got == {i: (n, size, pytest.approx(goal), taken) for i, (n, size, goal, taken) in want.items()}
    assert got == by_id(mixing.mixture(docs(*rows)), "size", "source_size", "target", "taken")
    by_source = {}
    for i, _, s in rows:
        by_source.setdefault(s, []).append(got[i])
        assert got[i][3] <= 3 * got[i][0]
    for own in by_source.values():
        assert abs(sum(r[3] for r in own) - own[0][2]) <= max(r[0] for r in own)


def test_mixture_edges(docs):
    assert mixing.mixture(docs((1, "a")).where("false")).collect() == []
    assert by_id(mixing.mixture(docs((1, None), (2, ""))), "size", "target", "taken") == {1: (0, 0.0, 0), 2: (0, 0.0, 0)}
    same = [tuple(r) for r in mixing.mixture(docs((1, "a b"), (1, "a b"), (None, "a b"))).collect()]
    assert len(same) == 3 and sum(r[4] for r in same) == 6
    left = mixing.drawn(docs((1, "a b"), (2, None)))
    assert left.columns == [*docs((1, "")).columns, "repeats"] and [r["doc_id"] for r in left.collect()] == [1]


def test_overlapping_sources(spark):
    rows = [(str(k), ["a", "b"] if k % 3 else ["a"], 10) for k in range(300)]
    got = mixing.mixed(spark.createDataFrame(rows, "id string, sources array<string>, size bigint")).collect()
    # all words once: weights 1 and 2 of 3,000 words fit without repeating any
    assert sum(r["taken"] for r in got) == 3000 and {r["repeats"] for r in got} == {1}


def test_any_number_of_sources(spark):
    """100,000 sources and no cap, against the targets by plain arithmetic."""
    rows = spark.range(150_000).selectExpr(
        "cast(id as string) as id", "array(concat('s', cast(id % 100000 as string))) as sources", "cast(1 + pow(id % 100000, 2) % 97 as bigint) as size"
    )
    got = mixing.mixed(rows).select("sources", "size", "source_size", "target", "taken").collect()
    sizes = {}
    for r in got:
        sizes[r["sources"][0]] = sizes.get(r["sources"][0], 0) + r["size"]
    goal = mixing.targets(sizes, {s: 1 + k % 3 for k, s in enumerate(sorted(sizes))}, sum(sizes.values()))
    assert len(got) == 150_000 and all(r["target"] == pytest.approx(goal[r["sources"][0]]) for r in got)
    taken = {}
    for r in got:
        taken[r["sources"][0]] = taken.get(r["sources"][0], 0) + r["taken"]
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["sources"][0]]
    assert all(abs(taken[s] - goal[s]) <= 98 for s in sizes)


def test_tied_sources_flow_together_and_others_alone(spark):
    """Groups of overlapping sources beside single ones give what one flow over all of them gives."""
    pick = random.Random(9)
    rows = []
    for k in range(400):
        group = pick.choice("abc")
        own = [f"{group}{n}" for n in range(4)]
        rows.append((str(k), pick.sample(own, pick.choice([1, 2, 3])) if group != "c" else [pick.choice(own)], pick.randrange(1, 30)))
    got = mixing.mixed(spark.createDataFrame(rows, "id string, sources array<string>, size bigint")).collect()
    patterns, total = {}, 0
    for _, own, size in rows:
        patterns[tuple(sorted(own))] = patterns.get(tuple(sorted(own)), 0) + size
        total += size
    sizes = {}
    for own, size in patterns.items():
        for s in own:
            sizes[s] = sizes.get(s, 0) + size
    goal = mixing.targets(sizes, {s: 1 + k % 3 for k, s in enumerate(sorted(sizes))}, total)
    each = sorted(patterns.items())
    flow = mixing.cheapest_flow(each, {s: round(g) for s, g in goal.items()})
    taken = {}
    for r in got:
        taken[tuple(sorted(r["sources"]))] = taken.get(tuple(sorted(r["sources"])), 0) + r["taken"]
    assert abs(sum(taken.values()) - sum(sum(f.values()) for f in flow)) <= 30 * len(each)
    cost = sum(max(0, n - patterns[own]) + max(0, n - 2 * patterns[own]) for own, n in taken.items())
    best = sum(max(0, sum(f.values()) - size) + max(0, sum(f.values()) - 2 * size) for (_, size), f in zip(each, flow))
    assert cost <= best + 60 * len(each)


def test_a_column_called_repeats_is_replaced(docs):
    table = docs((1, "a b"), (2, None)).withColumn("repeats", F.lit("clash")).withColumn("pattern", F.lit("clash"))
    left = mixing.drawn(table)
    assert left.columns == [*[c for c in table.columns if c != "repeats"], "repeats"] and [r["repeats"] for r in left.collect()] == [1]


def _same(got, want):
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    for g, w in zip(got[1], want[1]):
        assert g == pytest.approx(w) if any(isinstance(x, float) for x in g) else g == w


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    df = QUERIES[name](spark, SMALL)
    result = con.execute(ORACLES[name])
    _same(canonical(df.columns, [tuple(r) for r in df.collect()]), canonical([d[0] for d in result.description], result.fetchall()))


def test_queries_say_what_they_do():
    assert {q.split("_")[0] for q in QUERIES} == {"pipeline", *(f"op{k}" for k in range(1, 14))}
    assert all(q.__doc__ for q in QUERIES.values()) and all(f.__doc__ for _, f in corpus_pipeline.STAGES)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.scores(docs, model).where("score >= 0.5").collect()}
    rows = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] not in bad}
    left = {}
    for i, (n, gone, _, rest) in brute.lines([(i, r["text"]) for i, r in rows.items()]).items():
        if not n or gone < n:
            left[i] = rest
    left = {i: left[i] for i, (_, _, kept) in brute.near(sorted(left.items())).items() if kept}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = {i: left[i] for i, found in brute.contamination(sorted(left.items()), items).items() if not found[4]}
    want = {i: (left[i], size and taken // size) for i, (size, _, _, taken) in brute.mix([(i, rows[i]["source"], t) for i, t in left.items()]).items() if taken}
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == [*docs.columns, "repeats"]
    got = out.collect()
    assert {r["doc_id"]: (r["text"], r["repeats"]) for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) and r["source"] == rows[r["doc_id"]]["source"] for r in got)
