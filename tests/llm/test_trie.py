import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordermill.llm import prefix_trie as pt
from ordermill.llm.store import ship
from tests.llm import brute

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, block int"


@pytest.fixture
def talk(spark):
    ship(spark)

    def make(rows):
        return spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA).repartition(5)

    return make


def _same(df, conversations):
    assert Counter(tuple(r) for r in df.collect()) == Counter(brute.trie(conversations))


def _talks(seed, n, words=("", "a", "é漢", "b")):
    """Conversations that share beginnings, with nulls, ties, gaps and repeated turns."""
    pick = random.Random(seed)
    rows = []
    for c in range(-3, n):
        if c % 7 == 3:
            continue
        for turn in range(pick.choice([1, 2, 3, 9, 12, 20])):
            number = None if turn == 1 and c % 4 == 0 else turn // 2 if c % 6 == 0 else turn * 3
            rows.append((c, number, pick.choice(["user", None, "bot"]) if c % 3 == 0 else "user", pick.choice([*words, None]) if turn > 2 else "hi"))
    return rows + [(None, 0, "user", "nobody"), (None, None, None, None)] + [rows[0]] * 2


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_agree_with_all_prefixes(talk, seed):
    rows = _talks(seed, 60)
    _same(pt.spliced_trie(talk(rows)), brute.rebuilt(rows))


def test_conversations_as_they_are(talk):
    rows = [(c, t, "user", f"{c % 3}-{t}") for c in range(12) for t in range(c)]
    _same(pt.prefix_trie(talk(rows)), brute.rebuilt(rows, most=1))


def test_long_conversations_lie_in_many_spans(talk, monkeypatch):
    monkeypatch.setattr(pt, "SPAN", 2)
    monkeypatch.setattr(pt, "CHUNK", 7)
    monkeypatch.setattr(pt, "ENDS", 2)
    monkeypatch.setattr(pt, "HEAVY", 2)
    rows = [(c, t, "user", str(t if t < 60 or c % 2 else -c)) for c in range(9) for t in range(40 + 8 * c)]
    rows += [(c, t, "user", str(t)) for c in range(100, 130) for t in range(24)]
    _same(pt.spliced_trie(talk(rows)), brute.rebuilt(rows))


def test_one_conversation_of_thousands_of_turns(talk):
    rows = [(5, t, "user", "same") for t in range(9000)] + [(c, 0, "user", "same") for c in range(40)]
    got = {(r["depth"], r["conv_id"]): r for r in pt.prefix_trie(talk(rows)).collect()}
    # the first turn is every one's, and all but the first depths are of the long one alone
    assert len(got) == 9002 and got[(9001, 5)]["n_leaves"] == 1 and got[(0, 0)]["n_convs"] == 40
    assert got[(1, 0)]["saved_tokens"] == 39 * 4 and got[(2, 5)]["parent_conv_id"] == 0 and got[(9001, 5)]["saved_tokens"] == 0


def test_copies_end_in_one_node(talk, monkeypatch):
    monkeypatch.setattr(pt, "ENDS", 16)
    rows = [(c, t, "user", str(t)) for c in range(1000, 3000, 5) for t in range(3)]
    nodes = pt.spliced_trie(talk(rows)).collect()
    assert Counter(map(tuple, nodes)) == Counter(brute.trie(brute.rebuilt(rows)))
    assert len(nodes) == 4 and {r["n_convs"] for r in nodes} == {400}


def test_no_conversations_no_root(talk):
    assert pt.spliced_trie(talk([(1, 1, "a", "b")]).where("false")).count() == 0
    assert pt.spliced_trie(talk([(None, 1, "a", "b")])).count() == 0


def test_texts_of_any_length(talk):
    rows = [(c, 0, "user", "x" * 2_000_000 + str(c % 2)) for c in (0, 1, 5, 6)]
    _same(pt.spliced_trie(talk(rows)), brute.rebuilt(rows))


def test_prefixes_that_aren_t_real_go_before_the_shuffle(talk, spark):
    plan = pt._rolled(pt.blocked(pt.placed(talk(_talks(3, 20)))), "min(conv_id) as conv_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    # read from the bottom up: Expand, then the filter, then the first exchange
    expand, kept = text.index("Expand ["), text.index("Filter ")
    assert text.index("Exchange hashpartitioning") < kept < expand and plan.select(F.max("level")).first()[0] == 8
