"""The trie of conversation prefixes against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from framewright.llm import trie

ROW = "conv_id long, turn long, role string, text string, c string, d string"


def rebuilt(rows):
    own = {}
    key = lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")
    for c, _, role, text in sorted((x for x in rows if x[0] is not None), key=key):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = Counter(x[:-1] for x in members if x)
    saved, leaves = Counter(), Counter()
    for x, own in members.items():
        for d in range(len(x) + 1):
            saved[x[:d]] += (len(own) - 1) * len(x[-1][1].encode()) if x else 0
            leaves[x[:d]] += not children[x]
    rows = Counter()
    for x, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(x))
        rows[min(own), len(x), min(members[x[:-1]]) if x else None, len(own), children[x], leaves[x], saved[x], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return rows


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    say = ["a", "b", "é", "", None, "a b"]
    opening = [("user", x) for x in "abcdefghijkl"]
    out = []
    for c in range(90):
        turns = opening[: r.randint(0, 12)] if c % 3 else []
        turns = turns + [(r.choice(["user", "bot", None]), r.choice(say)) for _ in range(r.randint(0, 6))] or [("user", "a")]
        out += [(c, t if r.random() < 0.9 else None, *x) for t, x in enumerate(turns)]
    # a long conversation, one that is its opening, copies, a repeated row, the null conversation
    out += [(100, t, "user", str(t % 7)) for t in range(150)] + [(101, t, "user", str(t % 7)) for t in range(149)] + [(105, t, "user", str(t % 7)) for t in range(90)]
    out += [(c, t, "user", x) for c in range(200, 240) for t, (_, x) in enumerate(opening)] + out[:3] + [(None, 0, "user", "a"), (None, None, None, None)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*x, "c", "d") for x in rows], ROW).repartition(6)


@pytest.mark.parametrize(("run", "ids"), [(512, 4096), (4, 3)])
def test_nodes(spark, rows, monkeypatch, run, ids):
    monkeypatch.setattr(trie, "RUN", run)
    monkeypatch.setattr(trie, "IDS", ids)
    found = trie.shared_openings_trie(frame(spark, rows))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, found.collect())) == brute(rebuilt(rows))


@pytest.mark.parametrize("batches", [(64,), (8, 16, 24, 32, 48, 64)])
def test_batches_of_any_size_give_one_trie(spark, rows, batches):
    turns, lengths = trie.share_openings(trie.turns_of(frame(spark, rows)))
    assert Counter(map(tuple, trie.prefix_trie(turns, lengths, batches).collect())) == brute(rebuilt(rows))


@pytest.mark.parametrize("run", [512, 4])
def test_one_conversation_spells_edges_apart(spark, monkeypatch, run):
    """A batch leaves through two edges that conversation 1 spells, and not through the edges between them."""
    monkeypatch.setattr(trie, "RUN", run)
    trunk = lambda c, n: [(c, d, "user", str(d)) for d in range(1, n + 1)]
    lengths = {1: 20, 2: 4, 3: 8, 4: 12, 5: 3, 6: 15}
    rows = [x for c, n in lengths.items() for x in (trunk(c, n) if c < 5 else [*trunk(c, n - 1), (c, n, "bot", "leaves")])]
    turns = trie.staged(trie.prefixes(spark.createDataFrame(rows, "c long, d long, role string, text string")), "prefixes")
    paths = lambda *cs: spark.createDataFrame([(c, lengths[c]) for c in cs], "c long, n long")
    nodes = trie._insert(None, paths(1, 2, 3, 4), turns, 20)
    assert sorted(map(tuple, nodes.select("p", "e").collect())) == [(0, 4), (4, 8), (8, 12), (12, 20)]
    nodes = trie._insert(nodes, paths(5, 6), turns, 20)
    assert sorted(map(tuple, nodes.select("p", "e", "r").collect())) == [(0, 2, 1), (2, 3, 5), (2, 4, 1), (4, 8, 1), (8, 12, 1), (12, 14, 1), (14, 15, 6), (14, 20, 1)]


def test_many_leave_one_path(spark):
    """Conversations that leave one long path at any depth."""
    r, rows = random.Random(1), []
    for c in range(150):
        k = r.randint(0, 60)
        turns = [("user", f"t{t}") for t in range(k)] + [("bot", str(r.randrange(3))) for _ in range(r.randint(0, 3))]
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    assert Counter(map(tuple, trie.shared_openings_trie(frame(spark, rows)).collect())) == brute(rebuilt(rows))


def test_turnless_and_empty(spark):
    alone = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:3]
    got = trie.shared_openings_trie(frame(spark, [(c, 0, "user", "x") for c in alone])).collect()
    ends = hashlib.sha256(",".join(map(str, alone)).encode()).hexdigest()
    assert [tuple(r) for r in got] == [(alone[0], 0, None, 3, 0, 1, 0, ends)]
    assert trie.shared_openings_trie(frame(spark, [(1, 0, "user", "x")]).limit(0)).count() == 0


def test_two_fattest(spark):
    from pyspark.sql import functions as F

    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)] + [(2**50 - 1, 2**50 + 3), (5, 2**60 + 1)]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for a, b, f in rows:
        assert a < f <= b
        if b < 50:
            assert f & -f == max(x & -x for x in range(a + 1, b + 1))
