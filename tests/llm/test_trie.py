import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wheelpace.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, family string, shared string, k1 double"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture
def talks(spark):
    """Turns from (conv_id, turn, role, text), with columns whose names clash."""
    return lambda rows: spark.createDataFrame([(*r, "d", "f", "s", 1.0) for r in rows], SCHEMA)


def by_hand(rows):
    """Nodes from the prefixes themselves, sums over subtrees by walking up from every node."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = (own.get(c - c % 5, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        size = len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * size
    first = {p: min(c for c, _ in m) for p, m in members.items()}
    return sorted(repr((
        first[p], len(p), first[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p],
        hashlib.sha256(",".join(map(str, sorted(c for c, ends in m if ends))).encode()).hexdigest()))
        for p, m in members.items())


def found(df):
    return sorted(repr(tuple(r)) for r in df.select(*COLUMNS).collect())


def some(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 14])):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]),
                         rng.choice(["hi", "hi", "you", "é", "", None, f"t{rng.randrange(40)}"])))
    return [r for i, r in enumerate(rows) if (r[0], r[1]) not in {(q[0], q[1]) for q in rows[:i]}]  # no ties of turn


@pytest.mark.parametrize("cells", [trie.SEGMENT, None])
@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_plain_prefixes(talks, seed, cells):
    rows = some(120, seed)
    assert found(trie.prefix_nodes(talks(rows).repartition(3), cells)) == by_hand(rows)


def test_a_sketch_that_is_full_changes_nothing(talks, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 16)
    rows = some(60, 5)
    assert found(trie.prefix_nodes(talks(rows), 16)) == by_hand(rows)


def test_the_sketch_never_counts_too_low(talks, spark):
    rows = trie.prefixes(talks(some(150, 9)))
    marked = trie.screened(rows, trie.SEGMENT)
    sizes = marked.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("shared").alias("shared"))
    assert sizes.where("n > 1").count() > 20 and sizes.where("n > 1 and not shared").isEmpty()
    single = marked.groupBy("k1", "k2").count().where("count = 1").count()
    assert marked.where("not shared").count() > 0.8 * single


def test_copies_and_turnless_conversations(talks, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    copies = [(5 * i, t, "user", f"turn {t}") for i in range(60) for t in range(3)]
    # 1 takes its first turns from 0, which is short; conversations without own turns beyond those end early.
    rows = copies + [(5 * i + k, 0, "user", "only") for i in range(20) for k in (1, 2, 3)] + [(10_001, 0, "a", "x"), (None, 0, "a", "b")]
    assert found(trie.prefix_nodes(talks(rows))) == by_hand(rows)


def test_few_rows_and_none(talks):
    assert trie.prefix_nodes(talks([(0, 0, "a", "b")]).limit(0)).count() == 0
    for rows in ([(0, 0, "a", "b")], [(None, 1, "a", "b")], [(4, None, None, None)], [(7, 0, "u", "ü" * 100_000), (7, 1, "u", "")]):
        assert found(trie.prefix_nodes(talks(rows))) == by_hand(rows)


def test_repeated_rows_are_turns(talks):
    rows = [(0, 1, "a", "b")] * 3 + [(3, 1, "a", "b")] * 4 + [(6, 2, "x", "y")]
    assert found(trie.prefix_nodes(talks(rows))) == by_hand(rows)
