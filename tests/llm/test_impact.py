import math

import numpy as np
import pytest

from wheelpace.llm import impact

SCHEMA = "vec_id long, embedding array<float>, row string, score double, v string, rank int"


@pytest.fixture
def vectors(spark):
    """Vectors from (vec_id, components) pairs, with columns whose names clash."""
    return lambda *rows: spark.createDataFrame([(i, v, "r", 1.0, "v", 3) for i, v in rows], SCHEMA)


def by_hand(rows, top=10, every=100):
    """(query_id, rank, vec_id, score) from all products; rows count by their place, so repeated ids are apart."""
    whole = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for at, (i, q) in enumerate(whole):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for k, (j, v) in enumerate(whole) if k != at]
        out += [(i, n, None if unknown else j, -s) for n, (s, unknown, j) in enumerate(sorted(scored)[:top], 1)]
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def some(n, width, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, width))
    v = centres[rng.integers(0, 5, n)] + rng.normal(0, 0.7, (n, width))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).tolist()


@pytest.mark.parametrize("top, every", [(10, 20), (1, 7), (50, 33)])
def test_rows_equal_all_products(vectors, monkeypatch, top, every):
    monkeypatch.setattr(impact, "BLOCK_COMPONENTS", 1 << 11)  # blocks of 64 rows
    monkeypatch.setattr(impact, "QUERY_COMPONENTS", 1 << 8)
    rows = list(enumerate(some(700, 32)))
    assert found(impact.top_rows(vectors(*rows).repartition(3), top, every)) == by_hand(rows, top, every)


def test_search_stops_early_and_proves_it():
    """Few of the vectors are scored again, and never fewer than the best."""
    v = np.floor(1024 * np.array(some(4000, 64, 3), np.float64)).astype(np.int64)
    index = impact.index_block(np.arange(4000), np.arange(4000), np.ones(4000, bool), v)
    queries = v[:40]
    exact = queries @ v.T
    for i, members in impact.possible(index, queries, 10, np.full(40, -np.inf)):
        again = {int(x) for m in members for x in index["rows"][index["starts"][m]:index["starts"][m + 1]]}
        best = np.sort(exact[i])[::-1][10]  # its own row is one of the eleven
        assert set(np.nonzero(exact[i] >= best)[0].tolist()) <= again
        assert len(again) < 1000


def test_nulls_ties_copies_and_odd_lengths(vectors):
    rows = [(0, [1.0, 0.0]), (100, None), (200, [float("nan"), 1.0]), (300, [float("inf"), 1.0]), (400, [None, 1.0]),
            (1, [0.5, 0.5]), (2, [0.5, 0.5]), (5, [0.5, 0.25, 9.0]), (None, [0.5, 0.5]), (None, [0.5, 0.5]), (500, []),
            (-100, [-1.0, 0.5]), (600, [0.5, 0.5]), (600, [0.5, 0.5]), (3, [0.0, 0.0])]
    rows += [(1000 + i, [0.5, 0.5]) for i in range(1, 90)]  # one vector holds most rows
    assert found(impact.top_rows(vectors(*rows), 4)) == by_hand(rows, 4)
    assert found(impact.top_rows(vectors(*rows), 200)) == by_hand(rows, 200)


def test_few_rows_and_none(vectors):
    assert found(impact.top_rows(vectors((0, [1.0])))) == []
    assert impact.top_rows(vectors((0, [1.0])).limit(0)).count() == 0
    assert found(impact.top_rows(vectors((0, [1.0]), (1, [-0.5])))) == [repr((0, 1, 1, -524288))]
    assert found(impact.top_rows(vectors((0, []), (100, [])))) == sorted([repr((0, 1, 100, 0)), repr((100, 1, 0, 0))])


def test_large_components(vectors):
    rows = [(i, [2e5 * (-1) ** i + i, 3.0 * i, 1e5 - i]) for i in range(0, 300, 5)]
    assert found(impact.top_rows(vectors(*rows))) == by_hand(rows)
    with pytest.raises(Exception, match="components must be under"):
        impact.top_rows(vectors((0, [1e9]), (1, [1.0])))
