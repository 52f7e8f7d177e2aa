import pytest
from pyspark.sql import functions as F

from test_summary import GROUPS, PROBS, check, random_rows
from wheelpace.config import HOUR, RUSH, SPEED, WEEKDAY, WEEKEND
from wheelpace.operators import histogram, stats
from wheelpace.operators import summary as S
from wheelpace.operators.facts import CUBE_KEYS, Facts, speed_cube


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, x double, y double")


@pytest.mark.parametrize("sort_rows, broadcast_rows", [(10**6, 10**6), (0, 10**6), (0, 0)])
def test_summaries_equal_pandas(spark, monkeypatch, sort_rows, broadcast_rows):
    rows = random_rows(2000, 4)
    df = frame(spark, rows)
    counted = histogram.count_values(df, ["x", "y"], ["k"])
    monkeypatch.setattr(S, "BROADCAST_ROWS", broadcast_rows)
    ranks = S.values_at_ranks
    monkeypatch.setattr(S, "values_at_ranks", lambda d, w, z, p: ranks(d, w, z, p, sort_rows, broadcast_rows))
    check(histogram.summarize(counted, df, GROUPS, PROBS), rows)


def test_two_merged_halves_equal_the_whole(spark, tmp_path):
    rows = random_rows(3000, 6)
    whole, left, right = (frame(spark, part) for part in (rows, rows[::3], [r for i, r in enumerate(rows) if i % 3]))
    stored = [histogram.load(spark, histogram.count_values(df, ["x", "y"], ["k"]).save(str(tmp_path / name)))
              for name, df in (("a", left), ("b", right))]
    merged, once = stored[0].merged(stored[1]), histogram.count_values(whole, ["x", "y"], ["k"])
    assert (merged.keys, merged.metrics) == (once.keys, once.metrics)
    key = ["k", "metric", "bucket"]
    got, want = ({tuple(r[c] for c in key): r for r in h.cells.collect()} for h in (merged, once))
    assert set(got) == set(want)
    for at, r in got.items():
        for c in ("n_rows", "n", "total", "spread", "low", "high"):
            assert (r[c] or 0) == pytest.approx(want[at][c] or 0, rel=1e-9, abs=1e-6 * max(1.0, abs(r["total"] or 0))), (at, c)
    check(histogram.summarize(merged, whole, GROUPS, PROBS), rows)
    with pytest.raises(ValueError, match="merged"):
        merged.merged(histogram.count_values(whole, ["x"], ["k"]))


def test_moments_keep_the_digits_of_large_numbers(spark):
    df = spark.range(1000).selectExpr("id % 2 as k", "1e9D + id as x")
    halves = [histogram.count_values(df.where(f"id % 3 {op} 0"), ["x"], ["k"]) for op in ("=", "<>")]
    row = halves[0].merged(halves[1]).moments("x").first()
    assert row["var"] == pytest.approx((1000 ** 2 - 1) / 12, rel=1e-9) and row["n"] == 1000


def test_one_scan_with_a_row_per_column(prepared):
    """Seven generated rows a trip, where every grouping and column used to be one; the cube needs no scan of its own."""
    metrics = Facts(prepared.trips).cfg.numeric
    counted = histogram.count_values(prepared.trips, metrics, CUBE_KEYS)
    plan = counted.cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(metrics) == 7
    generated = counted.cells._jdf.queryExecution().optimizedPlan().toString().split("Generate stack(")[1]
    assert generated.startswith("7,")


def test_facts_from_the_histogram_equal_those_from_the_trips(prepared):
    kept, direct = Facts(prepared.trips).settled(), speed_cube(prepared.trips)
    keys = [WEEKDAY, HOUR, WEEKEND, RUSH]
    got, want = ({tuple(r[k] for k in keys): r for r in c.collect()} for c in (kept.cube, direct))
    assert set(got) == set(want)
    for at, r in got.items():
        for c in ("n_rows", "n", "total", "var", "min", "max"):
            assert r[c] == pytest.approx(want[at][c], rel=1e-9, abs=1e-9)
    assert sorted(stats.correlation_matrix(kept.pairs, list(kept.cfg.numeric)).collect()) == sorted(
        stats.compute_correlation_matrix(prepared.trips).collect())


def test_only_wanted_buckets_are_read_again(prepared, monkeypatch):
    facts = Facts(prepared.trips, groupings={RUSH: [SPEED]})
    read = []
    ranks = S.values_at_ranks
    monkeypatch.setattr(S, "values_at_ranks", lambda values, *rest: read.append(values.agg(F.sum("c")).first()[0]) or ranks(values, *rest))
    assert facts.summary.count() == 2
    assert 0 < read[0] < 0.2 * prepared.rows


def test_empty_tables(spark):
    df = frame(spark, [("a", 1.0, 2.0)]).limit(0)
    counted = histogram.count_values(df, ["x"], ["k"])
    assert counted.cells.count() == 0 and histogram.summarize(counted, df, {"k": ["x"]}).count() == 0
