import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, ROUTE, RUSH, SLOW, SPEED
from wheelpace.functions.features import add_model_features
from wheelpace.operators import boosting, model
from wheelpace.plans import runs
from wheelpace.sources import versions

QUICK = replace(DEFAULT, max_rounds=5)


@pytest.fixture(scope="module")
def marked(prepared):
    rows, threshold = model.create_target(prepared.trips, DEFAULT)
    return add_model_features(rows), threshold


def test_target(marked, prepared):
    rows, threshold = marked
    assert threshold == pytest.approx(prepared.trips.toPandas()[SPEED].quantile(0.25))
    assert rows.where(F.col(SLOW) != (F.col(SPEED) <= threshold).cast("int")).isEmpty()
    shares = {r[SLOW]: r["share"] for r in model.class_shares(rows).collect()}
    assert shares[1] == pytest.approx(0.25, abs=0.02) and sum(shares.values()) == pytest.approx(1)


def test_target_needs_speed(prepared):
    with pytest.raises(ValueError, match=SPEED):
        model.create_target(prepared.trips.drop(SPEED))


def test_split_is_stable_complete_and_exact(marked):
    rows, _ = marked
    train, test = model.split(rows)
    again, _ = model.split(rows.repartition(13))
    assert train.exceptAll(again.select(train.columns)).isEmpty()
    assert train.count() + test.count() == rows.count()
    counts = {r[SLOW]: r["n"] for r in model.class_shares(rows).collect()}
    wanted = model.wanted_test_rows(counts, 0.2)
    assert sum(wanted.values()) == math.ceil(0.2 * rows.count())
    assert {r[SLOW]: r["n"] for r in model.class_shares(test).collect()} == wanted
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_split_of_few_rows(spark):
    assert model.wanted_test_rows({0: 8, 1: 2}, 0.2) == {0: 2, 1: 0}
    assert model.wanted_test_rows({0: 1}, 1.0) == {0: 1, 1: 0}
    assert model.wanted_test_rows({}, 0.2) == {0: 0, 1: 0}
    rows = spark.createDataFrame([(0, i) for i in range(8)] + [(1, 8), (1, 9)], f"{SLOW} int, VendorID int")
    train, test = model.split(rows)
    assert (train.count(), test.count(), test.where(f"{SLOW} = 1").count()) == (8, 2, 0)
    assert [part.count() for part in model.split(rows.limit(0))] == [0, 0]


def test_fills(spark):
    df = spark.createDataFrame([("b", 1.0, 10), ("b", 2.0, 9), ("a", None, 9), ("a", 4.0, 10), (None, 8.0, None)],
                               "s string, x double, i int")
    fills = {r["column"]: r["fill"] for r in model.medians(df, ("x",)).collect()}
    assert fills == {"x": 3.0}
    counts = model.category_counts(df, ("s", "i"))
    assert {r["column"]: r["fill"] for r in model.most_frequent(counts).collect()} == {"s": "a", "i": "9"}
    codes = {(r["column"], r["category"]): r["code"] for r in model.ordinal_codes(counts).collect()}
    assert codes == {("s", "a"): 0, ("s", "b"): 1, ("i", "9"): 0, ("i", "10"): 1}


def test_fitted_codes_and_unseen_categories(marked, monkeypatch):
    """The position in the sorted training categories, and -1 for new ones, joined either way."""
    rows, threshold = marked
    train, test = model.split(rows)
    fitted = model.fit(train, threshold, replace(DEFAULT, max_rounds=1))
    routes = sorted({r[ROUTE] for r in train.select(ROUTE).distinct().collect()})
    for limit in (model.BROADCAST_CODES, 20, -1):
        monkeypatch.setattr(model, "BROADCAST_CODES", limit)
        scored = fitted.encode(test)
        for r in scored.select(ROUTE, f"x_{ROUTE}", "pickup_hour", "x_pickup_hour").collect():
            assert r[f"x_{ROUTE}"] == (routes.index(r[ROUTE]) if r[ROUTE] in routes else -1)
            assert r["x_pickup_hour"] == r["pickup_hour"]
        assert scored.where(f"x_{ROUTE} = -1").count() > 0


def test_a_frequent_category_is_not_shuffled(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 'hot', concat('r', id % 1000)) as route")
    codes = model.ordinal_codes(model.category_counts(rows, ("route",)))
    counts = {r["category"]: r["n"] for r in codes.collect()}
    for limit in (0, 1, 10, 500, 501, 1000):
        start = model.frequent_from(codes, limit)["route"]
        frequent = [c for c, n in counts.items() if start is not None and n >= start]
        assert len(frequent) <= limit and (start == 0) == (len(counts) <= limit)
        assert all(n <= 2 * 4000 / max(1, limit) for c, n in counts.items() if c not in frequent)
    fitted = model.SlowTripModel(None, codes, {}, ("route",), ("route",), 0.0, 0)
    new = rows.unionByName(spark.createDataFrame([(-1, "unseen"), (-2, None)], "id long, route string"))
    want = {r["id"]: r["x_route"] for r in fitted.encode(new).collect()}
    assert want[-1] == want[-2] == -1 and want[0] == want[2] != want[1]
    monkeypatch.setattr(model, "BROADCAST_CODES", 10)
    split = fitted.encode(new)
    assert {r["id"]: r["x_route"] for r in split.collect()} == want
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "rightHint=(strategy=broadcast)" in plan


def test_codes_are_numbered_across_ranges(spark):
    counts = spark.range(5000).selectExpr("concat('c', id % 2) as column", "string(id) as category",
                                          "if(id % 2 = 0, 0.0D, double(id)) as sort_key", "1L as n")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small ranges would be merged
    try:
        codes = {(r["column"], r["category"]): r["code"] for r in model.ordinal_codes(counts).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    texts = sorted(str(i) for i in range(0, 5000, 2))
    assert codes == {("c0", t): i for i, t in enumerate(texts)} | {("c1", str(i)): i // 2 for i in range(1, 5000, 2)}


def test_categories_are_counted_without_a_row_per_column(marked):
    train, _ = marked
    counts = model.category_counts(train, DEFAULT.categorical_features)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    for part in plan.split("Generate ")[1:]:
        assert part.splitlines()[1].strip(" :+-").startswith("Aggregate")
    got = {(r["column"], r["category"]): r["n"] for r in counts.collect()}
    pdf = train.select(*DEFAULT.categorical_features).toPandas()
    for c in DEFAULT.categorical_features:
        want = {str(k).lower() if isinstance(k, bool) else str(k): n for k, n in pdf[c].value_counts().items()}
        assert {k[1]: n for k, n in got.items() if k[0] == c} == want


def test_settings_reach_the_trees(marked):
    rows, threshold = marked
    trees = model.fit(rows, threshold, replace(DEFAULT, max_rounds=2, max_leaves=4)).trees
    assert trees.getNumTrees == 2 and all(sum(left < 0 for left in t.left) <= 4 for t in trees.trees)
    assert model.tree_settings() == boosting.Settings(0.08, 250, 31, 50, 1.0, 20, 1e-7)


def confused(spark, tn, fp, fn, tp):
    return spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long")


def test_metrics_by_hand(spark):
    row = model.metrics(confused(spark, 50, 10, 5, 35)).first()
    assert row["accuracy"] == 0.85
    assert (row["precision"], row["recall"]) == pytest.approx((35 / 45, 35 / 40))
    assert row["f1_score"] == pytest.approx(2 * (35 / 45) * (35 / 40) / (35 / 45 + 35 / 40))


def test_metrics_without_cases_are_zero(spark):
    row = model.metrics(confused(spark, 10, 0, 0, 0)).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (1.0, 0.0, 0.0, 0.0)
    assert tuple(model.metrics(confused(spark, 0, 0, 0, 0)).first()[4:]) == (0.0, 0.0, 0.0, 0.0)


def test_report_by_hand(spark):
    rows = {r["label"]: r for r in model.report(confused(spark, 50, 10, 5, 35)).collect()}
    assert rows["0"]["precision"] == pytest.approx(50 / 55) and rows["0"]["recall"] == pytest.approx(50 / 60)
    assert (rows["0"]["support"], rows["1"]["support"], rows["accuracy"]["support"]) == (60, 40, 100)
    assert rows["macro avg"]["recall"] == pytest.approx((50 / 60 + 35 / 40) / 2)
    assert rows["weighted avg"]["recall"] == pytest.approx(0.6 * 50 / 60 + 0.4 * 35 / 40)


def test_confusion(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (1, 1)], "slow_trip int, prediction int")
    assert tuple(model.confusion(df).first()) == (1, 1, 1, 2)


def test_weights_are_balanced(marked):
    rows = {r[SLOW]: r for r in model.class_weights(marked[0]).collect()}
    assert rows[0]["n"] * rows[0]["weight"] == pytest.approx(rows[1]["n"] * rows[1]["weight"])


def test_train_save_and_reload(prepared, tmp_path):
    fitted, metrics, report = model.train_and_evaluate(prepared.trips, QUICK, str(tmp_path))
    row = metrics.first()
    assert row["train_rows"] + row["test_rows"] == prepared.rows
    assert row["accuracy"] > 0.75 and row["recall"] > 0.5
    assert report.count() == 5
    assert 1 <= fitted.trees.getNumTrees <= 5


def test_changed_predictions_raise(marked, tmp_path):
    rows, threshold = marked
    train, test = model.split(rows)
    a = model.fit(train, threshold, QUICK)
    b = model.fit(train.withColumn(SLOW, 1 - F.col(SLOW)), threshold, QUICK)
    path = model.save_model(b, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="predictions changed"):
        model.verify_saved_model(a, path, test)


def test_whole_run(raw, tmp_path, spark):
    done = runs.run_all(raw, QUICK, str(tmp_path / "run"))
    assert done["info"]["final_rows"] == 986
    assert done["statistics"]["ttest"]["is_significant"]
    for path in done["paths"].values():
        assert (tmp_path / path).exists()
    assert spark.read.json(done["paths"]["metrics"]).first()["train_rows"] > 0


def test_a_run_is_taken_up_again(spark, raw, tmp_path):
    """A second run computes nothing; one that died goes on; another input or another setting starts anew."""
    raw.write.parquet(f"{tmp_path}/trips")
    source, folder = f"{tmp_path}/trips", f"{tmp_path}/run"
    cfg = replace(DEFAULT, max_rounds=2)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(runs, "train_from", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs.run_file(spark, source, folder, cfg)
    done = runs.run_file(spark, source, folder, cfg)
    assert done["computed"] == ["model"] and done["stages"]["cleaned"]["tables"]["cleaned"]["rows"] == 986
    again = runs.run_file(spark, source, folder, cfg)
    assert again["computed"] == [] and again["stages"] == done["stages"]
    assert runs.stored_tables(spark, again).count() == 26
    assert model.load_model(spark, done["stages"]["model"]["model"]).trees.getNumTrees == 2
    assert runs.run_file(spark, source, folder, replace(cfg, alpha=0.01, max_rounds=1))["computed"] == list(done["stages"])
    versions.publish(raw.limit(3), f"{folder}/cleaned")  # the cleaned table is replaced by another one
    assert runs.run_file(spark, source, folder, cfg)["computed"] == ["cleaned"]
    raw.limit(700).write.mode("append").parquet(source)
    assert "cleaned" in runs.run_file(spark, source, folder, cfg)["computed"]


def test_training_from_the_stored_table(spark, raw, tmp_path):
    done = runs.prepare(raw, path=str(tmp_path / "clean"))
    fitted, metrics, _ = runs.train_from(spark, str(tmp_path / "clean"), QUICK)
    assert metrics.first()["train_rows"] + metrics.first()["test_rows"] == done.rows and fitted.trees.getNumTrees == 5
    assert done.info["load"] == {"rows": raw.count(), "columns": len(raw.columns), "shape_match": True}
    assert done.profile["shape"].first()["n_rows"] == done.rows


def test_columns_that_are_null_in_all_training_rows_and_odd_text_are_encoded(spark, marked, tmp_path):
    rows, threshold = marked
    cfg = replace(DEFAULT, max_rounds=1, numeric_features=("tip_amount",), categorical_features=("note", "nothing", RUSH))
    notes = F.array(*(F.lit(t) for t in ("a\\tb", "ends with \\", "it's", "")))
    odd = rows.withColumns({"tip_amount": F.lit(None).cast("double"), "nothing": F.lit(None).cast("string"),
                            "note": F.element_at(notes, F.pmod(F.hash(SPEED), 4) + 1)})
    fitted = model.fit(odd, threshold, cfg)
    found = {r["note"]: r["x_note"] for r in fitted.encode(odd).select("note", "x_note").distinct().collect()}
    assert found == {"": 0, "a\\tb": 1, "ends with \\": 2, "it's": 3}
    assert fitted.encode(odd).where("x_nothing <> -1 or x_tip_amount <> 0").isEmpty()
    checked = model.verify_saved_model(fitted, model.save_model(fitted, str(tmp_path / "m")), odd)
    assert checked["rows"] == rows.count() and checked["differ"] == 0
