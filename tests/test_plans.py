import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_windows import frame
from vanewright.operators import conform, joins, selection, stats, windows
from vanewright.plans import detectors, evaluation, features, serving, training, validation
from vanewright.sources import events as src

T0 = dt.datetime(2024, 1, 1)


def flags(spark, rows):
    """rows: (dataset, id, status, flag)."""
    return spark.createDataFrame([("A", d, "a", i, T0 + dt.timedelta(hours=i), "prediction", s, f) for d, i, s, f in rows], "farm_id string, dataset_id long, asset_id string, id long, time_stamp timestamp, train_test string, status_type_id int, flag int")


def test_every_branch_of_the_evaluation(spark):
    ev = spark.createDataFrame([("A", 1, False, None), ("A", 2, True, T0 + dt.timedelta(hours=4)), ("A", 3, True, None), ("A", 4, True, T0), ("A", 5, False, None), ("A", 6, True, T0 + dt.timedelta(hours=9))], "farm_id string, dataset_id long, is_anomaly boolean, onset timestamp")
    rows = [(1, 0, 0, 0), (1, 1, 2, 1), (1, 2, 4, 1), (1, 3, 0, 0)]
    rows += [(2, 0, 0, 0), (2, 1, 0, 1), (2, 2, None, 0), (2, 3, 0, 1), (2, 4, 0, 0), (2, 5, 2, 1)]
    rows += [(3, 0, 0, 1), (3, 1, 0, 0), (3, 2, 0, 1)]
    rows += [(4, 0, 4, 1), (4, 1, 4, 0), (4, 2, 4, 1)] + [(5, 0, 3, 1)] + [(6, 0, 0, 0), (6, 1, 0, 0)]
    got = {r["dataset_id"]: r for r in evaluation.evaluate(flags(spark, rows), ev).collect()}
    assert got[1]["accuracy"] == pytest.approx(2 / 3) and got[1]["coverage"] is None and got[1]["n_flagged_points"] == 1
    # Rows 1 and 3 are one run once the row without a status is gone: two runs with row 5.
    assert got[2]["coverage"] == pytest.approx(1.25 * 2 / (1.25 * 2 + 0.25 * 1 + 1)) and got[2]["reliability"] == pytest.approx(1.25 / 2.25) and got[2]["earliness_hours"] == 3
    assert got[3]["coverage"] == pytest.approx(2 / 3) and got[3]["earliness_hours"] is None
    assert got[4]["coverage"] is None and got[4]["reliability"] == pytest.approx(1.25 / 2.25) and got[4]["n_eval_points"] == 0
    assert got[5]["accuracy"] is None and got[6]["coverage"] == 0 and got[6]["reliability"] == 0 and got[6]["earliness_hours"] == 0
    s = evaluation.summarize(evaluation.evaluate(flags(spark, rows), ev)).first()
    assert (s["n_anomaly_datasets"], s["n_normal_datasets"]) == (4, 2) and 0 < s["composite"] < 1


def test_selection(spark):
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal(200), rng.standard_normal(200)
    rows = [(float(x), float(y), float(2 * x + 1), 1.0, None if k % 3 else 1.0 * k) for k, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    kept, why = selection.select_features(df, ["a", "b", "c", "d", "e", "absent"])
    assert kept == ["a", "b"] and {tuple(r) for r in why.collect()} == {("c", "correlated"), ("d", "constant"), ("e", "missing")}
    assert selection.select_features(df, ["a", "c"], protect=["c"])[0] == ["a", "c"]
    few = {(r["a"], r["b"]): r["r"] for r in stats.correlations(df, ["a", "b", "c", "d", "e"]).collect()}
    many = {(r["a"], r["b"]): r["r"] for r in stats.correlations(df, ["a", "b", "c", "d", "e"], tile=2).collect()}
    for k, v in few.items():
        assert (v is None and many[k] is None) or v == pytest.approx(many[k], abs=1e-9)


def test_psi(spark):
    rng = np.random.default_rng(1)
    make = lambda x: spark.createDataFrame([("s", float(v)) for v in x] + [("k", 1.0)], "sensor string, value double")
    r, c = rng.standard_normal(2000), rng.standard_normal(2000) + 1
    edges = np.linspace(min(r.min(), c.min()), max(r.max(), c.max()), 11)
    p, q = (np.maximum(np.histogram(x, edges)[0] / len(x), 1e-4) for x in (r, c))
    got = {x["sensor"]: x["psi"] for x in stats.psi(make(r), make(c)).collect()}
    assert got["s"] == pytest.approx(((q - p) * np.log(q / p)).sum()) and got["k"] == 0
    assert stats.retrain(stats.psi(make(r), make(c)), 1).first()["should_retrain"] and stats.retrain(stats.psi(make(r), make(r)), 31).first()["should_retrain"]


def test_events_join(spark):
    e = spark.createDataFrame([("A", "68.0", "x"), ("A", " t1 ", "y"), ("B", "5", "z")], "farm_id string, event_id string, event_label string")
    d = spark.createDataFrame([("A", "68"), ("A", "t1"), ("A", "9"), ("B", "77")], "farm_id string, dataset_id string")
    assert {(r["dataset_id"], r["event_label"]) for r in joins.with_events(d, e).collect()} == {("68", "x"), ("t1", "y"), ("9", None), ("77", "z")}


def test_forest_finds_outliers(spark):
    rng = np.random.default_rng(2)
    rows = [("A", 1, "a", k, T0, "train", 0, float(x), float(y)) for k, (x, y) in enumerate(rng.standard_normal((900, 2)))]
    odd = [("A", 1, "a", 5000 + k, T0, "prediction", 0, 9.0 + k, -9.0) for k in range(5)]
    schema = "farm_id string, dataset_id long, asset_id string, id long, time_stamp timestamp, train_test string, status_type_id int, x double, y double"
    tr, te = spark.createDataFrame(rows, schema), spark.createDataFrame(rows[:200] + odd, schema)
    for keys in ((), ("farm_id", "dataset_id")):
        out = detectors.isolation_forest(tr, te, ["x", "y"], keys, trees=40).collect()
        assert len(out) == 205 and min(r["score"] for r in out if r["id"] >= 5000) > 0
        assert sum(r["score"] > 0 for r in out if r["id"] < 5000) <= 12
        again = detectors.isolation_forest(tr, te, ["x", "y"], keys, trees=40).collect()
        assert sorted((r["id"], round(r["score"], 9)) for r in out) == sorted((r["id"], round(r["score"], 9)) for r in again)


def test_autoencoders_rebuild_what_is_linear(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k, v in enumerate(rng.standard_normal(300)):
        rows.append(("A", 1, "a", k, T0 + dt.timedelta(minutes=k), "train", 0, float(v), float(2 * v), float(-v)))
    rows.append(("A", 1, "a", 999, T0 + dt.timedelta(days=1), "prediction", 0, 1.0, -2.0, 3.0))
    df = spark.createDataFrame(rows, "farm_id string, dataset_id long, asset_id string, id long, time_stamp timestamp, train_test string, status_type_id int, x double, y double, z double")
    for f, extra in ((detectors.linear_autoencoder, {"size": 1}), (detectors.sequence_autoencoder, {"steps": 2, "size": 2})):
        out = {r["id"]: r["score"] for r in f(df.where("id < 999"), df, ["x", "y", "z"], ("farm_id",), **extra).collect()}
        assert out[999] > 0.5 and max(v for k, v in out.items() if k < 999) < 0.05


def test_saved_models_score_alike(spark, sf, tmp_path):
    """Train, save, load in another session: the same scores, flags and events of new readings."""
    df = src.load(spark, sf).where("dataset_id < 24").withColumn("dataset_id", F.col("dataset_id").cast("string"))
    sensors = ["power", "wind_speed", "sensor_1", "sensor_2", "sensor_0"]
    for strategy, detector, options in (("farm", "isolation_forest", {"trees": 25}), ("turbine", "sequence_autoencoder", {"steps": 2, "size": 3})):
        root = str(tmp_path / strategy)
        trained = training.fit(df, sensors, strategy, detector, ["sensor_0"], names=["power", "sensor_2", "sensor_1_roll6_mean", "power_residual"], least_run=2, **options)
        trained.save(root)
        other = spark.newSession()
        loaded = training.Trained.load(other, root)
        new = df.where("train_test = 'prediction'")
        rows = lambda d: sorted((r["dataset_id"], r["id"], round(r["score"], 9), r["flag"]) for r in d.collect())
        want, (events, flags) = rows(trained.score(new)), serving.batch_score(loaded, other.createDataFrame(new.toPandas(), new.schema))
        assert rows(flags) == want and len(want) == new.count() and {f for *_, f in want} == {0, 1}
        last = serving.predict_latest(loaded, new, F.lit("2024-02-01").cast("timestamp")).collect()
        by = {(d, i): s for d, i, s, _ in want}
        assert len(last) == new.select("farm_id", "asset_id").distinct().count() and all(r["is_over"] == (r["score"] >= r["threshold"]) and round(r["score"], 9) == by[r["dataset_id"], r["id"]] for r in last)
        one = trained.registry().first()["model"]
        assert serving.model_info(loaded.registry(), one).count() == 1 and serving.model_info(loaded.registry(), "none").count() == 0
        assert events.count() > 0 and loaded.registry().count() == trained.registry().count() > 0
        assert ("baseline" in loaded.references) == (strategy == "farm")  # models of several assets see normalised sensors


def test_pooled_models_see_normalised_sensors(spark, sf):
    """Two assets whose sensor differs by an offset only have the same features in a farm model."""
    one = src.load(spark, sf).where("dataset_id = 2")
    two = one.withColumns({"asset_id": F.lit("other"), "dataset_id": F.lit(4).cast("long"), "sensor_2": F.col("sensor_2") * 3 + 500})
    df = one.unionByName(two)
    feats, refs = training._prepared(df, ["power", "wind_speed", "sensor_2"], "farm", [])
    a, b = ({r["id"]: r["sensor_2_roll6_mean"] for r in feats.where(f"dataset_id = {d}").collect()} for d in (2, 4))
    assert any(v is not None for v in a.values()) and all(v == pytest.approx(b[k]) for k, v in a.items() if v is not None)
    assert not features.has_curve(df.withColumn("wind_speed", F.lit(None).cast("double"))) and features.has_curve(df) and not features.has_curve(df.drop("power"))


def test_failed_models_are_told(spark, sf):
    df = src.load(spark, sf).where("dataset_id < 12")
    few = df.where("dataset_id <> 4 or train_test = 'prediction'")
    run = training.run(few, src.event_records(df), ["power", "wind_speed"], "turbine", "linear_autoencoder", names=["power", "wind_speed"], size=1)
    assert [(r["model"], r["n_rows"]) for r in run["failed"].collect()] == [("A/4", 0)]
    assert run["results"].where("dataset_id = 4").count() == 0 and run["registry"].count() == df.select("dataset_id").distinct().count() - 1
    with pytest.raises(ValueError, match="at least 1"):
        training.fit(df.where("train_test = 'prediction'"), ["power", "wind_speed"], names=["power"])


def test_comparison_of_detectors(spark, sf):
    df = src.load(spark, sf).where("dataset_id < 8")
    out = training.compare(df, src.event_records(df), ["power", "wind_speed", "sensor_2"], trees=10)
    assert {(r["model"], r["n"]) for r in evaluation.compare_models(out).collect()} == {(m, 8) for m in detectors.DETECTORS} or out.groupBy("model").count().count() == 3


def test_wide_features_are_the_narrow_ones(spark, sf):
    df = src.load(spark, sf).where("dataset_id < 5")
    names = ["power", "sensor_0", "sensor_1", "sensor_2"]
    narrow = features.engineered(df, None, names, ["sensor_0"])
    wide = windows.ordered_wide(windows.mask_zero_runs(df, names, keep=("power", "wind_speed"), wide=0), names, ["sensor_0"])
    got, want = ({(r["dataset_id"], r["id"]): r.asDict() for r in d.collect()} for d in (wide, narrow))
    new = [n for n in narrow.columns if "_roll" in n or n.endswith("_diff") or "_lag" in n]
    assert set(new) <= set(wide.columns) and len(new) == 4 * 6 + 4 * 4
    for k, r in want.items():
        for n in new:
            a, b = got[k][n], r[n]
            if a is None or b is None:
                assert a is b, (k, n)
            elif "circmean" in n:
                assert abs((a - b + 180) % 360 - 180) < 1e-5 or r[n.replace("mean", "std")] > 200, (k, n)
            else:
                assert a == pytest.approx(b, abs=1e-5), (k, n)


def test_order_statistics_and_moments(spark):
    rng = np.random.default_rng(4)
    rows = [("a" if k % 3 else "b", None if k % 11 == 0 else float(round(v, 1)), 1e9 + float(v), 2e9 - 3 * float(v) + float(rng.standard_normal())) for k, v in enumerate(rng.standard_normal(700))]
    df = spark.createDataFrame([*rows, ("c", 5.0, 1e9, 2e9), ("d", None, 1e9, 2e9)], "g string, v double, p double, q double")
    got = {r["g"]: (r["m"], r["h"], r["top"]) for r in stats.exact_percentiles(df, ["g"], "v", {"m": 0.5, "h": 0.99, "top": 1.0}).collect()}
    for g in "abc":
        own = [v for x, v, *_ in [*rows, ("c", 5.0, 0, 0)] if x == g and v is not None]
        assert got[g] == pytest.approx(tuple(np.percentile(own, [50, 99, 100])))
    assert "d" not in got
    m = {r["feature"]: r for r in stats.moments(df, ["v", "p"]).collect()}
    own = np.array([r[2] for r in rows] + [1e9, 1e9])
    assert m["p"]["variance"] == pytest.approx(own.var(ddof=1)) and m["p"]["mean"] == pytest.approx(own.mean()) and m["v"]["missing_fraction"] == pytest.approx(sum(r[1] is None for r in rows) / 702 + 1 / 702)
    r = stats.correlations(df.repartition(5), ["v", "p", "q"], tile=2).where("a = 'p' and b = 'q'").first()["r"]
    q = np.array([r[3] for r in rows] + [2e9, 2e9])
    assert r == pytest.approx(abs(np.corrcoef(own - 1e9, q - 2e9)[0, 1]), abs=1e-6)  # large offsets cost no digits


def test_training_strategies(spark, sf):
    df = src.load(spark, sf).where("dataset_id < 30")
    ev = src.event_records(df)
    for strategy, n in (("farm", 2), ("global", 1)):
        run = training.run(df, ev, ["power", "wind_speed", "sensor_1"], strategy, "linear_autoencoder", names=["power", "wind_speed", "sensor_1", "hour_sin"], size=2)
        assert run["registry"].count() == n and run["results"].count() == df.select("dataset_id").distinct().count()
    pool, kept, report = features.farm_pool(df, ["sensor_1", "sensor_3"], sizes=(6,), steps=(1,))
    assert "sensor_3" not in kept and pool.count() == df.where("train_test = 'train' and status_type_id in (0, 2)").count() and report["assets"].count() > 0


def test_serving_and_training_features_agree(spark, sf):
    df = src.load(spark, sf).where("dataset_id < 6")
    trained, curve = features.training_features(df, ["sensor_1"], curve_keys=("farm_id", "asset_id"))
    served = features.engineered(df, curve, ["sensor_1"])
    names = [x for x in served.columns if x != "label"]
    assert sorted(map(str, trained.select(names).collect())) == sorted(map(str, served.select(names).collect()))


def test_validation(spark):
    good = frame(spark, [1.0] * 5, "power").withColumn("wind_speed", F.lit(1.0))
    bad = good.withColumns({"dataset_id": F.lit(2).cast("long"), "status_type_id": F.lit(9), "power": F.lit(-1.0), "train_test": F.lit("other"), "time_stamp": F.lit(T0)})
    checks = validation.report(good.unionByName(bad), ["power"], good.select("farm_id", "dataset_id"))
    failed = {(r["dataset_id"], r["name"]) for r in checks.where("not passed").collect()}
    assert failed == {(2, n) for n in ("status_values", "split_values", "ranges", "duplicates", "event_record")}
    assert {(r["dataset_id"], r["passed"]) for r in validation.verdict(checks).collect()} == {(1, True), (2, False)}
    raw = spark.createDataFrame([("A", 1, "x"), ("A", 1, "2024-01-01 00:00:00")], "farm_id string, dataset_id long, time_stamp string")
    assert validation.times_parse(raw).first()["severity"] == "ERROR"


def test_serving(spark):
    s = frame(spark, [0.1, 0.2, 0.3], "score")
    r = serving.latest_scores(s, F.lit(T0 + dt.timedelta(hours=3))).first()
    assert r["score"] == 0.3 and not r["is_fresh"] and r["warning"] == "Data is 160 minutes old | Only 3 readings; 36 or more are recommended"
    req = spark.createDataFrame([("a", '[{"time_stamp": "2024-01-01 00:00:00", "x": 1}]'), ("b", '[{"time_stamp": "bad", "x": 1}]'), ("c", "[]")], "request_id string, readings string")
    assert [r["request_id"] for r in serving.from_json(req, "time_stamp string, x double").collect()] == ["a"]


def test_conforming(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "1", "train", "0.0", "nan"), ("junk", "1", "train", "0", "1")], "Timestamp string, turbine_id string, split string, status string, s string")
    rows = conform.readings(raw).collect()
    assert len(rows) == 1 and rows[0]["status_type_id"] == 0 and rows[0]["s"] is None
    with pytest.raises(ValueError):
        conform.readings(raw.drop("split"))
    d = spark.createDataFrame([(0, "p_max", "Possible power", "no"), (1, "power_1", "Grid power", "false"), (2, "wind_speed_2", "Estimated wind", "no"), (3, "wind_speed_1", "Wind", "no"), (4, "angle", "Direction", "YES"), (5, "reactive_power", "x", "0")], "ordinal int, sensor_name string, description string, is_angle string")
    assert {tuple(r) for r in conform.preferred_sensors(d).collect()} == {("power", "power_1"), ("wind_speed", "wind_speed_1")}
    cols = spark.createDataFrame([("angle_avg", 0, "angle"), ("angle", 1, "angle"), ("angles", 2, "angles")], "column string, ordinal int, base string")
    assert {r["column"] for r in conform.flagged_columns(cols, d).collect()} == {"angle_avg", "angle"}
    assert {r["column"] for r in conform.primary_statistic(cols).collect()} == {"angle_avg", "angles"}
    assert windows.numbered(frame(spark, [1.0, 2.0])).count() == 2


def test_small_pools_are_refused(spark, sf):
    df = src.load(spark, sf).where("dataset_id = 2")
    with pytest.raises(ValueError, match="at least 50"):
        training.fit(df, ["power"], "farm", "linear_autoencoder", names=["power"])


def test_wide_features_take_one_shuffle_by_episode(spark, sf):
    """Beyond ten sensors, zero runs are masked in the pass that computes the ordered features, with the same results."""
    df = src.load(spark, sf).where("dataset_id < 4")
    made = {f"s{k}": F.when(F.col("id") % (k + 2) < 2, F.col("power") * k).otherwise(0.0) for k in range(12)}
    df, names = df.withColumns(made), ["power", "wind_speed", *made]
    got = features.engineered(df, None, names)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1
    two = features.engineered(windows.mask_zero_runs(df, names, keep=("power", "wind_speed")), None, names, clean=False)
    assert got.columns == two.columns
    a, b = ({r["id"]: r for r in d.select("id", "s3", "s7", "s7_roll6_mean", "s5_roll18_std", "s2_lag1").collect()} for d in (got, two))
    assert a == b and any(r["s7"] is None for r in a.values())
