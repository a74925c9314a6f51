import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright.functions import columns as c
from vanewright.operators import windows
from vanewright.plans import detectors, features
from vanewright.sources import events as src
from vanewright.streaming import jobs, processor

T0 = dt.datetime(2024, 1, 1)
SENSORS = ["power", "sensor_1"]


def rows(spark, values, asset="1", at=0):
    return spark.createDataFrame([("A", asset, k + at, T0 + dt.timedelta(minutes=10 * (k + at)), float(v)) for k, v in enumerate(values)], "farm_id string, asset_id string, id long, time_stamp timestamp, power double")


def value(key, f):
    return f["power"]


def run(spark, path, schema, tmp_path, *args, **options):
    df = processor.detected(jobs.source(spark, path, schema, maxFilesPerTrigger=1), *args, **options)
    q = jobs.sink(df, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    return q, spark.read.schema(df.schema).parquet(str(tmp_path / "out"))


def test_a_restart_in_the_middle_equals_the_batch(spark, sf, tmp_path):
    """Scores of a saved and loaded model, batch and stream; half of the files come after a restart."""
    df = src.load(spark, sf).where("dataset_id < 12").withColumn("asset_id", F.col("dataset_id").cast("string"))
    feats = features.engineered(df, None, SENSORS, clean=False).withColumn("time_stamp", F.col("time_stamp").cast("timestamp"))
    names = ["power", "sensor_1", "power_roll6_mean", "power_roll18_std", "sensor_1_roll36_mean", "power_diff", "power_lag6", "hour_sin", "dow_cos"]
    fitted = {k: detectors.DETECTORS[k](feats.where(c.training_normal()), names, ("farm_id",), **o) for k, o in (("linear_autoencoder", {"size": 3}), ("isolation_forest", {"trees": 20}))}
    raw = df.select("farm_id", "asset_id", "id", F.col("time_stamp").cast("timestamp").alias("time_stamp"), *SENSORS)
    cuts = [F.lit(f"2024-01-{d:02d}").cast("timestamp") for d in (1, 9, 17, 25)] + [F.lit("2025-01-01").cast("timestamp")]
    parts = [raw.where((F.col("time_stamp") >= a) & (F.col("time_stamp") < b)).coalesce(1) for a, b in zip(cuts, cuts[1:])]
    for kind, model in fitted.items():
        model.save(str(tmp_path / kind / "model"))
        model = detectors.Fitted.load(spark, str(tmp_path / kind / "model"))
        batch = model.score(feats)
        limits = batch.groupBy("model").agg(F.percentile("score", 0.7).alias("threshold"))
        score, limit = processor.by_model(model, limits)
        path = str(tmp_path / kind / "in")
        for half in (parts[:2], parts[2:]):
            for p in half:
                p.write.mode("append").parquet(path)
            q, out = run(spark, path, raw.schema, tmp_path / kind, SENSORS, score, limit, least_run=2, quiet_ms=400 * processor.DAY, forget_ms=500 * processor.DAY)
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 12 * (36 + 8)  # 36 readings, progress and timers a key
        got = {(r["asset_id"], r["id"]): r for r in out.collect()}
        w = windows.episode()
        flags = batch.join(limits, "model").withColumn("f", (F.col("score") >= F.col("threshold")).cast("int"))
        runs = flags.withColumn("g", F.row_number().over(w) - F.sum("f").over(w))
        want = runs.withColumn("n", F.sum("f").over(c.episode("farm_id", "dataset_id", "g"))).select("asset_id", "id", "score", "f", ((F.col("n") == 2) & (F.col("f") == 1)).alias("alarm")).collect()
        assert len(got) == len(want) and {r["kind"] for r in got.values()} == {"reading"}
        for r in want:
            mine = got[r["asset_id"], r["id"]]
            assert mine["score"] == pytest.approx(r["score"], abs=1e-6) and (mine["flag"], mine["alarm"]) == (r["f"], r["alarm"])
        assert sum(r["alarm"] for r in want) > 20


def test_alarms_cross_batches_once_a_run(spark, tmp_path):
    path, values = str(tmp_path / "in"), [5, 1, 5, 5, 5, 5, 5, 1, 5, 5]
    for a in range(0, 10, 3):
        rows(spark, values[a : a + 3], at=a).coalesce(1).write.mode("append").parquet(path)
    _, out = run(spark, path, rows(spark, [1]).schema, tmp_path, ["power"], value, lambda key: 3.0, sizes=(), steps=(), least_run=3)
    got = sorted((r["id"], r["flag"], r["alarm"]) for r in out.collect())
    assert [x[1] for x in got] == [int(v > 3) for v in values] and [x[0] for x in got if x[2]] == [4]


def test_late_and_silent(spark, tmp_path):
    path = str(tmp_path / "in")
    first, second = rows(spark, [1.0, 2.0, 3.0]), rows(spark, [9.0], at=2)  # the second repeats a reading already seen
    far = rows(spark, [1.0], asset="2", at=600)  # four days on
    for d in (first, second, far, rows(spark, [1.0], asset="2", at=601), rows(spark, [1.0], asset="2", at=9000), rows(spark, [1.0], asset="2", at=9001), rows(spark, [4.0], at=9002)):
        d.coalesce(1).write.mode("append").parquet(path)
    q, out = run(spark, path, first.schema, tmp_path, ["power"], value, lambda key: 100.0, sizes=(2,), steps=(1,), delay="1 hour", quiet_ms=3_600_000, forget_ms=20 * processor.DAY)
    got = [(r["asset_id"], r["id"], r["kind"]) for r in out.collect()]
    assert got.count(("1", 2, "late")) == 1 and got.count(("1", 2, "stale")) == 1
    assert got.count(("2", 601, "stale")) == 0  # its own next reading moved the watermark
    assert sum(k == "reading" for *_, k in got) == 3 + 4 + 1


def test_clock_is_that_of_batches(spark):
    times = [T0 + dt.timedelta(minutes=k * 777) for k in range(40)]
    df = spark.createDataFrame([(t,) for t in times], "time_stamp timestamp")
    want = df.select(*[x.alias(n) for n, x in c.clock().items()]).collect()
    got = processor.clock_arrays(np.array(times, "datetime64[us]").astype(np.int64))
    for n in ("hour_sin", "hour_cos", "dow_sin", "dow_cos"):
        assert got[n] == pytest.approx([r[n] for r in want], abs=1e-9)


def test_missing_models_and_values(spark, tmp_path):
    x = spark.createDataFrame([("m", [float(k), float(-k)]) for k in range(30)], "model string, x array<double>")
    df = x.select(F.lit("A").alias("farm_id"), F.col("x")[0].alias("a"), F.col("x")[1].alias("b"))
    fitted = detectors.fit_linear_autoencoder(df, ["a", "b"], ("farm_id",), size=1)
    score, limit = processor.by_model(fitted, spark.createDataFrame([("A", 0.5)], "model string, threshold double"))
    f = {"a": np.array([1.0, np.nan]), "b": np.array([-1.0, 3.0])}
    assert np.isnan(score(("B", "1"), f)).all() and limit(("B", "1")) == float("inf")
    assert score(("A", "1"), f)[0] == pytest.approx(0, abs=1e-9) and limit(("A", "1")) == 0.5
    with pytest.raises(ValueError, match="more than 0"):
        detectors.local(fitted, 0)


def test_a_key_is_one_row_of_state(spark, tmp_path):
    path = str(tmp_path / "in")
    for a in (0, 10):
        rows(spark, range(10), at=a).coalesce(1).write.mode("append").parquet(path)
    q, out = run(spark, path, rows(spark, [1]).schema, tmp_path, ["power"], value, lambda key: 3.0, sizes=(6,), steps=(), quiet_ms=processor.DAY, forget_ms=2 * processor.DAY)
    assert out.count() == 20 and q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1 + 2 * 2  # a value, two timers with their index
