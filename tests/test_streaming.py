import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_windows import T0, frame
from vanewright.operators import windows
from vanewright.plans import detectors
from vanewright.streaming import jobs


@pytest.fixture
def stream(spark, tmp_path):
    def make(df, files=1):
        path = str(tmp_path / "in")
        ids = sorted(r["id"] for r in df.select("id").collect())
        for k in range(files):  # one after another, since a stream takes files by their age
            own = ids[k * len(ids) // files : (k + 1) * len(ids) // files]
            df.where(F.col("id").between(own[0], own[-1])).coalesce(1).write.mode("append").parquet(path)
        return jobs.source(spark, path, df.schema, maxFilesPerTrigger=1)

    return make


def run(spark, df, tmp_path, mode="append"):
    q = jobs.sink(df, str(tmp_path / "out"), str(tmp_path / "cp"), mode=mode)
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / "out"))


def test_stream_is_batch(spark, stream, tmp_path):
    values = [float(k % 7) for k in range(90)]
    df = frame(spark, values)
    out = run(spark, jobs.rolling_alarms(stream(df), "x", 3.0, rows=18, least_run=3), tmp_path).collect()
    batch = {r["id"]: (r["x_roll18_mean"], r["x_roll18_std"]) for r in windows.rolling(df, ["x"], windows=(18,)).collect()}
    assert len(out) == 90
    for r in out:
        for a, b in zip((r["roll_mean"], r["roll_std"]), batch[r["id"]], strict=True):
            assert (a is None and b is None) or a == pytest.approx(b)
    assert sum(r["alarm"] for r in out) == sum(k % 7 == 5 for k in range(90))


def test_duplicates_and_ingest(spark, stream, tmp_path):
    df = frame(spark, [1.0, 2.0])
    out = run(spark, jobs.deduplicated(stream(df.union(df))), tmp_path)
    assert out.count() == 2


def test_windows_and_sessions(spark, stream, tmp_path):
    df = frame(spark, [5.0] * 4).union(frame(spark, [5.0] * 3).withColumns({"time_stamp": F.col("time_stamp") + F.expr("interval 5 hours"), "id": F.col("id") + 10}))
    last = frame(spark, [0.0]).withColumns({"time_stamp": F.lit(T0 + dt.timedelta(days=3)), "id": F.lit(99).cast("long")})
    both = df.union(last).withColumns({"flag": (F.col("x") > 1).cast("int"), "score": F.col("x")})
    sessions = jobs.alarm_sessions(both).collect()
    assert sorted(r["n"] for r in sessions) == [3, 4]
    q = jobs.inference_log(stream(both, 2), str(tmp_path / "log"), str(tmp_path / "cp2"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 8
    out = run(spark, jobs.monitoring(spark.readStream.schema(both.schema).parquet(str(tmp_path / "in")), "1 day", None), tmp_path)
    assert sum(r["n"] for r in out.collect()) == 7
    slides = jobs.monitoring(both, "1 day", "6 hours").collect()
    assert sum(r["n"] for r in slides) == 4 * 8 and all(0 <= r["anomaly_rate"] <= 1 for r in slides)


def test_continuous_ingest(spark, tmp_path):
    """New raw files under other headers reach bronze once each."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "bronze")
    day = lambda k, t: spark.createDataFrame([("A", "WT", k, t, "train", "0.0", "1.5"), ("B", "WT", k + 1, "broken", "train", "0", "2")], "farm_id string, wt_id string, row_id long, timestamp string, split string, status_id string, x string")
    counts = []
    for k in range(3):
        if k < 2:
            day(10 * k, f"2024-01-0{k + 1} 00:00:00").coalesce(1).write.mode("append").parquet(raw)
        q = jobs.continuous_ingest(jobs.source(spark, raw, day(0, "").schema), out, str(tmp_path / "cp"))
        q.awaitTermination()
        counts.append(spark.read.parquet(out).count())
    assert counts == [1, 2, 2]
    got = spark.read.parquet(out).orderBy("id").collect()
    assert [(r["farm_id"], r["asset_id"], r["id"], r["status_type_id"], r["x"]) for r in got] == [("A", "WT", 0, 0, 1.5), ("A", "WT", 10, 0, 1.5)]


def test_scored_stream_is_batch(spark, stream, tmp_path):
    """Rolling features in a stream, scored by a saved and loaded detector, as in a batch."""
    rng = np.random.default_rng(0)
    df = frame(spark, [float(v) for v in rng.standard_normal(80)]).withColumn("asset_id", F.lit("a"))
    feats = df.select("farm_id", "asset_id", "id", "time_stamp", F.col("x").alias("value"), F.lit(0.5).alias("roll_mean"))
    root = str(tmp_path / "model")
    detectors.fit_isolation_forest(feats, ["value"], ("farm_id",), trees=20).save(root)
    model = detectors.Fitted.load(spark, root)
    rolled = jobs.rolling_alarms(stream(df, 2), "x", 9.0)
    q = jobs.scored(rolled, model, 0.0, str(tmp_path / "scores"), str(tmp_path / "cp"))
    q.awaitTermination()
    got = {r["id"]: (r["score"], r["flag"]) for r in spark.read.parquet(str(tmp_path / "scores")).collect()}
    want = {r["id"]: r["score"] for r in model.score(feats).collect()}
    assert len(got) == 80 and all(got[k][0] == pytest.approx(v) and got[k][1] == (v >= 0) for k, v in want.items())


def test_watchdog(spark, tmp_path):
    raw = str(tmp_path / "in")
    df = spark.createDataFrame([("A", "a", T0), ("A", "b", T0 + dt.timedelta(hours=1)), ("A", "a", T0 + dt.timedelta(hours=2))], "farm_id string, asset_id string, time_stamp timestamp")
    df.write.parquet(raw)
    q = jobs.watchdog(jobs.source(spark, raw, df.schema), quiet_ms=1500).writeStream.outputMode("append").format("memory").queryName("watched").start()
    try:
        for _ in range(60):
            time.sleep(0.5)
            rows = {(r["asset_id"], r["last_seen"], r["stale"]) for r in spark.table("watched").collect()}
            if len(rows) == 4:
                break
    finally:
        q.stop()
    assert rows == {(a, t, stale) for a, t in (("a", T0 + dt.timedelta(hours=2)), ("b", T0 + dt.timedelta(hours=1))) for stale in (False, True)}
