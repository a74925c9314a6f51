import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright.operators import drift, joins, stats
from vanewright.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def ranges(spark, rows):
    return spark.createDataFrame([("A", a, d, None if s is None else T0 + dt.timedelta(seconds=s), None if e is None else T0 + dt.timedelta(seconds=e)) for a, d, s, e in rows], "farm_id string, asset_id string, dataset_id long, start timestamp, end timestamp")


def test_overlaps_of_all_lengths(spark):
    rng = np.random.default_rng(0)
    rows = [(f"a{k % 3}", k, float(s), float(s + length)) for k, (s, length) in enumerate(zip(rng.uniform(-5e5, 5e5, 300), 10 ** rng.uniform(-6, 6, 300), strict=True))]
    rows += [("a0", 900, 5.0, 5.0), ("a0", 901, 5.0, 5.0), ("a0", 902, 4.0, 6.0), ("a0", 903, 6.0, 7.0), ("a1", 904, None, 3.0), ("a1", 905, 2.0, None), ("a2", 7, 0.0, 1.0), ("a2", 7, 0.0, 1.0)]
    rows = [(a, d, None if s is None else round(s, 6), None if e is None else round(e, 6)) for a, d, s, e in rows]
    got = sorted((r["asset_id"], r["dataset_id"], r["other"], r["overlap_start"], r["overlap_end"]) for r in joins.all_overlaps(ranges(spark, rows)).collect())
    at = lambda s: T0 + dt.timedelta(seconds=s)
    known = [(a, d, at(s), at(e)) for a, d, s, e in rows if s is not None and e is not None]
    want = sorted((x[0], x[1], y[1], max(x[2], y[2]), min(x[3], y[3])) for x in known for y in known if x[0] == y[0] and x[1] < y[1] and x[2] < y[3] and y[2] < x[3])
    assert got == want and len(got) > 500


def test_many_ranges_of_one_asset(spark):
    """100,000 ranges that touch a neighbour or none, and one that spans all."""
    n = 100_000
    r = spark.range(n).select(F.lit("A").alias("farm_id"), F.lit("one").alias("asset_id"), F.col("id").alias("dataset_id"), F.timestamp_seconds(F.col("id") * 600).alias("start"), F.timestamp_seconds(F.col("id") * 600 + F.when(F.col("id") % 10 == 0, 601).otherwise(300)).alias("end"))
    whole = spark.range(1).select(F.lit("A").alias("farm_id"), F.lit("one").alias("asset_id"), F.lit(n).cast("long").alias("dataset_id"), F.timestamp_seconds(F.lit(-5)).alias("start"), F.timestamp_seconds(F.lit(n * 600 + 999)).alias("end"))
    began = time.time()
    assert joins.all_overlaps(r.unionByName(whole)).count() == n // 10 + n
    assert time.time() - began < 60


def test_crowded_ranges_are_many_tasks(spark, monkeypatch):
    """Ranges that all share time are joined in parts, each pair once."""
    r = spark.range(400).select(F.lit("A").alias("farm_id"), F.lit("one").alias("asset_id"), F.col("id").alias("dataset_id"), F.timestamp_seconds(F.col("id")).alias("start"), F.timestamp_seconds(F.col("id") + 5000 + F.col("id") % 3 * 9000).alias("end"))
    monkeypatch.setattr(joins, "DENSE", 20)
    out = joins.all_overlaps(r)
    assert out.count() == out.distinct().count() == 400 * 399 // 2
    assert "_part" in out._jdf.queryExecution().optimizedPlan().toString()
    assert dict(joins.all_overlaps(r.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})).dtypes)["overlap_end"] == "timestamp_ntz"


def values(spark, rows):
    return spark.createDataFrame([("A", "s", T0 + dt.timedelta(hours=h), v) for h, v in rows], "farm_id string, sensor string, time_stamp timestamp, value double")


def test_counts_of_batches_add_up(spark, tmp_path):
    rng = np.random.default_rng(1)
    ref = values(spark, [(k % 48, float(v)) for k, v in enumerate(rng.normal(size=500))] + [(1, None)])
    cur = values(spark, [(48 + k % 48, float(v)) for k, v in enumerate(rng.normal(0.7, 1.5, size=400))])
    ends, root = drift.edges(ref), str(tmp_path / "log")
    assert drift.logged(spark, root).isEmpty()
    parts = cur.randomSplit([0.5, 0.5], 3)
    for k, batch in enumerate([ref, *parts, parts[1]]):  # the last batch comes twice
        drift.log(drift.day_counts(batch, ends), root, min(k, 2))
    counts = drift.logged(spark, root)
    assert counts.agg(F.sum("n")).first()[0] == 900 and counts.where("bin in (0, 21)").agg(F.sum("n")).first()[0] > 0
    day = F.lit("2024-01-03").cast("date")
    got = drift.between(counts, F.col("day") < day, F.col("day") >= day).first()
    a, b = ([r["value"] for r in d.where("value is not null").collect()] for d in (ref, cur))
    bounds = np.linspace(min(a), max(a), 21)
    share = lambda x: np.histogram(x, [-np.inf, *bounds[:-1], np.nextafter(bounds[-1], np.inf), np.inf])[0] / len(x)
    p, q = share(a), share(b)
    assert got["ks"] == pytest.approx(np.abs(np.cumsum(p - q)).max()) and (got["n_reference"], got["n_current"]) == (500, 400)
    p, q = np.maximum(p, 1e-4), np.maximum(q, 1e-4)
    assert got["psi"] == pytest.approx(((q - p) * np.log(q / p)).sum())
    assert got["ks"] <= stats.ks_distance(ref, cur).first()["ks"] + 1e-9  # of bins, so no larger than that of the values


def test_a_stream_logs_each_batch_once(spark, tmp_path):
    df = values(spark, [(h, float(h % 7)) for h in range(200)])
    path, log, progress = (str(tmp_path / n) for n in ("in", "log", "progress"))
    df.repartition(4).write.parquet(path)
    ends = drift.edges(df)
    for _ in range(2):  # a restart finds nothing new
        jobs.drift_log(jobs.source(spark, path, df.schema, maxFilesPerTrigger=1), ends, log, progress).awaitTermination()
    key = lambda d: sorted(map(str, d.select("farm_id", "sensor", "day", "bin", "n").collect()))
    assert key(drift.logged(spark, log)) == key(drift.day_counts(df, ends))


def test_one_value_and_no_value(spark):
    same = values(spark, [(0, 3.0), (1, 3.0)])
    assert {(r["bin"], r["n"]) for r in drift.day_counts(values(spark, [(0, 3.0), (0, 2.0), (0, 4.0), (0, None)]), drift.edges(same)).collect()} == {(0, 1), (1, 1), (21, 1)}
    assert drift.day_counts(same, drift.edges(same.where("false"))).isEmpty()
