"""The gold pass in one shuffle: against the pass that joins curves and works episode by episode."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright import queries
from vanewright.plans import features
from vanewright.sources import events as src


def same(got, want, tolerance=1e-5):
    assert got.columns == want.columns
    a, b = ({(r["dataset_id"], r["id"]): r for r in d.collect()} for d in (got, want))
    assert a.keys() == b.keys()
    for k, r in b.items():
        for n in want.columns:
            x, y = a[k][n], r[n]
            if isinstance(y, float) and x is not None:
                assert x == pytest.approx(y, rel=1e-6, abs=tolerance), (k, n)
            else:
                assert x == y, (k, n)


@pytest.mark.parametrize("batch", ["3", "50", "10000"])
def test_runs_and_windows_cross_batches(spark, batch):
    """Episodes of 1 to 90 rows with runs of zeros, gaps and unknown winds, in batches shorter than windows and runs."""
    rng, rows, start = np.random.default_rng(8), [], dt.datetime(2024, 1, 1)
    for e, n in enumerate([1, 5, 6, 7, 90, 2, 40]):
        for k in range(n):
            draw = lambda: None if rng.random() < 0.1 else 0.0 if (k // 7) % 2 or rng.random() < 0.2 else float(rng.normal())  # noqa: E731,B023
            wind = None if k % 13 == 5 else float(k % 4 - 0.5)
            rows.append(("A", e, "t", len(rows), start + dt.timedelta(minutes=10 * k), "train" if k % 3 else "prediction", 4 if k % 5 == 0 else 0, draw(), wind, *[draw() for _ in range(11)]))
    names = [f"x{k}" for k in range(11)]
    df = spark.createDataFrame(rows, "farm_id string, dataset_id int, asset_id string, id int, time_stamp timestamp_ntz, train_test string, status_type_id int, power double, wind_speed double, " + ", ".join(f"{n} double" for n in names))
    used = ["power", "wind_speed", *names]
    want = features.training_features(df, used)[0].cache()
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got, rows = features.gold(df, names)
        same(got, features.conform.narrowed(want, features.conform.numeric_columns(want)))
        assert {(r["dataset_id"], r["n_rows"]) for r in rows.collect()} == {(e, n) for e, n in enumerate([1, 5, 6, 7, 90, 2, 40])}
        assert got.where("x0 is null").count() > df.where("x0 is null").count() > 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_sensors_made_in_tasks_are_those_of_the_table(spark, sf):
    base = src.load(spark, sf).where("dataset_id < 3").select("farm_id", "dataset_id", "asset_id", "id", "time_stamp", "train_test", "status_type_id", "power", "wind_speed")
    names = [f"s{k}" for k in range(12)]
    made = {n: F.col("power") * (k % 5) + F.col("wind_speed") * (k % 3) + 40 * F.sin(F.col("id") * (k + 1)) for k, n in enumerate(names)}
    got, meta = features.gold(base, names, make=queries._wide_sensors)
    same(got, features.gold(base.withColumns(made), names)[0])
    assert meta.first()["n_features"] == len(features.conform.numeric_columns(got))
    few = features.gold(base, names, wide=15, most=4, make=queries._wide_sensors)[1].first()["preselected"]
    assert few == features.gold(base.withColumns(made), names, wide=15, most=4)[1].first()["preselected"] and few.count(",") == 3


def test_wide_readings_are_shuffled_once(spark, sf):
    """The table's nine columns, not the sensors that are made of them; no group of Python an episode, no join with curves."""
    plan = queries.QUERIES["gold_wide_features"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FlatMapGroups" not in plan and "Join" not in plan
