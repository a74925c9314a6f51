import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vanewright.functions import columns as c
from vanewright.operators import windows

T0 = dt.datetime(2024, 1, 1)


def frame(spark, values, name="x", dataset=1):
    rows = [("A", dataset, "a", k, T0 + dt.timedelta(minutes=10 * k), "train", 0, v) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, f"farm_id string, dataset_id long, asset_id string, id long, time_stamp timestamp, train_test string, status_type_id int, {name} double")


def by_id(df, *names):
    return [tuple(r[n] for n in names) for r in sorted(df.collect(), key=lambda r: r["id"])]


def runs(hits, least):
    out, k = [0] * len(hits), 0
    while k < len(hits):
        e = k
        while e < len(hits) and hits[e]:
            e += 1
        if e - k >= least:
            out[k:e] = [1] * (e - k)
        k = max(e, k + 1)
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.sampled_from([0.0, 0.0, 1.0, None]), min_size=1, max_size=40), st.integers(2, 6))
def test_zero_runs_are_the_plain_loop(spark, values, least):
    got = [v for (v,) in by_id(windows.mask_zero_runs(frame(spark, values), ["x"], least), "x")]
    mask = runs([v == 0 for v in values], least)
    assert got == [None if m else v for v, m in zip(values, mask, strict=True)]


def test_sustained_and_islands(spark):
    random.seed(1)
    values = [random.choice([0.0, 2.0, None, 5.0]) for _ in range(80)]
    flags = windows.sustained(frame(spark, values), "x", 2.0, 3)
    want = runs([v is not None and v >= 2 for v in values], 3)
    assert [f for (f,) in by_id(flags, "flag")] == want
    starts = [s for (s,) in by_id(windows.islands(flags), "run_start")]
    assert starts == [int(w == 1 and (k == 0 or want[k - 1] == 0)) for k, w in enumerate(want)]


def test_rolling_is_causal_and_needs_enough_values(spark):
    random.seed(2)
    values = [random.choice([None, random.random()]) for _ in range(60)]
    full = by_id(windows.rolling(frame(spark, values), ["x"], windows=(6, 18)), "x_roll6_mean", "x_roll18_std")
    cut = by_id(windows.rolling(frame(spark, values[:40]), ["x"], windows=(6, 18)), "x_roll6_mean", "x_roll18_std")
    assert full[:40] == cut
    for k in range(60):
        known = [v for v in values[max(0, k - 5) : k + 1] if v is not None]
        assert (full[k][0] is None) == (len(known) < 2)
        if len(known) >= 2:
            assert full[k][0] == pytest.approx(sum(known) / len(known))


def test_circular_mean_wraps(spark):
    rows = by_id(windows.rolling(frame(spark, [350.0, 10.0, 350.0, 10.0]), [], ["x"], (6,)), "x_roll6_circmean", "x_roll6_circstd")
    assert rows[0] == (None, None) and min(rows[1][0], 360 - rows[1][0]) < 1e-6 and 9 < rows[1][1] < 11


def test_tall_is_wide(spark):
    df = frame(spark, [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0])
    wide = by_id(windows.rolling(df, ["x"], windows=(6,)), "x_roll6_mean")
    assert wide == by_id(windows.rolling_tall(windows.tall(df, ["x"]), (6,)), "roll6_mean")


def test_sequences_are_padded_with_the_first(spark):
    got = by_id(windows.sequences(frame(spark, [1.0, None, 3.0]), ["x"], 3), "seq")
    assert got == [([[1.0]] * 3,), ([[1.0], [1.0], [0.0]],), ([[1.0], [0.0], [3.0]],)]


def test_tail_split(spark):
    rows = by_id(windows.tail_split(frame(spark, [1.0] * 11)), "is_validation")
    assert [v for (v,) in rows] == [False] * 9 + [True] * 2
    assert windows.tail_split(frame(spark, [1.0]), least_rows=2).count() == 0


def test_expressions(spark):
    df = spark.createDataFrame([("68.0", "nan", "2024-3-5", "Yes", 0.0), ("x", "inf", "05-03-2024 07:08", "0", 0.5), (None, "2.5", "03/05/2024", None, 0.75), (" 7 ", "", "31-02-2024 01:00", "1", None)], "a string, b string, d string, t string, w double")
    got = df.select(c.whole("a"), c.number("b"), c.event_time("d").cast("string"), c.truth("t"), c.wind_bin("w")).collect()
    assert [tuple(r) for r in got] == [(68, None, "2024-03-05 00:00:00", True, None), (None, None, "2024-03-05 07:08:00", False, 0), (None, 2.5, None, False, 1), (7, None, None, True, None)]


def test_masking_keeps_types_on_both_sides_of_the_switch(spark):
    df = frame(spark, [0.0] * 7 + [3.0, 0.0, 5.0], "x").select("*", F.col("x").cast("int").alias("i"), ((F.col("x") != 0).cast("long") * ((1 << 60) + 1)).alias("l"), F.col("x").cast("float").alias("f"), F.when(F.col("x") != 3, F.col("x").cast("decimal(9,2)")).alias("d"))
    few, many = (windows.mask_zero_runs(df, ["x", "i", "l", "f", "d"], wide=w) for w in (12, 1))
    assert few.dtypes == many.dtypes == df.dtypes
    rows = lambda d: sorted(map(str, d.collect()))
    assert rows(few) == rows(many) and few.where("l is null and i is null and f is null and d is null").count() == 7 and few.where(f"l = {(1 << 60) + 1}").count() == 2


def test_batches_of_episodes_are_the_window_expressions(spark):
    """Short and long episodes, gaps, a key of NULL, and batches that end within windows."""
    sizes = {1: 1, 2: 2, 3: 90, 4: 37, None: 8}
    rows = [(None if e is None else "A", e, k, T0 + dt.timedelta(minutes=k // 2), None if k % 5 == 3 else float((k * 7919) % 101) if k % 60 < 45 else 60.0, float((k * 37) % 360)) for e, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "farm_id string, dataset_id long, id long, time_stamp timestamp, x double, angle double")
    want = windows.lags(windows.differences(windows.rolling(df, ["x"], ["angle"]), ["x", "angle"]), ["x", "angle"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = {(r["dataset_id"], r["id"]): r.asDict() for r in windows.ordered_narrow(df, ["x", "angle"], ["angle"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == sum(sizes.values())
    for r in want.collect():
        own = got[r["dataset_id"], r["id"]]
        assert set(own) == set(want.columns)
        for n in want.columns:
            assert own[n] == (pytest.approx(r[n], abs=1e-6) if isinstance(r[n], float) else r[n]), (r["dataset_id"], r["id"], n)


def test_split_beside_the_rows_is_the_tail_split(spark, sf):
    from vanewright.functions.columns import training_normal
    from vanewright.sources import events as src

    df = src.load(spark, sf).where("dataset_id < 20").where("dataset_id <> 4 or id % 64 = 0")
    want = {(r["id"], r["is_validation"]) for r in windows.tail_split(df.where(training_normal()), least_rows=2).collect()}
    got = windows.with_split(df, training_normal(), least_rows=2)
    assert got.count() == df.count() and {(r["id"], r["is_validation"]) for r in got.where("is_validation is not null").collect()} == want
