"""Columns that tasks make are made once, and their statistics are those of a table that has them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright import queries
from vanewright.operators import gramian, selection, stats

ROWS = 5000


def base(spark):
    """Values with NULLs, and an offset that the first rows lack."""
    v = F.when(F.col("id") % 7 != 3, F.sin(F.col("id").cast("double") * F.col("id")) * 3)
    return spark.range(0, ROWS, 1, 3).select(v.alias("v"), F.cos(F.col("id").cast("double")).alias("w"), F.when(F.col("id") < 40, 0.0).otherwise(1e6).alias("o"))


EXPRESSIONS = {"a": "v", "b": "o + w", "c": "o + w * 2 + v / 50", "d": "o * 0 + 5", "e": "v * -2 + w / 100", "f": "o + v"}


def making(log):
    def make(given, names):
        with open(log, "a") as f:
            f.write(f"{len(given['v'])}\n")
        v, w, o = (given[c] for c in "vwo")
        x = {"a": v, "b": o + w, "c": o + w * 2 + v / 50, "d": o * 0 + 5, "e": v * -2 + w / 100, "f": o + v}
        return np.stack([x[n] for n in names])

    return make


def made(log):
    return sum(map(int, log.read_text().split()))


@pytest.mark.parametrize("tile", [1024, 4])
def test_correlations_make_columns_once(spark, tmp_path, tile):
    df, names, log = base(spark), list(EXPRESSIONS), tmp_path / "made"
    got = {(r["a"], r["b"]): r["r"] for r in stats.correlations(df, names, tile=tile, make=making(str(log))).collect()}
    want = {(r["a"], r["b"]): r["r"] for r in stats.correlations(df.selectExpr(*[f"{x} AS {n}" for n, x in EXPRESSIONS.items()]), names).collect()}
    assert got.keys() == want.keys() and got["a", "d"] is None and len(got) == 15
    for k, r in want.items():
        assert got[k] is None if r is None else got[k] == pytest.approx(r, abs=1e-8), k
    if tile > len(names):
        assert made(log) <= ROWS + gramian.PIECE


def test_selection_makes_columns_once(spark, tmp_path):
    df, names, log = base(spark), list(EXPRESSIONS), tmp_path / "made"
    kept, reasons = selection.select_features(df, names, make=making(str(log)))
    assert made(log) <= ROWS + gramian.PIECE
    table = df.selectExpr(*[f"{x} AS {n}" for n, x in EXPRESSIONS.items()])
    want, told = selection.select_features(table, names)
    assert kept == want and sorted(map(tuple, reasons.collect())) == sorted(map(tuple, told.collect())) and {r["reason"] for r in told.collect()} == {"constant", "correlated"}
    few = selection.select_features(df.where("v is null"), names, make=making(str(log)))[1]
    assert ("a", "missing") in set(map(tuple, few.collect()))


def test_moments_of_sums_are_those_of_the_columns(spark, tmp_path):
    df, names = base(spark), list(EXPRESSIONS)
    make = making(str(tmp_path / "made"))
    centre = gramian.near(df, names, make)
    got = {r["feature"]: r for r in gramian.own_moments(gramian.pair_sums(df, names, centre, 4, make), names, centre, 4).collect()}
    for r in stats.moments(df, names, make).collect():
        g = got[r["feature"]]
        assert 1 - g["n"] / ROWS == pytest.approx(r["missing_fraction"]) and g["mean"] == pytest.approx(r["mean"]) and g["variance"] == pytest.approx(r["variance"], rel=1e-9, abs=1e-12)
    assert gramian.near(df.where("v is null"), names, make) is None and gramian.near(df.where("false"), names, make) is None


def test_waves_are_sines_of_the_keys_multiples():
    """Up to the last bit of a float, for keys of hundreds of millions."""
    given = {"key": np.arange(3000) * 7.0 + 378e6, **{c: np.random.default_rng(k).normal(size=3000) * 50 for k, c in enumerate(queries._BASE)}}
    at = [*range(1, 60), 554, 555]
    got = queries._wide_columns(given, [f"f{k}" for k in at])
    want = np.stack([(given[queries._BASE[k % 4]] + 30 * np.sin(given["key"] * ((k if k % 12 else k - 1) + 1))).astype(np.float32) for k in at])
    assert (got == want.astype(np.float64)).mean() > 0.999 and np.abs(got - want).max() < 1e-4
