"""Sketched percentiles, tiled products of columns, block residuals: against numpy, beyond every block size."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright.operators import gramian, selection, stats, vectors
from vanewright.plans import detectors


def table(spark, x, models=("m",), parts=4):
    rows = [(models[k % len(models)], [None if np.isnan(v) else float(v) for v in row]) for k, row in enumerate(x)]
    return spark.createDataFrame(rows, "model string, x array<double>").repartition(parts)




@pytest.mark.parametrize("kind", ["normal", "ties", "heavy"])
def test_bracketed_percentiles_are_exact(spark, monkeypatch, kind):
    rng = np.random.default_rng(3)
    x = {"normal": rng.normal(size=(24_000, 3)), "ties": rng.integers(0, 4, size=(24_000, 3)).astype(float), "heavy": rng.standard_cauchy(size=(24_000, 3))}[kind]
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 2] = np.where(np.arange(len(x)) < 50, x[:, 2], np.nan)  # few values
    df = table(spark, x).repartition(3)
    monkeypatch.setattr(vectors._Held.__init__, "__defaults__", (3 * 8 * 1000,))
    shares = [0.0, 0.01, 0.5, 0.99, 1.0]
    moments, got = vectors.percentiles(df, shares)
    want = np.nanpercentile(x, np.array(shares) * 100, axis=0)
    for r in got.collect():
        assert r["value"] == pytest.approx(want[r["share"], r["position"]], abs=1e-12), r
    m = moments.first()
    assert m["rows"] == len(x) and m["n"] == (~np.isnan(x)).sum(axis=0).tolist() and m["mean"] == pytest.approx(np.nanmean(x, axis=0)) and m["dev"] == pytest.approx(np.nanvar(x, axis=0) * m["n"])


def test_a_bracket_that_misses_is_made_wider(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=(9000, 2))
    monkeypatch.setattr(vectors._Held.__init__, "__defaults__", (2 * 8 * 1000,))
    real, picked, seen = vectors._brackets, vectors._picked, []
    monkeypatch.setattr(vectors, "_brackets", lambda row, shares, wide: [[(9.0, 9.5) for _ in shares] for _ in row["n"]] if wide == 1 else real(row, shares, wide))
    monkeypatch.setattr(vectors, "_picked", lambda *a: seen.append(1) or picked(*a))
    got = {r["position"]: r["value"] for r in vectors.percentiles(table(spark, x), [0.5])[1].collect()}
    assert got == pytest.approx({k: np.median(x[:, k]) for k in range(2)}) and len(seen) == 2


def test_many_models_and_none(spark):
    rng = np.random.default_rng(2)
    x, models = rng.normal(size=(900, 2)), [f"m{k}" for k in range(30)] + [None]
    got = {(r["model"], r["position"]): r["value"] for r in vectors.percentiles(table(spark, x, models), [0.25])[1].collect()}
    for k, m in enumerate(models):
        assert [got[m, p] for p in (0, 1)] == pytest.approx(np.percentile(x[k :: len(models)], 25, axis=0))
    empty = table(spark, x).where("false")
    assert vectors.percentiles(empty, [0.5])[1].count() == 0


def test_more_groups_than_brackets_have_room_for(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELLS", -1)
    df = spark.createDataFrame([(k % 5, float(k)) for k in range(100)], "g int, v double")
    got = {r["g"]: r["m"] for r in stats.exact_percentiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {g: np.median(np.arange(g, 100, 5)) for g in range(5)}
    x = table(spark, np.array([[1.0, 2.0], [3.0, np.nan], [8.0, 5.0]]), ("a", "a", "b"))
    few = sorted(map(str, detectors.fit_preprocessor(x).collect()))
    monkeypatch.setattr(vectors, "CELLS", 1_000_000)
    assert sorted(map(str, detectors.fit_preprocessor(x).collect())) == few


def test_keys_of_percentiles_keep_their_types(spark):
    df = spark.createDataFrame([(1, None, True, 2.0), (1, None, True, 4.0), (None, 'q"', False, 5.0)], "a long, b string, c boolean, v double")
    got = stats.exact_percentiles(df, ["a", "b", "c"], "v", {"m": 0.5})
    assert got.dtypes == [("a", "bigint"), ("b", "string"), ("c", "boolean"), ("m", "double")]
    assert {tuple(r) for r in got.collect()} == {(1, None, True, 3.0), (None, 'q"', False, 5.0)}
    assert stats.exact_percentiles(df, [], "v", {"m": 0.5}).first()["m"] == 4.0


def test_preprocessor_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 40)) * 10 + 3
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[:, 8] = np.nan, 4.0
    r = detectors.fit_preprocessor(table(spark, x)).first()
    med = np.nan_to_num(np.array([np.median(c[~np.isnan(c)]) if (~np.isnan(c)).any() else 0 for c in x.T]))
    full = np.where(np.isnan(x), med, x)
    std = full.std(axis=0)
    assert r["median"] == pytest.approx(med) and r["mean"] == pytest.approx(full.mean(axis=0))
    assert r["std"] == pytest.approx(np.where(std > 0, std, 1.0))


def test_tiles_equal_pairwise_correlation(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 40)) + 1e6
    x[:, 5], x[:, 6] = 7.0, x[:, 1] * -2
    x[rng.random(x.shape) < 0.05] = np.nan
    x[:, 9] = np.nan
    names = [f"c{k}" for k in range(40)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"{n} double" for n in names)).repartition(3)
    by_tile = []
    for tile in (40, 7, 1024):
        got = {(r["a"], r["b"]): r["r"] for r in stats.correlations(df, names, tile=tile).collect()}
        assert len(got) == 40 * 39 // 2
        by_tile.append(got)
        for (a, b), r in got.items():
            i, j = names.index(a), names.index(b)
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if i < j and (5 in (i, j) or 9 in (i, j)):
                assert r is None
            else:
                assert r == pytest.approx(abs(np.corrcoef(x[ok, i] - 1e6, x[ok, j] - 1e6)[0, 1]), abs=1e-9)
    assert {k for k, r in by_tile[0].items() if r and r > 0.9} == {(r["a"], r["b"]) for r in stats.correlations(df, names, above=0.9, tile=7).collect()} == {("c1", "c6")}


def test_few_and_many_columns_agree_on_what_is_constant(spark):
    """A side that varies by rounding only is constant, whatever the number of columns."""
    rows = [(0.1 + 0.2 if k % 2 else 0.3, float(k), float(-k)) for k in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double").select("*", *[F.col("b").alias(f"x{k}") for k in range(20)])
    few = {(r["a"], r["b"]): r["r"] for r in stats.correlations(df, ["a", "b", "c"]).collect()}
    many = {(r["a"], r["b"]): r["r"] for r in stats.correlations(df, df.columns).collect()}
    assert few == {k: many[k] for k in few} and few["a", "b"] is None and few["b", "c"] == pytest.approx(1)


def test_no_column_and_no_row(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert stats.correlations(df, ["a"]).count() == 0 and stats.correlations(df, ["a", "b"]).count() == 0
    assert selection.select_features(df, ["a", "b"])[0] == ["a", "b"]


def test_fan_in_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(gramian, "FAN", 2)
    monkeypatch.setattr(vectors, "FAN", 2)
    x = np.random.default_rng(7).normal(size=(300, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double").repartition(9)
    assert stats.correlations(df, ["a", "b"]).first()["r"] == pytest.approx(abs(np.corrcoef(x.T)[0, 1]))
    got = {r["position"]: r["value"] for r in vectors.percentiles(df.select(F.lit("m").alias("model"), F.array("a", "b").alias("x")), [0.5])[1].collect()}
    assert got == pytest.approx(dict(enumerate(np.median(x, axis=0))))


def test_residuals_of_blocks(spark):
    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(50, 12)), np.linalg.qr(rng.normal(size=(12, 12)))[0][:3]
    back = x @ w.T @ w
    assert detectors.residuals(x, w, chunk=7) == pytest.approx(((x - back) ** 2).mean(axis=1))
    assert detectors.residuals(x, w, last=4) == pytest.approx(((x - back)[:, -4:] ** 2).mean(axis=1))
    fitted = spark.createDataFrame([("m", w.tolist()), ("other", w.tolist())], "model string, w array<array<double>>")
    z = table(spark, x).withColumn("id", F.monotonically_increasing_id())
    got = detectors.scored(z, fitted, lambda m, f: detectors.residuals(m, vectors.matrix(f["w"].combine_chunks().flatten())), "score", rows=9)
    assert sorted(r["score"] for r in got.collect()) == pytest.approx(sorted(((x - back) ** 2).mean(axis=1)))


def test_principal_directions(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 50)) @ np.diag(np.linspace(3, 0.1, 50))
    w = np.array(detectors._principal(table(spark, x), 5).first()["w"])
    value, vector = np.linalg.eigh(x.T @ x / len(x))
    assert np.abs(np.diag(w @ vector[:, ::-1][:, :5])) == pytest.approx(np.ones(5), abs=1e-6)


def test_residual_time_is_linear_in_features():
    rng = np.random.default_rng(10)

    def seconds(p):
        x, w = rng.normal(size=(4000, p)), rng.normal(size=(16, p))
        took = []
        for _ in range(5):
            began = time.perf_counter()
            detectors.residuals(x, w)
            took.append(time.perf_counter() - began)
        return min(took)

    assert seconds(800) < 10 * seconds(200)


def test_small_models_keep_rows_not_trees(spark):
    """A model of few rows is one row of the forest, whatever the number of trees; no row is copied for each tree."""
    x = spark.range(90).selectExpr("concat('m', id % 3) as model", "id", "array(sin(id), cos(id), 1D) as x")
    forest = detectors.fit_forest(x, trees=300)
    assert forest.count() == 3
    scores = {r["id"]: r["raw"] for r in detectors.score_forest(x, forest).collect()}
    assert len(scores) == 90 and all(0 < v < 1 for v in scores.values())


def test_grown_trees_part_all_rows():
    """Trees of all rows end in one row each where depth allows, and varying features are tried alike."""
    from vanewright.plans.detectors import _grown

    x = np.arange(8.0)[:, None] * np.array([1.0, 0.0, -2.0, 5.0]) + np.array([0, 3.0, 0, 0])
    g = _grown(x, 200, 256, np.random.default_rng(0))
    assert g["sizes"].sum() == len(g["feature"]) and (g["sizes"] % 2 == 1).all()
    used = np.bincount(g["feature"][g["feature"] >= 0], minlength=4)
    assert used[1] == 0 and used[[0, 2, 3]].min() > 0.8 * used.sum() / 3
    roots = np.cumsum(g["sizes"]) - g["sizes"]
    for t in (0, 50, 199):  # every row reaches an end
        for row in x:
            k = 0
            for _ in range(4):
                n = roots[t] + k
                k = k if g["feature"][n] < 0 else (g["right"] if row[g["feature"][n]] > g["cut"][n] else g["left"])[n]
            assert g["feature"][roots[t] + k] < 0
    assert (_grown(np.ones((5, 3)), 10, 256, np.random.default_rng(0))["sizes"] == 1).all()


def test_small_models_are_fitted_as_large_ones(spark, monkeypatch):
    """Scaler, directions and percentiles of small models, grouped, are those of the sketches."""
    x = spark.range(400).selectExpr("concat('m', id % 7) as model", "id", "array(sin(id), if(id % 5 = 0, null, cos(id)), 1D, id % 11 * 1D) as x")
    fit = lambda: {r["model"]: [*r["median"], *r["mean"], *r["std"]] for r in detectors.fit_preprocessor(x).collect()}
    z = x.selectExpr("model", "id", "array(sin(id), cos(id * id), id % 11 / 5D) as x")
    way = lambda: {r["model"]: np.abs(np.array(r["w"])) for r in detectors._principal(z, 2).collect()}
    t = x.selectExpr("model", "x[3] + x[0] as score")
    cut = lambda: {r["model"]: r["threshold"] for r in stats.threshold(t, ["model"], percentile=0.9).collect()}
    small = fit(), way(), cut()
    monkeypatch.setattr(detectors, "SMALL", 0)
    monkeypatch.setattr(stats, "FEW", 0)
    large = fit(), way(), cut()
    for a, b in zip(small, large, strict=True):
        assert set(a) == set(b) and len(a) == 7
        for k in a:
            assert np.allclose(a[k], b[k], rtol=1e-9, atol=1e-9)


def test_rows_of_a_model_do_not_meet_for_its_size(spark):
    """Two models of many rows: their number of blocks is broadcast, so that no task reads all rows of a model."""
    x = spark.range(200).selectExpr("concat('m', id % 2) as model", "id", "array(sin(id), cos(id)) as x")
    plan = detectors.scored(x, x.selectExpr("concat(model, '') as model", "x as w").limit(2), lambda m, t: m[:, 0], "raw", rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
