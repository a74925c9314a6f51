import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vanewright.functions.columns import training_normal
from vanewright.operators import selection, vectors
from vanewright.plans import detectors, training
from vanewright.sources import events as src

SENSORS, ANGLES = ["power", "wind_speed", "sensor_0", "sensor_2"], ["sensor_0"]


@pytest.fixture(scope="module")
def prepared(spark, sf):
    df = src.load(spark, sf).where("dataset_id < 60")
    return [training._prepared(df, SENSORS, "farm", ANGLES, pack=p)[0] for p in (True, False)]


def test_pack_and_unpack():
    x = np.array([[1.5, np.nan, -0.0], [np.inf, 2.0, 3.0]])
    column = vectors.pack(np.concatenate([x, x]))
    assert np.array_equal(vectors.unpack(column.slice(1, 2), 3), x[[1, 0]], equal_nan=True)
    assert vectors.nested(x).to_pylist() == [[1.5, None, -0.0], [np.inf, 2.0, 3.0]]
    assert len(vectors.unpack(vectors.pack(x[:0]), 3)) == 0 and isinstance(column, pa.BinaryArray)


def test_packed_features_are_the_same(prepared):
    """One column holds all features; the names, their order, the vectors and the selection are those of the columns."""
    one, wide = prepared
    names = vectors.packed_names(one)
    assert len(one.columns) < 15 and names == training.conform.numeric_columns(wide) and len(names) > 40
    rows = [{r["id"]: r["x"] for r in detectors.vectors(d, names, ("farm_id",)).collect()} for d in prepared]
    assert rows[0] == rows[1] and any(None in v for v in rows[0].values())
    kept = [selection.select_features(d.where(training_normal()), names) for d in prepared]
    assert kept[0][0] == kept[1][0] and sorted(kept[0][1].collect()) == sorted(kept[1][1].collect())


@pytest.mark.parametrize("kind", list(detectors.DETECTORS))
def test_models_in_the_plan_score_as_blocks_do(prepared, monkeypatch, kind):
    """Few models are sent to the tasks: no row is shuffled to be scored, and scores are those of models dealt with blocks of rows."""
    monkeypatch.setattr(detectors, "SMALL", 0)
    options = {"trees": 20} if kind == "isolation_forest" else {}
    names = ["power", "sensor_2", "sensor_2_roll6_mean", "power_diff", "wind_speed_lag6"]
    found = []
    for most, feats in zip((detectors.MODELS, 0), prepared, strict=True):
        monkeypatch.setattr(detectors, "MODELS", most)
        fit, _ = training.split(feats)
        model = detectors.DETECTORS[kind](fit, names, ("farm_id",), **options)
        scored = model.score(feats.where("train_test = 'prediction'").drop("is_validation"))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert ("FlatMapCoGroups" in plan) == (most == 0)
        if most and kind != "sequence_autoencoder":
            assert "Exchange hash" not in plan
        found.append({(r["farm_id"], r["dataset_id"], r["id"]): r["score"] for r in scored.collect()})
    assert found[0].keys() == found[1].keys() and len(found[0]) > 100
    for k, v in found[0].items():
        assert v == pytest.approx(found[1][k], rel=1e-6, abs=1e-9)


def test_models_not_fitted_are_left_out(spark):
    x = spark.range(300).select(F.concat(F.lit("m"), F.col("id") % 3).alias("model"), "id", F.array(F.sin("id"), F.cos("id")).alias("x"))
    scaler = detectors.fit_preprocessor(x.where("model <> 'm1'"))
    z, old = (f(x, scaler).orderBy("id").collect() for f in (detectors.standardised, detectors.preprocessed))
    assert [r["id"] for r in z] == [r["id"] for r in old] and len(z) == 200
    assert all(np.allclose(a["x"], b["x"]) for a, b in zip(z, old, strict=True))


def test_features_are_cut_as_bytes(prepared):
    """Positions are picked without Python, in any order; the tasks that score read them in one pass."""
    one, _ = prepared
    names = vectors.packed_names(one)
    wanted = [names[k] for k in (3, 4, 5, 0, 9, 8)]
    x = detectors.rows_of(one, wanted, ("farm_id",))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan(x) and dict(x.dtypes)["x"] == "binary"
    at, read = [names.index(c) for c in wanted], vectors.reader(x)
    for r in x.join(one.select("id", vectors.PACKED), "id").limit(200).collect():
        assert np.array_equal(read(pa.array([r["x"]], pa.binary()))[0], np.frombuffer(r[vectors.PACKED])[at], equal_nan=True)
    assert len(detectors.listed(x).where("size(x) <> 6").take(1)) == 0
    assert plan(detectors.vectors(one, names, ("farm_id",))).count("InArrow") == 1 and vectors.packed_names(x) is None


def test_scores_of_packed_rows_are_one_pass(prepared, monkeypatch):
    monkeypatch.setattr(detectors, "SMALL", 0)
    feats = prepared[0]
    model = detectors.fit_isolation_forest(training.split(feats)[0], ["power", "sensor_2"], ("farm_id",), trees=5)
    plan = model.score(feats)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_pairs_of_the_same_sources_share_a_model(spark, sf, monkeypatch):
    fits = []
    monkeypatch.setitem(detectors.DETECTORS, "isolation_forest", lambda train, *a, f=detectors.fit_isolation_forest, **o: fits.append(1) or f(train, *a, **o))
    df = src.load(spark, sf).where("dataset_id < 45").withColumn("farm_id", F.element_at(F.array(*map(F.lit, "ABC")), (F.col("dataset_id") % 3 + 1).cast("int")))
    pairs = {"A_to_B": (["A"], ["B"]), "A_to_C": (["A"], ["C"]), "AB_to_C": (["A", "B"], ["C"]), "BA_to_C": (["B", "A"], ["C"])}
    out = training.cross_farm(df, src.event_records(df), SENSORS, pairs, names=["power", "sensor_2"], angles=ANGLES, trees=10)
    rows = {(r["experiment"], r["dataset_id"]): r["n_flagged_points"] for r in out.collect()}
    assert len(fits) == 2 and len(rows) == 60
    assert {k[1]: v for k, v in rows.items() if k[0] == "AB_to_C"} == {k[1]: v for k, v in rows.items() if k[0] == "BA_to_C"}


def test_directions_of_rows_not_standardised_yet(prepared, monkeypatch):
    """Tasks standardise and put sequences together as they add up: the products are those of the tables in between."""
    monkeypatch.setattr(detectors, "SMALL", 0)
    fit, names = training.split(prepared[0])[0], ["power", "sensor_2", "power_diff"]
    scaler = detectors.fit_scaler(fit, names, ("farm_id",))
    z = detectors.standardised(detectors.rows_of(fit, names, ("farm_id",)), scaler)
    for steps in (1, 6):
        old, new = detectors._principal(detectors._sequenced(z, steps) if steps > 1 else z, 2), detectors._principal(detectors.rows_of(fit, names, ("farm_id",)), 2, None, scaler, steps)
        a, b = ({r["model"]: np.abs(np.array(r["w"])) for r in d.collect()} for d in (old, new))
        assert a.keys() == b.keys() and a["A"].shape == (2, 3 * steps) and all(np.allclose(a[m], b[m], atol=1e-8) for m in a)


def test_comparison_fits_one_scaler(spark, sf, monkeypatch):
    fits, sizes = [], []
    monkeypatch.setattr(detectors, "fit_preprocessor", lambda *a, f=detectors.fit_preprocessor: fits.append(1) or f(*a))
    monkeypatch.setattr(training, "model_sizes", lambda *a, f=training.model_sizes: sizes.append(1) or f(*a))
    df = src.load(spark, sf).where("dataset_id < 30")
    out = training.compare(df, src.event_records(df), SENSORS, names=["power", "sensor_2"], trees=10)
    assert (len(fits), len(sizes)) == (1, 1)
    assert {r["model"]: r["count"] for r in out.groupBy("model").count().collect()} == dict.fromkeys(detectors.DETECTORS, 30)
