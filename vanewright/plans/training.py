"""Training strategies: features, selection, split, detector, threshold, sustained flags, evaluation.

``fit`` gives a ``Trained``: every table that scoring needs. It can be saved, loaded in another session, and scores any
readings; ``run`` fits, scores the prediction rows and evaluates.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.functions.columns import EPISODE, META, training_normal
from vanewright.operators import conform, selection, stats, windows
from vanewright.operators.vectors import packed_names
from vanewright.plans import detectors, evaluation, features
from vanewright.session import stored

#: One model an episode, a farm, or for everything. Models of more than one asset get sensors normalised by asset.
STRATEGIES: dict[str, tuple[str, ...]] = {"turbine": EPISODE, "farm": ("farm_id",), "global": ()}

#: Normal training rows that a model of several episodes needs at least, all together.
LEAST_POOL = 50


def split(feats: DataFrame, share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(fit, validation): per episode the last share of its normal training rows validates; episodes under two rows go.
    Features that were prepared carry the default split."""
    if "is_validation" in feats.columns:
        return feats.where(~F.col("is_validation")), feats.where("is_validation")
    rows = windows.tail_split(feats.where(training_normal()), share, least_rows=2)
    return rows.where(~F.col("is_validation")), rows.where("is_validation")


def model_sizes(feats: DataFrame, keys: tuple[str, ...], least_rows: int = 2) -> DataFrame:
    """(model, n_rows, too_few) of every model that readings ask for: the rows that the split leaves to fit it, and whether
    they are fewer than ``least_rows``."""
    fit, _ = split(feats)
    named = detectors.vectors(fit.select(*META), [], keys).groupBy("model").agg(F.count("*").alias("n_rows"))
    wanted = detectors.vectors(feats.select(*META), [], keys).select("model").distinct()
    return wanted.join(named, "model", "left").select("model", F.coalesce("n_rows", F.lit(0)).alias("n_rows")).withColumn("too_few", F.col("n_rows") < least_rows)


def flagged(scores: DataFrame, limits: DataFrame, least: int = 6) -> DataFrame:
    """Scores with flags of runs at the model's threshold or above."""
    rows = scores.join(limits, "model")
    return windows.sustained(rows, "score", F.col("threshold"), least).drop("threshold")


@dataclass
class Trained:
    """References, detector, thresholds (model, threshold) and failed models (model, n_rows, error) of a strategy."""

    strategy: str
    sensors: list[str]
    angles: list[str]
    least_run: int
    references: dict[str, DataFrame]
    detector: detectors.Fitted
    limits: DataFrame
    failed: DataFrame

    @property
    def curve_keys(self) -> tuple[str, ...]:
        return EPISODE if self.strategy == "turbine" else ("farm_id", "asset_id")

    def registry(self) -> DataFrame:
        """(model, threshold, strategy, detector, n_features, features, schema_sha256), one row a fitted model."""
        names = self.detector.features
        return self.limits.withColumns({"strategy": F.lit(self.strategy), "detector": F.lit(self.detector.kind), "n_features": F.lit(len(names)), "features": F.lit(",".join(names)), "schema_sha256": F.sha2(F.lit(",".join(sorted(names))).cast("binary"), 256)})

    def features(self, df: DataFrame) -> DataFrame:
        return features.with_references(df, self.references, self.sensors, self.angles, curve_keys=self.curve_keys)

    def score(self, df: DataFrame) -> DataFrame:
        """Scores and sustained flags of readings, in the order of each episode."""
        return flagged(self.detector.score(self.features(df)), self.limits, self.least_run)

    def save(self, root: str) -> None:
        self.detector.save(f"{root}/detector")
        tables = {f"reference_{k}": v for k, v in self.references.items()} | {"limits": self.limits, "failed": self.failed, "registry": self.registry()}
        detectors.save_tables(tables, {"strategy": self.strategy, "sensors": self.sensors, "angles": self.angles, "least_run": self.least_run}, root)

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> Trained:
        tables, told = detectors.load_tables(spark, root)
        refs = {k.removeprefix("reference_"): v for k, v in tables.items() if k.startswith("reference_")}
        return cls(told["strategy"], told["sensors"], told["angles"], told["least_run"], refs, detectors.Fitted.load(spark, f"{root}/detector"), tables["limits"], tables["failed"])


def _prepared(df: DataFrame, sensors: list[str], strategy: str, angles: Iterable[str], pack: bool = False) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Features of all readings with their split, written once, and the references they come from. Readings with zero runs
    masked are written too: both references and the features read them, and each would run the windows again. pack: features
    as one column, so that a row is one value to write and to read in every pass over them."""
    keys = EPISODE if strategy == "turbine" else ("farm_id", "asset_id")
    cleaned = stored(windows.with_split(windows.mask_zero_runs(df, sensors, keep=("power", "wind_speed")), training_normal(), least_rows=2), "cleaned")
    refs = features.references(cleaned, sensors, angles, features.has_curve(cleaned), strategy != "turbine", keys, clean=False)
    refs = {k: stored(v, k) for k, v in refs.items()}
    return stored(features.with_references(cleaned, refs, sensors, angles, curve_keys=keys, clean=False, pack=pack), "features"), refs


def _selected(feats: DataFrame) -> list[str]:
    """Features that the normal training rows leave after missingness, variance and correlation; curve residuals stay."""
    rows = feats.where(training_normal())
    return selection.select_features(rows, packed_names(feats) or conform.numeric_columns(feats), protect=("power_residual", "power_residual_pct"))[0]


@dataclass
class _Chosen:
    """What every detector of a strategy is fitted on: features, rows to fit and to hold, models that fail."""

    features: list[str]
    fit: DataFrame
    held: DataFrame
    failed: DataFrame


def _chosen(feats: DataFrame, strategy: str, names: list[str] | None, least_rows: int) -> _Chosen:
    keys = STRATEGIES[strategy]
    if names is None:
        names = _selected(feats)
    if strategy != "turbine":
        pool = stats.guarded(feats.where(training_normal()), 1, "normal training rows")
        stats.guarded(pool, LEAST_POOL, "pooled normal training rows")
    fit, held = split(feats)
    sizes = stored(model_sizes(feats, keys, least_rows), "sizes")
    failed = sizes.where("too_few").drop("too_few").withColumn("error", F.concat_ws(" ", F.lit("fewer than"), F.lit(str(least_rows)), F.lit("normal training rows")))
    if not failed.isEmpty():
        ok = sizes.where("not too_few").select("model")
        name = detectors.model_name(keys)
        fit, held = (d.withColumn("model", name).join(ok, "model", "left_semi").drop("model") for d in (fit, held))
    stats.guarded(fit, 1, "normal training rows of models that can be fitted")
    return _Chosen(names, fit, held, failed)


def _fit(own: _Chosen, refs: dict[str, DataFrame], sensors: list[str], strategy: str, detector: str, angles: Iterable[str], percentile: float, least_run: int, **options) -> Trained:
    model = detectors.DETECTORS[detector](own.fit, own.features, STRATEGIES[strategy], **options)
    limits = stored(stats.threshold(model.score(own.held), ["model"], percentile=percentile), "limits")
    return Trained(strategy, list(sensors), list(angles), least_run, refs, model, limits, own.failed)


def fit(df: DataFrame, sensors: list[str], strategy: str = "farm", detector: str = "isolation_forest", angles: Iterable[str] = (), names: list[str] | None = None, percentile: float = 0.99, least_run: int = 6, least_rows: int = 2, **options) -> Trained:
    """Fit all models of a strategy on the normal training rows of readings.

    names: features to use; by default they are selected on the normal training rows. Models with fewer than
    ``least_rows`` rows to fit are told as failed; the others go on.
    """
    feats, refs = _prepared(df, sensors, strategy, angles, pack=True)
    return _fit(_chosen(feats, strategy, names, least_rows), refs, sensors, strategy, detector, angles, percentile, least_run, **options)


def run(df: DataFrame, events: DataFrame, sensors: list[str], strategy: str = "farm", detector: str = "isolation_forest", angles: Iterable[str] = (), names: list[str] | None = None, percentile: float = 0.99, least_run: int = 6, least_rows: int = 2, **options) -> dict[str, DataFrame]:
    """Tables of a run: scores of prediction rows with flags, thresholds, results, summary, failed models, registry rows."""
    feats, refs = _prepared(df, sensors, strategy, angles, pack=True)
    return _evaluated(_fit(_chosen(feats, strategy, names, least_rows), refs, sensors, strategy, detector, angles, percentile, least_run, **options), feats, events)


def _evaluated(trained: Trained, feats: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    flags = flagged(trained.detector.score(feats.where(F.col("train_test") == "prediction").drop("is_validation")), trained.limits, trained.least_run)
    results = evaluation.evaluate(flags, events)
    return {"flags": flags, "thresholds": trained.limits, "results": results, "summary": evaluation.summarize(results), "failed": trained.failed, "registry": trained.registry()}


def compare(df: DataFrame, events: DataFrame, sensors: list[str], names: list[str] | None = None, strategy: str = "farm", models: Iterable[str] = tuple(detectors.DETECTORS), angles: Iterable[str] = (), percentile: float = 0.99, least_run: int = 6, least_rows: int = 2, **options) -> DataFrame:
    """Results of several detectors on the same features, selection and split, tagged by model. options are the forest's."""
    feats, refs = _prepared(df, sensors, strategy, angles, pack=True)
    own = _chosen(feats, strategy, names, least_rows)
    scaler = detectors.fit_scaler(own.fit, own.features, STRATEGIES[strategy])  # the same for all
    one = lambda m: _fit(own, refs, sensors, strategy, m, angles, percentile, least_run, scaler=scaler, **(options if m == "isolation_forest" else {}))
    return selection.tagged_union({m: _evaluated(one(m), feats, events)["results"] for m in models}, "model")


def cross_farm(df: DataFrame, events: DataFrame, sensors: list[str], pairs: dict[str, tuple[list[str], list[str]]], names: list[str] | None = None, detector: str = "isolation_forest", angles: Iterable[str] = (), least_run: int = 6, **options) -> DataFrame:
    """Train on some farms, evaluate on others, each farm normalised by its own baselines; results tagged by pair.

    Features are selected on the normal training rows of each pair's source farms, unless ``names`` gives them.
    """
    feats, _ = _prepared(df, sensors, "global", angles, pack=True)
    out, fitted = {}, {}
    for name, (source, target) in pairs.items():
        farms = tuple(sorted(set(source)))
        if farms not in fitted:  # pairs with the same sources share their model
            own = feats.where(F.col("farm_id").isin(*farms))
            fit, held = split(own)
            model = detectors.DETECTORS[detector](fit, names or _selected(own), (), **options)
            fitted[farms] = model, stored(stats.threshold(model.score(held), ["model"]), "limits")
        model, limits = fitted[farms]
        rows = feats.where(F.col("farm_id").isin(target) & (F.col("train_test") == "prediction")).drop("is_validation")
        out[name] = evaluation.evaluate(flagged(model.score(rows), limits, least_run), events)
    return selection.tagged_union(out, "experiment")
