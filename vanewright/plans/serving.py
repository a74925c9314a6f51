"""Scoring windows of readings, freshness, and the model registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.functions.columns import fresh, joined_warning
from vanewright.operators import windows
from vanewright.plans.evaluation import detected_events
from vanewright.plans.training import Trained


def batch_score(trained: Trained, readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, rows with scores and flags) of new readings by a trained, possibly loaded, model."""
    flags = trained.score(readings)
    return detected_events(flags), flags


def latest_scores(scores: DataFrame, as_of: Column, keys: tuple[str, ...] = ("farm_id", "asset_id"), most_minutes: float = 60.0, full_window: int = 36) -> DataFrame:
    """The newest score of each asset, its age, and warnings about old data and short windows."""
    n = scores.groupBy(*keys).agg(F.count("*").alias("n_readings"))
    out = windows.latest(scores, 1, keys).join(n, list(keys))
    is_fresh, age = fresh("time_stamp", as_of, most_minutes)
    old = F.when(~is_fresh, F.concat(F.lit("Data is "), F.floor(age).cast("string"), F.lit(" minutes old")))
    short = F.when(F.col("n_readings") < full_window, F.concat(F.lit("Only "), F.col("n_readings").cast("string"), F.lit(f" readings; {full_window} or more are recommended")))
    return out.withColumns({"is_fresh": is_fresh, "age_minutes": age, "warning": joined_warning(old, short)})


def predict_latest(trained: Trained, readings: DataFrame, as_of: Column, **options) -> DataFrame:
    """The newest reading of each asset scored by a trained, possibly loaded, model: its score, threshold and whether it is
    over it, its age, and warnings. Sustained flags need the readings before it, so they are those of ``batch_score``."""
    scores = trained.detector.score(trained.features(readings)).join(trained.limits, "model")
    out = latest_scores(scores, as_of, **options)
    return out.withColumn("is_over", F.col("score") >= F.col("threshold"))


def freshness(df: DataFrame, as_of: Column, keys: tuple[str, ...] = ("farm_id", "asset_id"), most_minutes: float = 60.0) -> DataFrame:
    """(keys, latest, age_minutes, is_fresh)."""
    last = df.groupBy(*keys).agg(F.max("time_stamp").alias("latest"))
    ok, age = fresh("latest", as_of, most_minutes)
    return last.withColumns({"age_minutes": age, "is_fresh": ok})


def models(registry: DataFrame) -> DataFrame:
    """(strategy, detector, n_models, n_features) of a registry."""
    return registry.groupBy("strategy", "detector").agg(F.count("*").alias("n_models"), F.max("n_features").alias("n_features"))


def model_info(registry: DataFrame, model: str) -> DataFrame:
    """What is known of one model: strategy, detector, threshold, features and their fingerprint; no row for an unknown one."""
    return registry.where(F.col("model") == model).select("model", "strategy", "detector", "threshold", "n_features", "features", "schema_sha256")


def from_json(records: DataFrame, schema: str, column: str = "readings", most: int = 1000) -> DataFrame:
    """Readings of requests (request_id, readings as a JSON array); requests beyond ``most`` readings or with an
    unreadable time are refused whole."""
    parsed = records.withColumn("_r", F.from_json(column, f"array<struct<{schema}>>"))
    ok = F.col("_r").isNotNull() & (F.size("_r") > 0) & (F.size("_r") <= most) & F.forall("_r", lambda r: F.try_to_timestamp(r["time_stamp"].cast("string")).isNotNull())
    return parsed.where(ok).select(*[c for c in records.columns if c != column], F.posexplode("_r").alias("position", "_x")).select("*", "_x.*").drop("_x")
