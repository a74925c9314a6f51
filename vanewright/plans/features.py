"""Feature passes. Training fits references and calls the same function as serving, so features cannot differ."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.functions.columns import EPISODE, META, clock, training_normal
from vanewright.operators import conform, joins, selection, stats, windows
from vanewright.operators.gramian import Make
from vanewright.session import stored


#: Beyond so many sensors, ordered features are computed episode by episode in numpy instead of by window expressions.
NARROW = 10


def engineered(df: DataFrame, curve: DataFrame | None, sensors: list[str], angles: Iterable[str] = (), power: str = "power", wind: str = "wind_speed", sizes: Iterable[int] = windows.WINDOWS, steps: Iterable[int] = windows.LAGS, curve_keys: tuple[str, ...] = ("farm_id", "asset_id"), clean: bool = True, pack: bool = False) -> DataFrame:
    """Zero runs masked (unless ``clean`` is False), curve residuals, rolling statistics, differences and lags of the first
    ten sensors, clock.

    pack: the numeric features as one packed column, see ``vectors.PACKED``, where the sensors are few and doubles.

    Up to NARROW sensors rows go through numpy in the order of their episodes, many episodes a batch (sensors of other types than
    double: window expressions, which share one exchange and one sort); beyond, an episode's columns are computed together.
    """
    angles = set(angles)
    masked = [c for c in sensors if clean and c not in (power, wind)]
    together = len(sensors) > NARROW and all(isinstance(df.schema[c].dataType, T.DoubleType) for c in masked)  # in one shuffle
    out = df if together or not masked else windows.mask_zero_runs(df, sensors, keep=(power, wind))
    if curve is not None:
        out = joins.against_curve(out, curve, power, wind, curve_keys)
    times = [x.alias(n) for n, x in clock().items()]
    if len(sensors) > NARROW:
        return windows.ordered_wide(out, sensors, angles, sizes, steps, mask=masked if together else ()).select("*", *times)
    if all(isinstance(out.schema[c].dataType, T.DoubleType) for c in sensors):
        if pack:
            return windows.ordered_narrow(out.select("*", *times), sensors, angles, sizes, steps, pack=(conform.numeric_columns(out), list(clock())))
        return windows.ordered_narrow(out, sensors, angles, sizes, steps).select("*", *times)
    w = windows.episode()
    new = []
    for n in sizes:
        for c in sensors:
            a, b = windows.rolling_circular(c, n, w) if c in angles else (windows.rolling_mean(c, n, w), windows.rolling_std(c, n, w))
            kind = ("circmean", "circstd") if c in angles else ("mean", "std")
            new += [a.alias(f"{c}_roll{n}_{kind[0]}"), b.alias(f"{c}_roll{n}_{kind[1]}")]
    top = sensors[:10]
    new += [(F.col(c) - F.lag(c).over(w)).alias(f"{c}_diff") for c in top]
    new += [F.lag(c, n).over(w).alias(f"{c}_lag{n}") for n in steps for c in top]
    return out.select("*", *new, *times)


def training_features(df: DataFrame, sensors: list[str], angles: Iterable[str] = (), curve_keys: tuple[str, ...] = EPISODE, **options) -> tuple[DataFrame, DataFrame]:
    """(features with label, curve): the curve is fitted to the normal training rows of each ``curve_keys``."""
    curve = stats.power_curve(df, keys=curve_keys)
    return conform.labelled(engineered(df, curve, sensors, angles, curve_keys=curve_keys, **options)), curve


def episode_features(df: DataFrame, sensors: list[str], angles: Iterable[str] = (), make: Make | None = None) -> tuple[DataFrame, DataFrame]:
    """(what ``training_features`` gives with the curve of each episode, its numbers as 4-byte floats; the same rows without the
    ordered features), for any number of sensors, doubles.

    One shuffle by episode, of the table's own columns: the curve, the order and the features follow in the same tasks. make:
    sensors that the table lacks are made of its numbers, by the tasks that need them, so that they are not sent."""
    own = joins.against_own_curve(windows.by_episode(df))
    rows = conform.labelled(own.withColumns(clock()))
    mask = [c for c in sensors if c not in ("power", "wind_speed")]
    ordered = rows.sortWithinPartitions(*EPISODE, "time_stamp", "id")
    out = windows.ordered_narrow(ordered, sensors, angles, mask=mask, floats=conform.numeric_columns(rows), last=[*clock(), "label"], make=make, dealt=True)
    return out, rows


def has_curve(df: DataFrame, power: str = "power", wind: str = "wind_speed") -> bool:
    """Whether every farm of the table has power and wind speed; where one lacks them, pooled models go without curves."""
    if not {power, wind} <= set(df.columns):
        return False
    return df.groupBy("farm_id").agg((F.count(F.col(power)) * F.count(F.col(wind))).alias("n")).where("n = 0").isEmpty()


def plain_sensors(sensors: list[str], angles: Iterable[str] = (), power: str = "power", wind: str = "wind_speed") -> list[str]:
    """Those that are normalised by asset: neither power, wind speed nor angles."""
    return [c for c in sensors if c not in {power, wind, *angles}]


def references(df: DataFrame, sensors: list[str], angles: Iterable[str] = (), curves: bool = True, normalise: bool = True, curve_keys: tuple[str, ...] = ("farm_id", "asset_id"), clean: bool = True) -> dict[str, DataFrame]:
    """Tables that features are computed with: ``curve`` by asset, and ``baseline`` of the plain sensors by asset, both of
    the normal training rows, zero runs masked (unless ``clean`` is False: they are already)."""
    cleaned = windows.mask_zero_runs(df, sensors, keep=("power", "wind_speed")) if clean else df
    out = {"curve": stats.power_curve(cleaned, keys=curve_keys)} if curves else {}
    plain = plain_sensors(sensors, angles)
    if normalise and plain:
        out["baseline"] = stats.baseline(windows.tall(cleaned.where(training_normal()), plain))
    return out


def with_references(df: DataFrame, refs: dict[str, DataFrame], sensors: list[str], angles: Iterable[str] = (), curve_keys: tuple[str, ...] = ("farm_id", "asset_id"), clean: bool = True, **options) -> DataFrame:
    """Features with label: zero runs masked (unless ``clean`` is False), plain sensors as z-scores of their asset where there is a baseline, then the
    ordered features of these. Training and serving call the same."""
    cleaned = windows.mask_zero_runs(df, sensors, keep=("power", "wind_speed")) if clean else df
    if "baseline" in refs:
        cleaned = joins.normalised_wide(cleaned, refs["baseline"], plain_sensors(sensors, angles))
    return conform.labelled(engineered(cleaned, refs.get("curve"), sensors, angles, curve_keys=curve_keys, clean=False, **options))


def gold(df: DataFrame, sensors: list[str], angles: Iterable[str] = (), most: int = 100, wide: int = 200, make: Make | None = None) -> tuple[DataFrame, DataFrame]:
    """(features, metadata): beyond ``wide`` columns only the ``most`` varying sensors are carried into windows. make: sensors
    that the table lacks are made of its numbers, see ``episode_features``."""
    chosen = sensors
    if len({*df.columns, *sensors}) > wide:
        rows = df.where(training_normal())
        if make:
            rows = rows.select([f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
            top = selection.top_varying(selection.column_stats(rows, sensors, make).withColumnRenamed("feature", "sensor"), most)
        else:
            top = selection.top_sensors(windows.tall(rows, sensors), most)
        chosen = [r["sensor"] for r in top.collect()]
    used = ["power", "wind_speed", *chosen]
    if all(isinstance(df.schema[c].dataType, T.DoubleType) for c in used if c in df.columns):
        out, rows = episode_features(df, used, angles, make)
    else:
        out = rows = training_features(df, used, angles)[0]
    names = conform.numeric_columns(out)
    meta = rows.groupBy(*EPISODE).agg(F.count("*").alias("n_rows"), F.sum("label").alias("n_abnormal"), F.max(F.col("expected_power").isNotNull()).alias("has_power_curve"))
    meta = meta.withColumn("n_features", F.lit(len(names))).withColumn("features", F.lit(",".join(names))).withColumn("preselected", F.lit(",".join(chosen) if chosen != sensors else None).cast("string"))
    return conform.narrowed(out, names), meta


def farm_pool(df: DataFrame, sensors: list[str], angles: Iterable[str] = (), select: bool = True, **options) -> tuple[DataFrame, list[str], dict[str, DataFrame]]:
    """(pooled normal training features, kept features, report tables).

    Cleaning comes before normalisation, and missingness is measured before NULLs become 0. Features are written once.
    """
    refs = {k: stored(v, k) for k, v in references(df, sensors, angles, has_curve(df)).items()}
    pool = stored(with_references(df, refs, sensors, angles, **options).where(training_normal()), "pool")
    names = conform.numeric_columns(pool)
    kept, diagnostics = selection.select_features(pool, names, protect=("power_residual", "power_residual_pct")) if select else (names, df.sparkSession.createDataFrame([], "feature string, reason string"))
    report = {
        "assets": stats.asset_counts(pool), "ranges": stats.date_ranges(pool, "farm_id"), "overlaps": joins.neighbour_overlaps(joins.training_ranges(df)),
        "missing": selection.column_stats(pool, names).select("feature", "missing_fraction"), "diagnostics": diagnostics, "curves": stats.curve_edges(df), **refs,
    }
    return pool.select(*META, *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).cast("float").alias(n) for n in kept]), kept, report
