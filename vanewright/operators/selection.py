"""Feature selection and pre-selection, limits, samples and unions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.operators import gramian
from vanewright.operators.gramian import Make
from vanewright.operators.stats import correlations, moments
from vanewright.operators.vectors import PACKED, packed_names


def column_stats(df: DataFrame, columns: list[str], make: Make | None = None) -> DataFrame:
    """(feature, missing_fraction, mean, variance) in one pass over a wide table; beyond 50 columns by arrays, see ``moments``."""
    if len(columns) > 50 or make or packed_names(df) is not None:
        return moments(df, columns, make)
    cells = [F.struct(F.lit(c).alias("feature"), F.avg(F.isnull(c).cast("double")).alias("missing_fraction"), F.avg(F.col(c).cast("double")).alias("mean"), F.var_samp(c).alias("variance")) for c in columns]
    return df.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def select_features(df: DataFrame, columns: list[str], most_missing: float = 0.5, least_variance: float = 1e-8, most_correlation: float = 0.95, protect: Iterable[str] = (), make: Make | None = None) -> tuple[list[str], DataFrame]:
    """(kept columns, diagnostics (feature, reason)): missing, constant, or correlated with an earlier kept column.

    Statistics use all rows. Only the per-column and per-pair results, whose number the schema bounds, reach the driver,
    where the greedy choice in column order is made. make: the columns are made of the table's, see ``gramian.read``, and once.
    """
    packed = packed_names(df)
    keep, have = set(protect), [c for c in columns if make or c in (df.columns if packed is None else packed)]
    df = df if make else df.select(*have) if packed is None else df.select(PACKED)  # read twice, so a table is better than what is dear to compute
    reasons: list[tuple[str, str]] = []
    left = []
    centre = gramian.near(df, have, make) if make and have else None
    if centre is None:
        stats = {r["feature"]: r for r in column_stats(df, have, make).collect()} if have else {}
    else:  # one pass makes the columns, for all statistics
        sums, total = gramian.pair_sums(df, have, centre, make=make), df.count()
        stats = {r["feature"]: r.asDict() | {"missing_fraction": 1 - r["n"] / total} for r in gramian.own_moments(sums, have, centre).collect()}
    for c in have:
        if c not in keep and stats[c]["missing_fraction"] is not None and stats[c]["missing_fraction"] > most_missing:
            reasons.append((c, "missing"))
        elif c not in keep and stats[c]["variance"] is not None and stats[c]["variance"] < least_variance:
            reasons.append((c, "constant"))
        else:
            left.append(c)
    if centre is None:
        pairs = correlations(df, left, {c: stats[c]["mean"] for c in left}, most_correlation, make=make)
    else:
        pairs = gramian.correlated(sums, have, centre, above=most_correlation)
    near = {(r["a"], r["b"]) for r in pairs.collect()}
    kept: list[str] = []
    for c in left:
        if c in keep or not any((k, c) in near for k in kept):
            kept.append(c)
        else:
            reasons.append((c, "correlated"))
    return kept, df.sparkSession.createDataFrame(reasons, "feature string, reason string")


def top_sensors(t: DataFrame, most: int = 100, most_missing: float = 0.5, least_variance: float = 1e-8) -> DataFrame:
    """(sensor, variance): the sensors of most variance in tall readings, before features multiply them."""
    s = t.groupBy("sensor").agg(F.avg(F.isnull("value").cast("double")).alias("missing_fraction"), F.var_samp("value").alias("variance"))
    return top_varying(s, most, most_missing, least_variance)


def top_varying(s: DataFrame, most: int = 100, most_missing: float = 0.5, least_variance: float = 1e-8) -> DataFrame:
    """(sensor, variance) of most variance, of (sensor, missing_fraction, variance)."""
    return s.where((F.col("missing_fraction") <= most_missing) & (F.col("variance") >= least_variance)).orderBy(F.col("variance").desc(), "sensor").limit(most).select("sensor", "variance")


def most_missing(t: DataFrame, n: int = 10) -> DataFrame:
    return t.groupBy("sensor").agg(F.avg(F.isnull("value").cast("double")).alias("missing_fraction")).orderBy(F.col("missing_fraction").desc(), "sensor").limit(n)


def fixed_sample(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), the same in every run: by a hash of the keys."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)


def first_datasets(df: DataFrame, n: int) -> DataFrame:
    """Readings of the first n datasets by id."""
    ids = df.select("farm_id", "dataset_id").distinct().orderBy("farm_id", "dataset_id").limit(n)
    return df.join(ids, ["farm_id", "dataset_id"], "left_semi")


def pooled(frames: list[DataFrame], fill: float | None = None) -> DataFrame:
    """Union by name; columns that a frame lacks are NULL, or ``fill`` where numeric."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out if fill is None else out.fillna(fill)


def tagged_union(frames: dict[str, DataFrame], tag: str = "experiment") -> DataFrame:
    return pooled([f.withColumn(tag, F.lit(name)) for name, f in frames.items()])


def column_difference(df: DataFrame, other: DataFrame) -> tuple[list[str], list[str]]:
    """(only here, only there), from the schemas."""
    a, b = set(df.columns), set(other.columns)
    return sorted(a - b), sorted(b - a)
