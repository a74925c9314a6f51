"""Projections and filters that bring readings into their canonical form."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.functions.columns import META, abnormal, truth, whole

#: Accepted headers of each canonical column, in order of preference.
ALIASES = {
    "time_stamp": ("time_stamp", "timestamp", "time"),
    "asset_id": ("asset_id", "turbine_id", "wt_id"),
    "train_test": ("train_test", "split"),
    "status_type_id": ("status_type_id", "status_id", "status"),
    "id": ("id", "row_id"),
}
REQUIRED = ("time_stamp", "train_test", "status_type_id")
#: Words that make a description a less likely measured power.
THEORETICAL = ("possible", "estimated", "theoretical", "capacity")
#: Parts of names that tell of power and of wind speed where no description does.
POWER_HINTS = ("power",)
WIND_HINTS = ("wind_speed", "windspeed")


def canonical(df: DataFrame, aliases: Mapping[str, Iterable[str]] = ALIASES) -> DataFrame:
    """Rename the first alias found of each canonical column; names are compared trimmed and in lower case."""
    have = {c.strip().lower(): c for c in reversed(df.columns)}
    renames = {}
    for name, options in aliases.items():
        hit = next((have[o] for o in options if o in have), None)
        if hit and hit != name and name not in df.columns:
            renames[hit] = name
    return df.withColumnsRenamed(renames)


def require(df: DataFrame, columns: Iterable[str] = REQUIRED) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def readings(df: DataFrame) -> DataFrame:
    """Typed metadata, sensors as doubles without NaN, rows without a readable time dropped (see ``unreadable_times``)."""
    df = require(canonical(df))
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.name == "time_stamp":
            c = c.cast("timestamp") if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.try_to_timestamp(c.cast("string"))
        elif f.name == "status_type_id":
            c = whole(c)
        elif f.name == "id":
            c = c.try_cast("double").try_cast("long")
        elif f.name in ("farm_id", "asset_id", "train_test"):
            c = c.cast("string")
        elif f.name not in META:
            x = c.try_cast("double")
            c = F.when(~F.isnan(x), x)
        out.append(c.alias(f.name))
    return df.select(*out).where("time_stamp is not null")


def unreadable_times(df: DataFrame) -> DataFrame:
    """(n_rows, n_dropped) of raw readings."""
    t = F.col("time_stamp").cast("string")
    return canonical(df).agg(F.count("*").alias("n_rows"), F.count_if(F.try_to_timestamp(t).isNull()).alias("n_dropped"))


def train(df: DataFrame) -> DataFrame:
    return df.where(F.col("train_test") == "train")


def prediction(df: DataFrame) -> DataFrame:
    return df.where(F.col("train_test") == "prediction")


def labelled(df: DataFrame) -> DataFrame:
    """Add label: 1 where the status is not normal."""
    return df.withColumn("label", abnormal().cast("int"))


def numeric_columns(df: DataFrame, without: Iterable[str] = (*META, "label", "expected_power", "wind_bin")) -> list[str]:
    skip = set(without)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def column_base(column: Column, base: Column) -> Column:
    """Whether a column is a base sensor or one of its statistics."""
    return (column == base) | F.startswith(column, F.concat(base, F.lit("_")))


def primary_statistic(columns: DataFrame, key: str = "base", name: str = "column", ordinal: str = "ordinal") -> DataFrame:
    """Per base the column to use: an average first, then the first in order."""
    averaged = F.lower(name).rlike("avg|average|mean")
    return columns.groupBy(key).agg(F.min_by(name, F.struct((~averaged).cast("int"), F.col(ordinal))).alias(name))


def preferred_sensors(descriptions: DataFrame) -> DataFrame:
    """(role, sensor_name): the likeliest measured power and wind speed; theoretical and estimated ones come last."""
    d = F.lower(F.coalesce("description", F.lit("")))
    n = F.lower("sensor_name")
    penalty = sum((d.contains(w).cast("int") for w in THEORETICAL), F.lit(0))
    power = (n.contains("power") & ~n.contains("reactive")) | (d.contains("power") & ~d.contains("reactive"))
    p = descriptions.where(power).agg(F.min_by("sensor_name", F.struct(penalty, F.col("ordinal"))).alias("sensor_name")).select(F.lit("power").alias("role"), "sensor_name")
    w = descriptions.where(n.contains("wind_speed")).agg(F.min_by("sensor_name", F.struct(d.contains("estimated").cast("int"), F.col("ordinal"))).alias("sensor_name")).select(F.lit("wind_speed").alias("role"), "sensor_name")
    return p.union(w).where("sensor_name is not null")


def flagged_columns(columns: DataFrame, descriptions: DataFrame, flag: str = "is_angle") -> DataFrame:
    """(column, base): columns of sensors whose flag is true. Spark broadcasts the descriptions while they are small."""
    base = descriptions.where(truth(flag)).select(F.trim("sensor_name").alias("_sensor")).distinct()
    return columns.join(base, column_base(F.col("column"), F.col("_sensor"))).select("column", F.col("_sensor").alias("base"))


def classified(df: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """(column, ordinal, role) of the numeric columns: power, wind_speed, angle, counter or sensor.

    Power and wind speed are the statistics of the likeliest described sensors; without such, the columns whose names say
    so (reactive power aside). Only the schema and the descriptions are read, both of the size of a schema.
    """
    spark = df.sparkSession
    names = numeric_columns(df)
    columns = spark.createDataFrame(list(enumerate(names)), "ordinal int, column string")
    low = F.lower("column")
    hint = lambda hints: F.lit(False) if not hints else F.array_contains(F.transform(F.array(*map(F.lit, hints)), lambda h: low.contains(h)), True)
    by_name = {"power": hint(POWER_HINTS) & ~low.contains("reactive"), "wind_speed": hint(WIND_HINTS)}
    told = {}
    if descriptions is not None:
        roles = preferred_sensors(descriptions)
        for role in ("power", "wind_speed"):
            hit = columns.join(roles.where(F.col("role") == role), column_base(F.col("column"), F.col("sensor_name"))).select("column")
            told[role] = [r["column"] for r in hit.collect()]
        for flag in ("is_angle", "is_counter"):
            told[flag] = [r["column"] for r in flagged_columns(columns, descriptions, flag).collect()] if flag in descriptions.columns else []
    pick = lambda role: F.col("column").isin(told[role]) if told.get(role) else by_name.get(role, F.lit(False))
    role = F.when(pick("power"), "power").when(pick("wind_speed"), "wind_speed").when(pick("is_angle"), "angle").when(pick("is_counter"), "counter").otherwise("sensor")
    return columns.select("column", "ordinal", role.alias("role"))


def aligned(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Metadata and exactly these features, missing ones and NULLs as 0."""
    have = set(df.columns)
    return df.select(*[c for c in META if c in have], *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) if n in have else F.lit(0.0).alias(n) for n in names])


def narrowed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """These columns as 4-byte floats, at the border to storage."""
    todo = set(columns)
    return df.select(*[F.col(c).cast("float").alias(c) if c in todo else F.col(c) for c in df.columns])


def without_meta(df: DataFrame, keep: Iterable[str] = ("time_stamp",)) -> DataFrame:
    return df.drop(*[c for c in META if c not in set(keep)])
