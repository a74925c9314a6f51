"""The validation suite: one row (farm_id, dataset_id, name, passed, severity, message) a check and episode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.functions.columns import EPISODE, STATUS
from vanewright.operators.conform import REQUIRED, canonical
from vanewright.operators.selection import column_difference
from vanewright.operators.windows import gaps

SPLITS = ("train", "prediction")


def _row(df: DataFrame, name: str, passed: Column, severity: str, message: Column) -> DataFrame:
    return df.select(*EPISODE, F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), F.lit(severity).alias("severity"), message.alias("message"))


def _list(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda v: v.cast("string")), ",")


def columns_present(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = sorted(set(required) - set(canonical(df).columns))
    return _row(df.select(*EPISODE).distinct(), "required_columns", F.lit(not missing), "ERROR", F.lit(",".join(missing)))


def column_count(df: DataFrame, expected: int) -> DataFrame:
    return _row(df.select(*EPISODE).distinct(), "column_count", F.lit(len(df.columns) == expected), "WARNING", F.lit(f"{len(df.columns)} of {expected}"))


def schema_drift(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Columns that came or went since a reference table; a row an episode, as both tables have one schema each."""
    new, gone = column_difference(df, reference)
    return _row(df.select(*EPISODE).distinct(), "schema_drift", F.lit(not new and not gone), "WARNING", F.lit(",".join([f"+{c}" for c in new] + [f"-{c}" for c in gone])))


def times_parse(df: DataFrame, most: float = 0.01) -> DataFrame:
    """A share of unreadable times under ``most`` warns, beyond it is an error."""
    a = df.groupBy(*EPISODE).agg(F.count("*").alias("n"), F.count_if(F.try_to_timestamp(F.col("time_stamp").cast("string")).isNull()).alias("bad"))
    out = _row(a, "timestamps", F.col("bad") == 0, "ERROR", F.concat_ws(" of ", F.col("bad").cast("string"), F.col("n").cast("string")))
    return out.join(a.select(*EPISODE, (F.col("bad") < most * F.col("n")).alias("_few")), list(EPISODE)).withColumn("severity", F.when(F.col("_few"), "WARNING").otherwise("ERROR")).drop("_few")


def time_gaps(df: DataFrame, most_minutes: float = 30.0) -> DataFrame:
    return _row(gaps(df, most_minutes), "time_gaps", F.col("n_gaps") == 0, "WARNING", F.col("n_gaps").cast("string"))


def _allowed(df: DataFrame, column: str, values: list, name: str) -> DataFrame:
    a = df.groupBy(*EPISODE).agg(F.sort_array(F.array_except(F.collect_set(column), F.array(*map(F.lit, values)))).alias("odd"))
    return _row(a, name, F.size("odd") == 0, "ERROR", _list(F.col("odd")))


def statuses(df: DataFrame) -> DataFrame:
    return _allowed(df, "status_type_id", sorted(STATUS), "status_values")


def splits(df: DataFrame) -> DataFrame:
    return _allowed(df, "train_test", list(SPLITS), "split_values")


def missingness(df: DataFrame, sensors: list[str], most: float = 0.5) -> DataFrame:
    cells = F.array(*[F.struct(F.avg(F.isnull(c).cast("double")).alias("f"), F.lit(c).alias("c")) for c in sensors])
    a = df.groupBy(*EPISODE).agg(cells.alias("m")).withColumn("odd", F.transform(F.filter("m", lambda x: x["f"] > most), lambda x: x["c"]))
    return _row(a, "missingness", F.size("odd") == 0, "WARNING", F.array_join(F.array_sort("odd"), ","))


def duplicate_rows(df: DataFrame) -> DataFrame:
    a = df.groupBy(*EPISODE, "time_stamp", "asset_id").agg(F.count("*").alias("n")).groupBy(*EPISODE).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n"))
    return _row(a, "duplicates", F.col("n") == 0, "WARNING", F.col("n").cast("string"))


def not_negative(df: DataFrame, columns: tuple[str, ...] = ("power", "wind_speed")) -> DataFrame:
    bad = sum((F.count_if(F.coalesce(F.col(c) < 0, F.lit(False))) for c in columns if c in df.columns), F.lit(0))
    return _row(df.groupBy(*EPISODE).agg(bad.alias("n")), "ranges", F.col("n") == 0, "WARNING", F.col("n").cast("string"))


def events_covered(df: DataFrame, events: DataFrame) -> DataFrame:
    """events: farm_id, dataset_id. An episode without a record fails."""
    known = events.select(*EPISODE).distinct().withColumn("known", F.lit(True))
    a = df.select(*EPISODE).distinct().join(known, list(EPISODE), "left")
    return _row(a, "event_record", F.coalesce("known", F.lit(False)), "WARNING", F.lit(""))


def report(df: DataFrame, sensors: list[str], events: DataFrame | None = None, expected_columns: int | None = None) -> DataFrame:
    """All checks of all episodes."""
    parts = [columns_present(df), times_parse(df), time_gaps(df), statuses(df), missingness(df, sensors), duplicate_rows(df), splits(df), not_negative(df)]
    parts += [column_count(df, expected_columns)] if expected_columns else []
    parts += [events_covered(df, events)] if events is not None else []
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verdict(checks: DataFrame) -> DataFrame:
    """(episode, passed, n_errors, n_warnings): passed when no check of severity ERROR failed."""
    failed = ~F.col("passed")
    return checks.groupBy(*EPISODE).agg((F.count_if(failed & (F.col("severity") == "ERROR")) == 0).alias("passed"), F.count_if(failed & (F.col("severity") == "ERROR")).alias("n_errors"), F.count_if(failed & (F.col("severity") == "WARNING")).alias("n_warnings"))
