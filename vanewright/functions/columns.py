"""Column expressions with the semantics that the whole library shares.

Missing values are NULL, never NaN; statistics skip them. Readings are ordered by (time_stamp, id) inside an episode, that
is (farm_id, dataset_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPISODE = ("farm_id", "dataset_id")
META = ("farm_id", "dataset_id", "asset_id", "id", "time_stamp", "train_test", "status_type_id")
#: The status codes of normal operation, and all codes with their names.
NORMAL = (0, 2)
STATUS = {0: "normal", 1: "derated", 2: "idling", 3: "service", 4: "downtime", 5: "other"}
EPS = 1e-4


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def episode(*keys: str) -> WindowSpec:
    """The ordering of readings; rolling statistics never cross an episode."""
    return Window.partitionBy(*(keys or EPISODE)).orderBy("time_stamp", "id")


def number(c: Column | str) -> Column:
    """Text or any number as double; unreadable, NaN and infinite values are NULL."""
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def whole(c: Column | str) -> Column:
    """An integer that may arrive as text or as 68.0."""
    return _c(c).try_cast("double").try_cast("int")


def no_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    kinds = (T.DoubleType, T.FloatType)
    return df.select(*[F.when(~F.isnan(f.name), F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`") for f in df.schema])


def text(c: Column | str) -> Column:
    """Trimmed text; empty is NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def truth(c: Column | str) -> Column:
    """TRUE, 1 and YES in any case are true, all else and NULL false."""
    return F.coalesce(F.upper(F.trim(_c(c).cast("string"))).isin("TRUE", "1", "YES"), F.lit(False))


def event_time(c: Column | str) -> Column:
    """YYYY-MM-DD with or without a time, or DD-MM-YYYY HH:MM. Days and months are never guessed."""
    s = F.trim(_c(c).cast("string"))
    return F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(s)).when(s.rlike(r"^\d{1,2}-\d{1,2}-\d{4}"), F.coalesce(F.try_to_timestamp(s, F.lit("d-M-yyyy H:mm:ss")), F.try_to_timestamp(s, F.lit("d-M-yyyy H:mm")), F.try_to_timestamp(s, F.lit("d-M-yyyy"))))


def abnormal(c: Column | str = "status_type_id") -> Column:
    """True unless the status is a normal one; NULL counts as abnormal."""
    return ~F.coalesce(_c(c).isin(*NORMAL), F.lit(False))


def training_normal() -> Column:
    return F.coalesce(F.col("train_test") == "train", F.lit(False)) & ~abnormal()


def status_name(c: Column | str = "status_type_id") -> Column:
    pairs = [x for k, v in STATUS.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), _c(c))


def residual(actual: Column | str, expected: Column | str) -> Column:
    return _c(actual) - _c(expected)


def residual_percent(actual: Column | str, expected: Column | str) -> Column:
    """NULL where nothing was expected."""
    return F.try_divide(_c(actual) - _c(expected), _c(expected)) * 100


def hours(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / 3.6e9


def minutes(later: Column | str, earlier: Column | str) -> Column:
    return hours(later, earlier) * 60


def wind_bin(wind: Column | str, width: float = 0.5) -> Column:
    """Right-closed bins from 0: (0, w] is bin 0; 0 and less are in none. Exact for widths that are powers of two."""
    return F.when(_c(wind) > 0, (F.ceil(_c(wind) / width) - 1).cast("int"))


def clock(ts: Column | str = "time_stamp") -> dict[str, Column]:
    """Hour of day and day of week (Monday is 0) on circles."""
    hour = F.hour(_c(ts)) + F.minute(_c(ts)) / 60.0
    day = F.weekday(_c(ts)).cast("double")
    turn = 2 * 3.141592653589793
    return {"hour_sin": F.sin(turn * hour / 24.0), "hour_cos": F.cos(turn * hour / 24.0), "dow_sin": F.sin(turn * day / 7.0), "dow_cos": F.cos(turn * day / 7.0)}


def fresh(latest: Column | str, now: Column, most: float = 60.0) -> tuple[Column, Column]:
    """(is fresh, age in minutes) at ``now``."""
    age = minutes(now, latest)
    return age <= most, age


def joined_warning(*parts: Column) -> Column:
    """Parts with bars between; NULL parts are left out, and NULL when none is left."""
    return F.nullif(F.concat_ws(" | ", *parts), F.lit(""))


def fbeta(tp: Column, fp: Column, fn: Column, beta: float = 0.5) -> Column:
    """0 when there is nothing to measure."""
    b = beta * beta
    den = (1 + b) * tp + b * fn + fp
    return F.when(den > 0, (1 + b) * tp / den).otherwise(0.0)


def fingerprint(names: Column) -> Column:
    """SHA-256 of an array of names, sorted and joined by commas."""
    return F.sha2(F.array_join(F.sort_array(names), ",").cast("binary"), 256)
