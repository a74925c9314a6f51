"""Joins of readings with events, references, baselines and manifests.

Reference tables (baselines, curves, events) have a row per asset and sensor or bin. They are not hinted: Spark broadcasts
them while they are under its size threshold and shuffles both sides, splitting skewed ones, beyond it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewright.functions.columns import EPISODE, event_time, residual, residual_percent, training_normal, whole, wind_bin


#: Ranges that share a moment beyond which an asset's are dealt into parts.
DENSE = 500


def with_events(datasets: DataFrame, events: DataFrame) -> DataFrame:
    """Each dataset's event record: by numeric id, else by equal trimmed text, else the farm's only record.

    datasets: farm_id, dataset_id (any type). events: farm_id, event_id (text or number), ... Several matches: the
    smallest record by id text.
    """
    d = datasets.withColumn("_num", whole("dataset_id")).withColumn("_text", F.trim(F.col("dataset_id").cast("string")))
    e = events.withColumn("_enum", whole("event_id")).withColumn("_etext", F.trim(F.col("event_id").cast("string")))
    fields = F.struct(*[F.col(c) for c in events.columns if c != "farm_id"]).alias("_e")
    by_num = e.where("_enum is not null").groupBy("farm_id", F.col("_enum").alias("_num")).agg(F.min_by(fields, "_etext").alias("_by_num"))
    by_text = e.groupBy("farm_id", F.col("_etext").alias("_text")).agg(F.min_by(fields, "_etext").alias("_by_text"))
    alone = e.groupBy("farm_id").agg(F.count("*").alias("_n"), F.min_by(fields, "_etext").alias("_alone")).where("_n = 1").drop("_n")
    out = d.join(by_num, ["farm_id", "_num"], "left").join(by_text, ["farm_id", "_text"], "left").join(alone, "farm_id", "left")
    out = out.withColumn("_e", F.coalesce("_by_num", "_by_text", "_alone"))
    return out.select(*datasets.columns, *[F.col("_e")[c].alias(c) for c in events.columns if c != "farm_id"])


def resolved_times(events: DataFrame, df: DataFrame, name: str = "event_start") -> DataFrame:
    """Add {name}_ts and {name}_mismatch: the time of the reading whose id the record names, if exactly one has it, else
    the record's text; mismatch where both exist and differ by more than a minute."""
    one = df.groupBy(*EPISODE, "id").agg(F.count("*").alias("_n"), F.min("time_stamp").cast("timestamp").alias("_ts")).where("_n = 1").drop("_n")
    told = event_time(name)
    out = events.join(one.withColumnRenamed("id", f"{name}_id"), [*EPISODE, f"{name}_id"], "left")
    return out.withColumn(f"{name}_ts", F.coalesce("_ts", told)).withColumn(f"{name}_mismatch", F.coalesce(F.abs(F.unix_micros("_ts") - F.unix_micros(told)) > 60_000_000, F.lit(False))).drop("_ts")


def normalised(t: DataFrame, baseline: DataFrame) -> DataFrame:
    """Tall readings as z-scores of their asset's baseline; unknown assets and sensors stay as they are."""
    out = t.join(baseline.select("farm_id", "asset_id", "sensor", "mean", "std"), ["farm_id", "asset_id", "sensor"], "left")
    return out.withColumn("value", F.coalesce((F.col("value") - F.col("mean")) / F.col("std"), F.col("value"))).drop("mean", "std")


def normalised_wide(df: DataFrame, baseline: DataFrame, sensors: list[str]) -> DataFrame:
    """The same for wide readings: the asset's baselines come as one map."""
    maps = baseline.where(F.col("sensor").isin(sensors)).groupBy("farm_id", "asset_id").agg(F.map_from_entries(F.collect_list(F.struct("sensor", F.struct("mean", "std")))).alias("_b"))
    out = df.join(maps, ["farm_id", "asset_id"], "left")
    z = lambda c: F.coalesce((F.col(c) - F.try_element_at("_b", F.lit(c))["mean"]) / F.try_element_at("_b", F.lit(c))["std"], F.col(c))
    return out.select(*[z(c).alias(c) if c in sensors else out[c] for c in df.columns])


def against_curve(df: DataFrame, curve: DataFrame, power: str = "power", wind: str = "wind_speed", keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """Add expected_power, power_residual and power_residual_pct from the curve's bin; NULL outside of it."""
    binned = df.withColumn("wind_bin", wind_bin(wind))
    out = binned.join(curve.select(*keys, "wind_bin", "expected_power"), [*keys, "wind_bin"], "left")
    return out.withColumn("power_residual", residual(power, "expected_power")).withColumn("power_residual_pct", residual_percent(power, "expected_power")).drop("wind_bin")


def against_own_curve(df: DataFrame, power: str = "power", wind: str = "wind_speed", keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """What ``against_curve`` adds with the ``power_curve`` of the same table and keys, by a window: a table that is dealt by
    the keys is not shuffled again, and the curve is no table of its own."""
    normal = F.when(training_normal(), F.col(power))
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in (*keys, "wind_bin")])
    out = df.withColumn("wind_bin", wind_bin(wind)).withColumn("expected_power", F.when(known, F.median(normal).over(Window.partitionBy(*keys, "wind_bin"))))
    return out.withColumn("power_residual", residual(power, "expected_power")).withColumn("power_residual_pct", residual_percent(power, "expected_power")).drop("wind_bin")


def training_ranges(df: DataFrame) -> DataFrame:
    return df.where(F.col("train_test") == "train").groupBy(*EPISODE, "asset_id").agg(F.min("time_stamp").alias("start"), F.max("time_stamp").alias("end"))


def neighbour_overlaps(ranges: DataFrame) -> DataFrame:
    """Per asset, ranges that reach into the next one by start: (…, next_dataset, overlap_start, overlap_end)."""
    w = Window.partitionBy("farm_id", "asset_id").orderBy("start", "dataset_id")
    nxt = ranges.select("*", F.lead("dataset_id").over(w).alias("next_dataset"), F.lead("start").over(w).alias("_s"), F.lead("end").over(w).alias("_e"))
    return nxt.where(F.col("end") > F.col("_s")).select("farm_id", "asset_id", "dataset_id", "next_dataset", F.greatest("start", "_s").alias("overlap_start"), F.least("end", "_e").alias("overlap_end"))


def _dealt_ranges(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(longer, shorter) sides of ``all_overlaps``, to be joined by asset, class, bucket and part."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    level = 2 * F.ceil(F.log2(F.greatest(F.col("_e") - F.col("_s"), F.lit(1)).cast("double")) / 2).cast("int")
    kinds = dict(ranges.dtypes)
    ends = [] if kinds["start"] == kinds["end"] == "timestamp" else ["start", "end"]  # timestamps come back from microseconds
    r = ranges.select("farm_id", "asset_id", "dataset_id", *ends, us("start").alias("_s"), us("end").alias("_e")).where("_s is not null and _e is not null and _s <= _e").withColumn("_level", level)
    placed = lambda d: d.withColumn("_bucket", F.explode(F.expr("sequence(shiftright(_s, _level), shiftright(_e, _level))")))
    crowd = F.sum((F.col("_e") - F.col("_s")).cast("double")) / F.greatest(F.max("_e") - F.min("_s"), F.lit(1))
    classes = r.groupBy("farm_id", "asset_id").agg(F.collect_set("_level").alias("_levels"), F.ceil(F.sqrt(F.greatest(crowd / DENSE, F.lit(1.0)))).cast("int").alias("_parts"))
    known = r.join(classes, ["farm_id", "asset_id"]).withColumn("_own_part", F.pmod(F.xxhash64("dataset_id", "_s", "_e"), F.col("_parts")).cast("int"))
    dealt = lambda d, parts: d.withColumn("_part", F.explode(F.expr(parts))).drop("_parts", "_own_part")
    long = dealt(placed(known.drop("_levels")), "sequence(_own_part * _parts, _own_part * _parts + _parts - 1)")
    short = known.withColumn("_own", F.col("_level")).withColumn("_level", F.explode(F.filter("_levels", lambda k: k >= F.col("_own")))).drop("_levels")
    short = dealt(placed(short), "sequence(_own_part, _own_part + (_parts - 1) * _parts, _parts)")
    return long, short.select("farm_id", "asset_id", "_level", "_bucket", "_part", "_own", *[F.col(c).alias(f"_o{c}") for c in ("dataset_id", *ends, "_s", "_e")])


def all_overlaps(ranges: DataFrame) -> DataFrame:
    """Per asset, every pair of ranges that share time.

    A sweep in buckets: a range whose length is up to 4^k microseconds, but more than a quarter of it, lies in one or two
    buckets of that width. It meets the ranges of its class and of the shorter classes there, and a pair counts in the bucket
    of its later start. So ranges of all lengths together cost some times as many comparisons as there are pairs, and no
    asset is one task. Rows are at most twice the ranges for each class of length that the asset has. Where n ranges of an asset,
    more than DENSE, share each moment, both sides are dealt into sqrt(n / DENSE) parts and each part meets each of the other
    side's, so that few crowded buckets are n / DENSE tasks' work; a range is copied sqrt(n / DENSE) times on each side, though
    it has n pairs.
    """
    long, other = _dealt_ranges(ranges)
    ends = "start" in long.columns
    both = long.join(other, ["farm_id", "asset_id", "_level", "_bucket", "_part"]).where((F.col("_s") < F.col("_o_e")) & (F.col("_o_s") < F.col("_e")) & (F.col("_bucket") == F.expr("shiftright(greatest(_s, _o_s), _level)")))
    # Two ranges of one class meet twice, two of different classes once.
    both = both.where(F.when(F.col("_own") == F.col("_level"), F.col("dataset_id") < F.col("_odataset_id")).otherwise(F.col("dataset_id") != F.col("_odataset_id")))
    first, last = F.least("dataset_id", "_odataset_id"), F.greatest("dataset_id", "_odataset_id")
    shared = (F.greatest("start", "_ostart"), F.least("end", "_oend")) if ends else (F.timestamp_micros(F.greatest("_s", "_o_s")), F.timestamp_micros(F.least("_e", "_o_e")))
    return both.select("farm_id", "asset_id", first.alias("dataset_id"), last.alias("other"), shared[0].alias("overlap_start"), shared[1].alias("overlap_end"))


def unprocessed(datasets: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    return datasets if force else datasets.join(manifest.select(*EPISODE), list(EPISODE), "left_anti")

