"""Readings and event records as views of a plain event table (event_id, ts, user_id, event_type, value, props)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SENSORS = ["sensor_0", "sensor_1", "sensor_2", "sensor_3", "sensor_4"]


def as_readings(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    u, e = F.col("user_id"), F.col("event_type")
    return events.select(
        F.when(u % 2 == 0, "A").otherwise("B").alias("farm_id"), u.alias("dataset_id"), (u % 10).cast("string").alias("asset_id"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("time_stamp"),
        F.when(F.col("ts").cast("timestamp") < F.lit("2024-01-22").cast("timestamp"), "train").otherwise("prediction").alias("train_test"),
        F.when(e.isin("view", "purchase"), 0).when(e == "click", 2).when(e == "signup", 3).otherwise(4).alias("status_type_id"),
        F.col("value").alias("power"), (k / 4).alias("wind_speed"), ((k * 3.6) % 360).alias("sensor_0"), F.when(F.col("value") < 60, 0.0).otherwise(F.col("value")).alias("sensor_1"),
        F.when(F.col("event_id") % 7 != 0, F.col("value") * 2).alias("sensor_2"), F.lit(1.0).alias("sensor_3"), (F.col("value") * 3 + 1).alias("sensor_4"),
    )


def event_records(readings: DataFrame) -> DataFrame:
    """(farm_id, dataset_id, event_id, event_label, is_anomaly, event_start_id, event_end_id, event_start, event_end, onset)."""
    bad = (F.col("train_test") == "prediction") & (F.col("status_type_id") == 4)
    order = F.when(bad, F.struct("time_stamp", "id"))
    a = readings.groupBy("farm_id", "dataset_id").agg(F.min(order).alias("s"), F.max(order).alias("e"))
    odd = F.floor(F.col("dataset_id") / 2) % 2 == 1
    stamp = lambda c: F.date_format(F.col(c)["time_stamp"], "dd-MM-yyyy HH:mm")
    return a.select("farm_id", "dataset_id", F.col("dataset_id").cast("string").alias("event_id"), F.when(odd, "anomaly").otherwise("normal").alias("event_label"), odd.alias("is_anomaly"), F.col("s.id").alias("event_start_id"), F.col("e.id").alias("event_end_id"), stamp("s").alias("event_start"), stamp("e").alias("event_end"), F.col("e.time_stamp").alias("onset"))


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(spark.read.parquet(f"{sf_dir}/events.parquet"))
