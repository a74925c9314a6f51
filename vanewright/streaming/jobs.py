"""Streaming counterparts of ingest, cleaning, features, alarms and monitoring. Every function maps DataFrames, so the same
code runs on a bounded source with the availableNow trigger."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vanewright.operators import conform, drift
from vanewright.plans.detectors import Fitted


def source(spark: SparkSession, folder: str, schema, kind: str = "parquet", **options) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).format(kind).load(folder)


def sink(df: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = (), mode: str = "append") -> StreamingQuery:
    """Everything at hand to Parquet, exactly once; the checkpoint belongs in the cluster's shared storage."""
    w = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    return (w.partitionBy(*partitions) if partitions else w).format("parquet").start(path)


def continuous_ingest(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """New raw files to bronze as they come."""
    return sink(conform.readings(raw), path, checkpoint, ("farm_id",))


def deduplicated(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One reading for each (asset, time) among those at most ``delay`` late."""
    return df.withWatermark("time_stamp", delay).dropDuplicatesWithinWatermark(["farm_id", "asset_id", "time_stamp"])


def monitoring(scored: DataFrame, width: str = "1 day", slide: str | None = "1 hour", delay: str = "1 hour", keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """(window, keys, n, anomaly_rate, mean_score) over tumbling (no slide) or sliding windows."""
    w = F.window("time_stamp", width, slide) if slide else F.window("time_stamp", width)
    return scored.withWatermark("time_stamp", delay).groupBy(w.alias("window"), *keys).agg(F.count("*").alias("n"), F.avg("flag").alias("anomaly_rate"), F.avg("score").alias("mean_score"))


def alarm_sessions(flags: DataFrame, gap: str = "30 minutes", delay: str = "1 hour", keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """(session, keys, n, peak_score): flagged readings that follow one another within ``gap``."""
    return flags.where("flag = 1").withWatermark("time_stamp", delay).groupBy(F.session_window("time_stamp", gap).alias("session"), *keys).agg(F.count("*").alias("n"), F.max("score").alias("peak_score"))


_STATE = "times array<long>, values array<double>, streak int"


def rolling_alarms(df: DataFrame, value: str, threshold: float, rows: int = 36, least_run: int = 6, keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """(keys, id, time_stamp, value, roll_mean, roll_std, alarm) for each reading: statistics over the key's last ``rows``
    readings, and an alarm once for each run of ``least_run`` readings at the threshold or above.

    State is ``rows`` values a key. Readings of a micro-batch are put in order; an older one than the last seen is late
    and left out.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, values, streak = state.get if state.exists else ([], [], 0)
        last = times[-1] if len(times) else None
        window = deque([None if v is None or v != v else v for v in values], maxlen=rows)
        stamps = deque(times, maxlen=rows)
        out = []
        pdf = pd.concat(list(frames)).sort_values(["time_stamp", "id"])
        for r in pdf.itertuples(index=False):
            at = int(pd.Timestamp(r.time_stamp).value // 1000)
            if last is not None and at < last:
                continue
            last = at
            v = None if r.value is None or r.value != r.value else float(r.value)
            window.append(v)
            stamps.append(at)
            known = [x for x in window if x is not None]
            enough = len(known) >= max(2, rows // 3)
            streak = streak + 1 if v is not None and v >= threshold else 0
            out.append((*key, int(r.id), r.time_stamp, v, float(np.mean(known)) if enough else None, float(np.std(known, ddof=1)) if enough else None, streak == least_run))
        state.update((list(stamps), [float("nan") if x is None else x for x in window], streak))
        yield pd.DataFrame(out, columns=[*keys, "id", "time_stamp", "value", "roll_mean", "roll_std", "alarm"])

    schema = ", ".join(f"{k} string" for k in keys) + ", id long, time_stamp timestamp, value double, roll_mean double, roll_std double, alarm boolean"
    rows_in = df.select(*[F.col(k).cast("string").alias(k) for k in keys], "id", F.col("time_stamp").cast("timestamp").alias("time_stamp"), F.col(value).cast("double").alias("value"))
    return rows_in.groupBy(*keys).applyInPandasWithState(step, schema, _STATE, "append", GroupStateTimeout.NoTimeout)


def scored(features: DataFrame, fitted: Fitted, limit: float, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of features (such as ``rolling_alarms`` gives) scored by a fitted, possibly loaded, detector and
    appended to the lake with ``score``, ``flag`` (at ``limit`` or above) and its number; a repeated batch replaces itself.

    ``rolling_alarms`` on the score of the written stream gives the sustained alarms.
    """

    def append(batch: DataFrame, number: int) -> None:
        out = fitted.score(batch).withColumn("flag", (F.col("score") >= limit).cast("int")).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return features.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(append).start()


def watchdog(df: DataFrame, quiet_ms: int = 3_600_000, keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """(keys, last_seen, stale): a row when an asset reports, and one with stale when it has been quiet for ``quiet_ms``."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            seen = pd.Timestamp(state.get[0] * 1000)
            state.remove()
            yield pd.DataFrame([(*key, seen, True)], columns=[*keys, "last_seen", "stale"])
            return
        seen = max(int(pd.Timestamp(t).value // 1000) for f in frames for t in f["time_stamp"])
        seen = max(seen, state.get[0]) if state.exists else seen
        state.update((seen,))
        state.setTimeoutDuration(quiet_ms)
        yield pd.DataFrame([(*key, pd.Timestamp(seen * 1000), False)], columns=[*keys, "last_seen", "stale"])

    schema = ", ".join(f"{k} string" for k in keys) + ", last_seen timestamp, stale boolean"
    return df.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col("time_stamp").cast("timestamp").alias("time_stamp")).groupBy(*keys).applyInPandasWithState(step, schema, "seen long", "append", GroupStateTimeout.ProcessingTimeTimeout)


def inference_log(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of scores appended to the lake with its number, for later drift scans; a repeated batch replaces
    itself."""

    def append(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return df.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(append).start()


def drift_log(df: DataFrame, ends: DataFrame, path: str, checkpoint: str, bins: int = drift.BINS, keys: tuple[str, ...] = drift.KEYS) -> StreamingQuery:
    """Each micro-batch of tall values (keys, time_stamp, value) counted by day and bin and added to the log of counts, once
    whatever restarts; see ``drift``. ``ends``: a table of the reference's bounds, read anew by each batch."""

    def add(batch: DataFrame, number: int) -> None:
        drift.log(drift.day_counts(batch, ends, bins, keys), path, number)

    return df.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(add).start()
