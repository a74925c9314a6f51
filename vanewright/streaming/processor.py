"""One stateful processor from readings to alarms: rolling features, scores of a stored model, sustained flags, silence.

State of a key, in RocksDB: one value, its progress with its last readings, as many as the longest window or lag asks for, so
that a key costs one read and one write a micro-batch. A micro-batch of a key is one set of arrays; the features are those of
``windows.ordered_arrays``, so a stream and a batch agree. Event-time timers tell that a key has been silent and, later, forget it, so state is bounded by the keys
that reported of late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vanewright.operators import windows
from vanewright.plans.detectors import Fitted, local

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ("farm_id", "asset_id")
DAY = 86_400_000

#: (model of a key, features by name) -> scores, NaN where there is none; and the limit of each model.
Scorer = Callable[[tuple, dict[str, np.ndarray]], np.ndarray]


def clock_arrays(us: np.ndarray) -> dict[str, np.ndarray]:
    """The features of ``columns.clock`` for microseconds since the epoch."""
    minute, day = us // 60_000_000, us // (DAY * 1000)
    hour, week = (minute % 1440) / 60.0 * 2 * np.pi / 24.0, ((day + 3) % 7) * 2 * np.pi / 7.0  # the epoch was a Thursday
    return {"hour_sin": np.sin(hour), "hour_cos": np.cos(hour), "dow_sin": np.sin(week), "dow_cos": np.cos(week)}


def by_model(fitted: Fitted, limits: DataFrame, keys: tuple[str, ...] = KEYS) -> tuple[Scorer, Callable[[tuple], float]]:
    """(scorer, limit of a key) of a fitted, possibly loaded, detector whose keys are among the stream's. Keys of models that
    were not fitted have no score. limits: (model, threshold)."""
    models, most = local(fitted), {r["model"]: r["threshold"] for r in limits.collect()}
    places = [keys.index(k) for k in fitted.keys]
    name = lambda key: "/".join("?" if key[p] is None else str(key[p]) for p in places) if places else "all"

    def score(key: tuple, features: dict[str, np.ndarray]) -> np.ndarray:
        model, n = models.get(name(key)), len(next(iter(features.values())))
        if model is None:
            return np.full(n, np.nan)
        return model.score(np.stack([features.get(f, np.full(n, np.nan)) for f in model.features], axis=1))

    return score, lambda key: most.get(name(key), float("inf"))


class Detection(StatefulProcessor):
    def __init__(self, sensors: list[str], keys: tuple[str, ...], score: Scorer, limit: Callable[[tuple], float], angles: tuple, sizes: tuple, steps: tuple, least_run: int, quiet_ms: int, forget_ms: int):
        self.sensors, self.keys, self.score, self.limit, self.angles, self.sizes, self.steps = sensors, keys, score, limit, angles, sizes, steps
        self.least_run, self.quiet_ms, self.forget_ms = least_run, quiet_ms, forget_ms
        self.held = max([0, *(n - 1 for n in sizes), *steps])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", "us long, id long, streak int, recent array<array<double>>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        us, ids, x = (np.concatenate([f(p) for p in parts]) for f in (lambda p: p["time_stamp"].to_numpy("datetime64[us]").astype(np.int64), lambda p: p["id"].to_numpy(np.int64), lambda p: p[self.sensors].to_numpy(np.float64)))
        order = np.lexsort((ids, us))
        us, ids, x = us[order], ids[order], x[order]
        last = self.progress.get()
        late = (us < last[0]) | ((us == last[0]) & (ids <= last[1])) if last else np.zeros(len(us), bool)
        if late.any():
            yield self._told(key, ids[late], us[late], "late")
        if late.all():
            return
        us, ids, x = us[~late], ids[~late], x[~late]
        before = last[3] if last else []
        old = np.array([[np.nan if v is None else v for v in r] for r in before], np.float64).reshape(len(before), len(self.sensors))
        both = np.concatenate([old, x])
        columns = {c: both[:, k] for k, c in enumerate(self.sensors)}
        made = columns | windows.ordered_arrays(columns, self.sensors, self.angles, self.sizes, self.steps)
        own = {c: v[len(old) :] for c, v in made.items()} | clock_arrays(us)
        score = self.score(key, own)
        flag = np.nan_to_num(score, nan=-np.inf) >= self.limit(key)
        # The run that each row ends: rows since the last one without a flag, and what ran before.
        at = np.arange(1, len(flag) + 1)
        reset = np.maximum.accumulate(np.where(flag, 0, at))
        streak = np.where(flag, at - reset + np.where(reset == 0, last[2] if last else 0, 0), 0)
        yield self._told(key, ids, us, "reading", score, flag, streak == self.least_run)
        kept = both[len(both) - min(self.held, len(both)) :].tolist()
        self.progress.update((int(us[-1]), int(ids[-1]), int(min(streak[-1], 1 << 30)), kept))
        new, gone = ({int(t) // 1000 + wait for wait in (self.quiet_ms, self.forget_ms)} for t in (us[-1], last[0] if last else us[-1]))
        for t in sorted(gone - new) if last else ():  # a timer that has run is none any more
            self.handle.deleteTimer(t)
        for t in sorted(new):
            self.handle.registerTimer(t)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.progress.get()
        if last is None:
            return
        if expiredTimerInfo.getExpiryTimeInMs() >= last[0] // 1000 + self.forget_ms:
            self.progress.clear()
        else:
            yield self._told(key, np.array([last[1]]), np.array([last[0]]), "stale")

    def close(self) -> None:
        pass

    def _told(self, key: tuple, ids, us, kind: str, score=None, flag=None, alarm=None) -> pd.DataFrame:
        n = len(ids)
        out = {k: [v] * n for k, v in zip(self.keys, key, strict=True)} | {"id": ids, "time_stamp": us.astype("datetime64[us]"), "kind": [kind] * n}
        if score is None:
            out |= {"score": np.full(n, np.nan), "flag": pd.array([None] * n, "Int32"), "alarm": np.zeros(n, bool)}
        else:  # NaN is sent as NULL
            out |= {"score": np.asarray(score, np.float64), "flag": pd.array(flag.astype(np.int32), "Int32"), "alarm": alarm}
        return pd.DataFrame(out)


def detected(df: DataFrame, sensors: list[str], score: Scorer, limit: Callable[[tuple], float], keys: tuple[str, ...] = KEYS, angles: Iterable[str] = (), sizes: Iterable[int] = windows.WINDOWS, steps: Iterable[int] = windows.LAGS, least_run: int = 6, delay: str = "1 hour", quiet_ms: int = 3_600_000, forget_ms: int = 30 * DAY) -> DataFrame:
    """(keys, id, time_stamp, kind, score, flag, alarm) of a stream of readings.

    kind: ``reading``; ``late`` for a reading not newer than the key's last one, which is told without a score; ``stale``
    for the last reading of a key that the watermark has left ``quiet_ms`` behind. What a key holds is dropped after
    ``forget_ms``. Readings older than the watermark, ``delay`` behind the newest, are left to Spark, which counts them.
    alarm: once a run, at its ``least_run``-th flag. References (baselines, curves) may be joined to the stream before.
    """
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = df.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col("id").cast("long").alias("id"), F.col("time_stamp").cast("timestamp").alias("time_stamp"), *[F.col(c).cast("double").alias(c) for c in sensors])
    work = Detection(list(sensors), tuple(keys), score, limit, tuple(angles), tuple(sizes), tuple(steps), least_run, quiet_ms, forget_ms)
    schema = T._parse_datatype_string(", ".join(f"{k} string" for k in keys) + ", id long, time_stamp timestamp, kind string, score double, flag int, alarm boolean")
    return rows.withWatermark("time_stamp", delay).groupBy(*keys).transformWithStateInPandas(work, outputStructType=schema, outputMode="append", timeMode="eventtime")
