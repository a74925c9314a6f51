"""Ordered operators over episodes: one exchange and one sort for all columns of a call."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.functions.columns import EPISODE, episode
from vanewright.operators import vectors
from vanewright.operators.gramian import Make

WINDOWS = (6, 18, 36)
LAGS = (1, 6, 36)


def least_periods(rows: int) -> int:
    return max(2, rows // 3)


def _trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(-(rows - 1), 0)


def rolling_mean(c: str, rows: int, w: WindowSpec) -> Column:
    f = _trailing(w, rows)
    return F.when(F.count(c).over(f) >= least_periods(rows), F.avg(c).over(f))


def rolling_std(c: str, rows: int, w: WindowSpec) -> Column:
    f = _trailing(w, rows)
    return F.when(F.count(c).over(f) >= least_periods(rows), F.stddev_samp(c).over(f))


def rolling_circular(c: str, rows: int, w: WindowSpec) -> tuple[Column, Column]:
    """Circular mean in [0, 360) and circular standard deviation, both in degrees."""
    f = _trailing(w, rows)
    enough = F.count(c).over(f) >= least_periods(rows)
    s, k = F.avg(F.sin(F.radians(c))).over(f), F.avg(F.cos(F.radians(c))).over(f)
    r = F.greatest(F.least(F.sqrt(s * s + k * k), F.lit(1.0)), F.lit(1e-9))
    return F.when(enough, F.pmod(F.degrees(F.atan2(s, k)), F.lit(360.0))), F.when(enough, F.degrees(F.sqrt(F.abs(-2 * F.log(r)))))


def rolling(df: DataFrame, linear: Iterable[str], circular: Iterable[str] = (), windows: Iterable[int] = WINDOWS, keys: tuple[str, ...] = ()) -> DataFrame:
    """Add c_roll{n}_mean, _std, and for angles _circmean, _circstd. For up to about ten columns; see ``rolling_tall``."""
    w, out = episode(*keys), []
    for n in windows:
        for c in linear:
            out += [rolling_mean(c, n, w).alias(f"{c}_roll{n}_mean"), rolling_std(c, n, w).alias(f"{c}_roll{n}_std")]
        for c in circular:
            mean, std = rolling_circular(c, n, w)
            out += [mean.alias(f"{c}_roll{n}_circmean"), std.alias(f"{c}_roll{n}_circstd")]
    return df.select("*", *out)


def tall(df: DataFrame, sensors: list[str], ids: Iterable[str] = ("farm_id", "dataset_id", "asset_id", "id", "time_stamp")) -> DataFrame:
    """(ids, sensor, value): one row a sensor, so work spreads over sensors and expressions stay few."""
    return df.select(*ids, *[F.col(s).cast("double") for s in sensors]).unpivot(list(ids), sensors, "sensor", "value")


def rolling_tall(t: DataFrame, windows: Iterable[int] = WINDOWS) -> DataFrame:
    """Rolling mean and deviation for any number of sensors, on the tall form."""
    w = episode("farm_id", "dataset_id", "sensor")
    return t.select("*", *[x for n in windows for x in (rolling_mean("value", n, w).alias(f"roll{n}_mean"), rolling_std("value", n, w).alias(f"roll{n}_std"))])


def _by_episode(df: DataFrame, columns: list[str], added: list[str], work: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], replace: bool = False) -> DataFrame:
    """Compute columns from an episode's ordered ``columns`` in numpy, NULL as NaN: all columns in one shuffle and one task
    an episode, which holds a year or so of readings. For more columns than window expressions carry."""
    wanted = [*df.columns, *([] if replace else added)]
    kinds = {f.name: f.dataType for f in df.schema} | dict.fromkeys(added, T.DoubleType())
    schema = T.StructType([T.StructField(n, kinds[n]) for n in wanted])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("time_stamp", "ascending"), ("id", "ascending")])
        as_float = lambda c: np.asarray(table[c].cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
        made = work({c: as_float(c) for c in columns})
        column = lambda n: pa.array(made[n], pa.float64(), mask=np.isnan(made[n])) if n in made else table[n]
        return pa.table([column(n) for n in wanted], names=wanted)

    return df.groupBy(*EPISODE).applyInArrow(run, schema)


def _trailing_sum(x: np.ndarray, rows: int) -> np.ndarray:
    total = np.cumsum(x)
    total[rows:] = total[rows:] - total[:-rows]
    return total


def _rolling_arrays(name: str, x: np.ndarray, sizes: Iterable[int], angle: bool) -> dict[str, np.ndarray]:
    out, ok = {}, ~np.isnan(x)
    centre = float(x[ok].mean()) if ok.any() and not angle else 0.0
    parts = [np.where(ok, np.sin(np.radians(x)), 0.0), np.where(ok, np.cos(np.radians(x)), 0.0)] if angle else [np.where(ok, x - centre, 0.0)]
    parts += [] if angle else [parts[0] ** 2]
    for n in sizes:
        count = _trailing_sum(ok.astype(np.float64), n)
        few = count < least_periods(n)
        a, b = (_trailing_sum(v, n) / np.maximum(count, 1) for v in parts)
        if angle:
            r = np.clip(np.sqrt(a * a + b * b), 1e-9, 1.0)
            new = {"circmean": np.mod(np.degrees(np.arctan2(a, b)), 360.0), "circstd": np.degrees(np.sqrt(np.abs(-2 * np.log(r))))}
        else:
            new = {"mean": a + centre, "std": np.sqrt(np.maximum(b - a * a, 0.0) * count / np.maximum(count - 1, 1))}
        out |= {f"{name}_roll{n}_{k}": np.where(few, np.nan, v) for k, v in new.items()}
    return out


def ordered_arrays(columns: dict[str, np.ndarray], sensors: list[str], angles: Iterable[str] = (), sizes: Iterable[int] = WINDOWS, steps: Iterable[int] = LAGS, top: int = 10) -> dict[str, np.ndarray]:
    """Rolling statistics of one episode's ordered columns, differences and lags of the first ``top`` sensors, by name."""
    shifted = lambda x, n: np.concatenate([np.full(min(n, len(x)), np.nan), x[: max(0, len(x) - n)]])
    out: dict[str, np.ndarray] = {}
    for c in sensors:
        out |= _rolling_arrays(c, columns[c], sizes, c in set(angles))
    for c in sensors[:top]:
        out[f"{c}_diff"] = columns[c] - shifted(columns[c], 1)
        out |= {f"{c}_lag{n}": shifted(columns[c], n) for n in steps}
    return out


def ordered_wide(df: DataFrame, sensors: list[str], angles: Iterable[str] = (), sizes: Iterable[int] = WINDOWS, steps: Iterable[int] = LAGS, top: int = 10, mask: Iterable[str] = ()) -> DataFrame:
    """What ``rolling``, ``differences`` and ``lags`` (of the first ``top`` sensors) add, for any number of sensors.

    mask: sensors, doubles, whose runs of zeros are masked before, in the same pass over the episode."""
    angles, sizes, steps = set(angles), tuple(sizes), tuple(steps)
    kinds = lambda c: ("circmean", "circstd") if c in angles else ("mean", "std")
    added = [f"{c}_roll{n}_{k}" for n in sizes for c in sensors for k in kinds(c)]
    added += [f"{c}_diff" for c in sensors[:top]] + [f"{c}_lag{n}" for n in steps for c in sensors[:top]]

    masked = list(mask)

    def work(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        clean = {c: _zero_runs(columns[c], 6) for c in masked}
        return clean | ordered_arrays(columns | clean, sensors, angles, sizes, steps, top)

    return _by_episode(df, sensors, added, work)


def trailing_arrays(columns: dict[str, np.ndarray], at: np.ndarray, held: int, sensors: list[str], angles: Iterable[str] = (), sizes: Iterable[int] = WINDOWS, steps: Iterable[int] = LAGS, top: int = 10) -> dict[str, np.ndarray]:
    """What ``ordered_arrays`` gives, for rows of many episodes side by side. The first ``held`` rows of the columns are those
    before; at: the place of each other row in its episode. Windows are added up from their own values, so a fixed one has no
    deviation, and how long an episode is does not matter."""
    n, angles, sizes = len(at), set(angles), sorted(sizes)
    beyond = [at < k for k in range(max(sizes, default=0))]  # rows whose k-th row before is another episode's
    out: dict[str, np.ndarray] = {}
    for c in sensors:
        x = columns[c]
        ok = ~np.isnan(x)
        whole = ok.all()
        if c in angles:
            parts = [np.where(ok, f(np.radians(x)), 0.0) for f in (np.sin, np.cos)]
        else:  # less the last value there is, whatever it be: sums then have the size of the window's spread
            last = np.maximum.accumulate(np.where(ok, np.arange(len(x)), -1))[held:]
            ref, x = np.where(last >= 0, x[last], 0.0), np.where(ok, x, 0.0)
        count, a, b, k = np.zeros(n), np.zeros(n), np.zeros(n), 0
        d = np.empty(n)
        for size in sizes:
            for k in range(k, size):  # noqa: B020
                own = slice(held - k, held - k + n)
                none = beyond[k] if whole else beyond[k] | ~ok[own]
                count += ~none
                if c in angles:
                    a += np.where(none, 0.0, parts[0][own])
                    b += np.where(none, 0.0, parts[1][own])
                else:
                    np.subtract(x[own], ref, out=d)
                    np.copyto(d, 0.0, where=none)
                    a += d
                    d *= d
                    b += d
            k, few, many = size, count < least_periods(size), np.maximum(count, 1)
            if c in angles:
                s, t = a / many, b / many
                r = np.clip(np.sqrt(s * s + t * t), 1e-9, 1.0)
                new = {"circmean": np.mod(np.degrees(np.arctan2(s, t)), 360.0), "circstd": np.degrees(np.sqrt(np.abs(-2 * np.log(r))))}
            else:
                new = {"mean": ref + a / many, "std": np.sqrt(np.maximum(b - a * a / many, 0.0) / np.maximum(count - 1, 1))}
            out |= {f"{c}_roll{size}_{m}": np.where(few, np.nan, v) for m, v in new.items()}
    before = lambda c, k: np.where(at >= k, columns[c][held - k : held - k + n], np.nan)
    for c in sensors[:top]:
        out[f"{c}_diff"] = columns[c][held:] - before(c, 1)
        out |= {f"{c}_lag{k}": before(c, k) for k in steps}
    return out


def places(batch: pa.RecordBatch, key: tuple | None, place: int) -> tuple[np.ndarray, tuple]:
    """(place of each row in its episode, key of the last one); key and place: those of the row before."""
    codes = [np.asarray(batch[c].dictionary_encode(null_encoding="encode").indices) for c in EPISODE]
    first = tuple(batch[c][0].as_py() for c in EPISODE) != key
    begins = np.concatenate([[first], np.any([np.diff(v) != 0 for v in codes], axis=0)])
    row = np.arange(len(begins))
    return row - np.maximum.accumulate(np.where(begins, row, -place - 1)), tuple(batch[c][-1].as_py() for c in EPISODE)


def _in_zero_runs(zeros: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """Whether rows lie in runs of ``least`` or more zeros of one episode. zeros: by column; the first ``least - 1`` rows are
    those before, and as many of the last rows, which have no answer yet, are not told. at: places of the rows but for the first."""
    n = len(at)
    ends = zeros[:, least - 1 :] & (at >= least - 1)
    for k in range(1, least):
        ends &= zeros[:, least - 1 - k : least - 1 - k + n]
    out = ends[:, : n - least + 1].copy()
    for k in range(1, least):
        out |= ends[:, k : n - least + 1 + k]
    return out


def _looking_ahead(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """(batch, rows that are its own): with up to ``rows`` rows after its own, all that there are."""
    rest = None
    for batch in batches:
        if batch.num_rows:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            if rest.num_rows > rows:
                yield rest, rest.num_rows - rows
                rest = rest.slice(rest.num_rows - rows)
    if rest is not None and rest.num_rows:
        yield rest, rest.num_rows


def by_episode(df: DataFrame) -> DataFrame:
    """The table dealt by episode into as many parts as shuffles have, which stay so many however few bytes they are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *EPISODE)


def ordered_narrow(df: DataFrame, sensors: list[str], angles: Iterable[str] = (), sizes: Iterable[int] = WINDOWS, steps: Iterable[int] = LAGS, top: int = 10, pack: tuple[list[str], list[str]] | None = None, mask: Iterable[str] = (), floats: Iterable[str] | None = None, last: Iterable[str] = (), make: Make | None = None, dealt: bool = False) -> DataFrame:
    """The columns of ``ordered_wide`` for sensors that are doubles: rows come in the order of the episodes, many episodes a batch,
    and a task holds a batch and the few rows before and after it that windows, lags and runs reach to, whatever an episode's length.

    pack: columns of the table that go before and after the new ones into one packed column (``vectors.PACKED``), which
    replaces them all; columns of other types than numbers stay. mask: sensors whose runs of zeros are masked before. floats:
    columns of the table that come as 4-byte floats, as the new ones then do. last: columns of the table that come after the
    new ones. make: sensors that the table lacks are made of its numbers in the tasks, see ``gramian.read``, and come after
    its own sensors. dealt: the rows are dealt by episode and in order already."""
    angles, sizes, steps, mask, last = set(angles), tuple(sizes), tuple(steps), list(mask), list(last)
    kinds = lambda c: ("circmean", "circstd") if c in angles else ("mean", "std")
    added = [f"{c}_roll{n}_{k}" for n in sizes for c in sensors for k in kinds(c)]
    added += [f"{c}_diff" for c in sensors[:top]] + [f"{c}_lag{n}" for n in steps for c in sensors[:top]]
    held = max([1, *(n - 1 for n in sizes), *steps])
    single, run_of = set(floats or ()), 6
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    absent = [c for c in sensors if c not in df.columns]
    if pack:
        names = [*pack[0], *added, *pack[1]]
        stay = [f for f in df.schema.fields if f.name not in names]
        schema = T.StructType([*stay, vectors.packed(vectors.PACKED, names)])
    else:
        new = T.DoubleType() if floats is None else T.FloatType()
        own = [T.StructField(f.name, T.FloatType(), f.nullable) if f.name in single else f for f in df.schema.fields]
        at = max((k for k, f in enumerate(own, 1) if f.name in sensors), default=len(own))
        own = {f.name: f for f in [*own[:at], *[T.StructField(n, new) for n in absent], *own[at:]]}
        schema = T.StructType([*[f for n, f in own.items() if n not in last], *[T.StructField(n, new) for n in added], *[own[n] for n in last]])
        number = pa.float64() if floats is None else pa.float32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, key, place = {c: np.full(held, np.nan) for c in sensors}, None, 0
        zeros = np.zeros((len(mask), run_of - 1), bool)
        as_float = lambda b, c: np.asarray(b[c].to_numpy(zero_copy_only=False), np.float64)
        for seen, mine in _looking_ahead(batches, run_of - 1 if mask else 0):
            batch = seen.slice(0, mine)
            at, _ = places(seen, key, place)
            values = {c: as_float(seen, c) for c in sensors if c not in absent}
            if absent:
                values |= dict(zip(absent, make({c: as_float(seen, c) for c in numbers}, absent), strict=True))
            columns = {c: values[c][:mine] for c in sensors}
            if mask:
                after = np.zeros((len(mask), run_of - 1 - (len(at) - mine)), bool)
                zeros = np.hstack([zeros, np.stack([values[c] == 0 for c in mask]), after])
                hit = _in_zero_runs(zeros, np.concatenate([at, np.zeros(after.shape[1], at.dtype)]), run_of)
                columns |= {c: np.where(h, np.nan, columns[c]) for c, h in zip(mask, hit, strict=True) if h.any()}
                zeros = zeros[:, mine : mine + run_of - 1]
            at, key = at[:mine], tuple(batch[c][-1].as_py() for c in EPISODE)
            place = int(at[-1])
            columns = {c: np.concatenate([before[c], v]) for c, v in columns.items()}
            before = {c: v[-held:] for c, v in columns.items()}
            if pack:
                made = trailing_arrays(columns, at, held, sensors, angles, sizes, steps, top) | {c: columns[c][held:] for c in mask}
                value = lambda n: made[n] if n in made else batch[n].to_numpy(zero_copy_only=False)  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays([*[batch[f.name] for f in stay], vectors.pack(np.stack([value(n) for n in names], axis=1))], names=schema.names)
                continue
            made = {*mask, *absent}
            arrays = {n: batch[n].cast(pa.float32()) if n in single else batch[n] for n in own if n not in made}
            arrays |= {c: pa.array(columns[c][held:].astype(np.float32) if own[c].dataType == T.FloatType() else columns[c][held:], from_pandas=True) for c in made}
            for k, c in enumerate(sensors):  # one sensor's new columns at a time
                for n, v in trailing_arrays({c: columns[c]}, at, held, [c], angles, sizes, steps, int(k < top)).items():
                    arrays[n] = pa.array(v if floats is None else v.astype(np.float32), number, from_pandas=True)
            yield pa.RecordBatch.from_arrays([arrays[n] for n in schema.names], names=schema.names)

    rows = df if dealt else df.repartition(*EPISODE).sortWithinPartitions(*EPISODE, "time_stamp", "id")
    return rows.mapInArrow(run, schema)


def differences(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    w = episode()
    return df.select("*", *[(F.col(c) - F.lag(c).over(w)).alias(f"{c}_diff") for c in columns])


def lags(df: DataFrame, columns: Iterable[str], steps: Iterable[int] = LAGS) -> DataFrame:
    w = episode()
    return df.select("*", *[F.lag(c, n).over(w).alias(f"{c}_lag{n}") for n in steps for c in columns])


def in_long_run(hit: Column, least: int, w: WindowSpec) -> Column:
    """Whether a row lies in a run of at least ``least`` hits: erosion to run ends, then dilation back over the run.

    ``hit`` must not be NULL. Both frames are bounded, so a run's length doesn't matter.
    """
    ends = F.sum(hit.cast("int")).over(w.rowsBetween(-(least - 1), 0)) == least
    return F.max(ends.cast("int")).over(w.rowsBetween(0, least - 1)) == 1


def _nested(df: DataFrame, hits: dict[str, Column], least: int, w: WindowSpec) -> DataFrame:
    """Add a 0/1 column for each hit: in a long run or not."""
    eroded = df.select("*", *[(F.sum(h.cast("int")).over(w.rowsBetween(-(least - 1), 0)) == least).cast("int").alias(f"_e_{n}") for n, h in hits.items()])
    out = eroded.select("*", *[F.max(f"_e_{n}").over(w.rowsBetween(0, least - 1)).alias(n) for n in hits])
    return out.drop(*[f"_e_{n}" for n in hits])


def _zero_runs(x: np.ndarray, least: int) -> np.ndarray:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (x == 0).view(np.int8), [0]])))
    out = x.copy()
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        if b - a >= least:
            out[a:b] = np.nan
    return out


def mask_zero_runs(df: DataFrame, columns: Iterable[str], least: int = 6, keep: Iterable[str] = (), wide: int = 12) -> DataFrame:
    """NULL for exact zeros in runs of ``least`` or more; NULL breaks a run; columns in ``keep`` (power, wind) stay.

    Beyond ``wide`` columns they are masked episode by episode in numpy; every column keeps its type either way."""
    todo = [c for c in columns if c not in set(keep)]
    if len(todo) > wide:
        kinds = {f.name: f.dataType for f in df.schema}
        # Only floats go through numpy; of the others, such as longs beyond 2^53, it finds where they are masked.
        marks = {c: f"_zero_{k}" for k, c in enumerate(todo) if not isinstance(kinds[c], (T.DoubleType, T.FloatType))}
        seen = df.withColumns({m: F.when(F.col(c) == 0, 0.0).when(F.col(c).isNotNull(), 1.0) for c, m in marks.items()} | {c: F.col(c).cast("double") for c in todo if c not in marks})
        own = [marks.get(c, c) for c in todo]
        out = _by_episode(seen, own, own, lambda v: {c: _zero_runs(x, least) for c, x in v.items()}, replace=True)
        back = lambda c: F.when(F.col(marks[c]).isNotNull(), F.col(c)).alias(c) if c in marks else F.col(c).cast(kinds[c]).alias(c) if c in todo else F.col(c)
        return out.select(*map(back, df.columns))
    if not todo:
        return df
    if len(todo) > 62:  # more than a long has bits
        return mask_zero_runs(mask_zero_runs(df, todo[:62], least, wide=wide), todo[62:], least, wide=wide)
    # One bit a column, so that a frame adds up one number whatever the number of columns: runs' ends, then back over the runs.
    w, bit = episode(), {c: F.lit(1 << k).cast("long") for k, c in enumerate(todo)}
    zeros = reduce(Column.bitwiseOR, [F.when(F.coalesce(F.col(c) == 0, F.lit(False)), b).otherwise(F.lit(0).cast("long")) for c, b in bit.items()])
    back = w.rowsBetween(-(least - 1), 0)
    ends = F.when(F.row_number().over(w) >= least, F.bit_and("_zeros").over(back)).otherwise(F.lit(0).cast("long"))
    marked = df.withColumn("_zeros", zeros).withColumn("_ends", ends).withColumn("_runs", F.bit_or("_ends").over(w.rowsBetween(0, least - 1)))
    return marked.select(*[F.when(F.col("_runs").bitwiseAND(b) == 0, F.col(c)).alias(c) if (b := bit.get(c)) is not None else F.col(c) for c in df.columns])


def sustained(df: DataFrame, score: str, threshold: Column | float, least: int = 6, keys: tuple[str, ...] = (), out: str = "flag") -> DataFrame:
    """Add a flag: score at the threshold or above in a run of ``least`` rows or more; a NULL score breaks a run."""
    hit = F.coalesce(F.col(score) >= (F.lit(threshold) if not isinstance(threshold, Column) else threshold), F.lit(False))
    return _nested(df, {out: hit}, least, episode(*keys))


def islands(df: DataFrame, flag: str = "flag", keys: tuple[str, ...] = ()) -> DataFrame:
    """Add run_start (1 where a run of 1s begins) and run_id (number of the last run begun)."""
    w = episode(*keys)
    begun = df.withColumn("run_start", ((F.col(flag) == 1) & (F.coalesce(F.lag(flag).over(w), F.lit(0)) == 0)).cast("int"))
    return begun.withColumn("run_id", F.sum("run_start").over(w))


def tail_split(df: DataFrame, share: float = 0.2, least_rows: int = 1) -> DataFrame:
    """Add is_validation: the last max(1, floor(share * n)) rows of each episode. Episodes under ``least_rows`` go."""
    back = Window.partitionBy("farm_id", "dataset_id").orderBy(F.col("time_stamp").desc(), F.col("id").desc())
    n = F.count("*").over(Window.partitionBy("farm_id", "dataset_id"))
    marked = df.select("*", F.row_number().over(back).alias("_back"), n.alias("_n")).where(F.col("_n") >= least_rows)
    return marked.withColumn("is_validation", F.col("_back") <= F.greatest(F.lit(1), F.floor(F.col("_n") * share))).drop("_back", "_n")


def with_split(df: DataFrame, rows: Column, share: float = 0.2, least_rows: int = 1) -> DataFrame:
    """Add is_validation as ``tail_split`` of the given rows does, NULL for all others, without leaving any out: one shuffle by
    episode, which what is ordered by episode before shares."""
    w = episode()
    n, upto = (F.sum(rows.cast("int")).over(f) for f in (Window.partitionBy(*EPISODE), w.rowsBetween(Window.unboundedPreceding, 0)))
    marked = df.select("*", n.alias("_n"), upto.alias("_upto"))
    last = F.col("_n") - F.col("_upto") < F.greatest(F.lit(1), F.floor(F.col("_n") * share))
    return marked.withColumn("is_validation", F.when(rows & (F.col("_n") >= least_rows), last)).drop("_n", "_upto")


def gaps(df: DataFrame, most_minutes: float = 30.0) -> DataFrame:
    """(episode, n_gaps, max_gap_minutes): steps longer than ``most_minutes``."""
    step = (F.unix_micros(F.col("time_stamp").cast("timestamp")) - F.unix_micros(F.lag(F.col("time_stamp").cast("timestamp")).over(episode()))) / 6e7
    return df.select("farm_id", "dataset_id", step.alias("step")).groupBy("farm_id", "dataset_id").agg(F.count_if(F.col("step") > most_minutes).alias("n_gaps"), F.max("step").alias("max_gap_minutes"))


def sequences(df: DataFrame, columns: list[str], steps: int = 6) -> DataFrame:
    """Add seq: the last ``steps`` vectors of the episode, padded at the front with its first; NULLs are 0."""
    vec = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    w = episode()
    seen = F.collect_list("_vec").over(w.rowsBetween(-(steps - 1), 0))
    out = df.withColumn("_vec", vec).withColumn("_seen", seen)
    return out.withColumn("seq", F.concat(F.array_repeat(F.element_at("_seen", 1), steps - F.size("_seen")), F.col("_seen"))).drop("_vec", "_seen")


def numbered(df: DataFrame, out: str = "row") -> DataFrame:
    """Add the position in the episode, from 0."""
    return df.withColumn(out, F.row_number().over(episode()) - 1)


def latest(df: DataFrame, n: int = 1, keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """The last n readings of each key; ties go to the larger id."""
    back = Window.partitionBy(*keys).orderBy(F.col("time_stamp").desc(), F.col("id").desc())
    return df.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= n).drop("_back")


def rolling_extremes(df: DataFrame, columns: Iterable[str], rows: int) -> DataFrame:
    f = _trailing(episode(), rows)
    return df.select("*", *[x for c in columns for x in (F.min(c).over(f).alias(f"{c}_roll{rows}_min"), F.max(c).over(f).alias(f"{c}_roll{rows}_max"))])


def rolling_missing(df: DataFrame, columns: Iterable[str], rows: int) -> DataFrame:
    f = _trailing(episode(), rows)
    return df.select("*", *[F.avg(F.isnull(c).cast("double")).over(f).alias(f"{c}_roll{rows}_missing") for c in columns])


def rolling_time(df: DataFrame, columns: Iterable[str], seconds: int) -> DataFrame:
    """Means over the last ``seconds``, whatever the number of rows."""
    w = Window.partitionBy("farm_id", "dataset_id").orderBy(F.unix_seconds(F.col("time_stamp").cast("timestamp"))).rangeBetween(-seconds + 1, 0)
    return df.select("*", *[F.avg(c).over(w).alias(f"{c}_last{seconds}s_mean") for c in columns])


def regular_grid(df: DataFrame, columns: Iterable[str], step: str = "10 minutes") -> DataFrame:
    """Episode means on a regular grid; grid points without readings have NULL values."""
    cell = df.withColumn("slot", F.window(F.col("time_stamp").cast("timestamp"), step)["start"])
    means = cell.groupBy("farm_id", "dataset_id", "slot").agg(*[F.avg(c).alias(c) for c in columns])
    spine = means.groupBy("farm_id", "dataset_id").agg(F.min("slot").alias("a"), F.max("slot").alias("b")).select("farm_id", "dataset_id", F.explode(F.sequence("a", "b", F.expr(f"interval {step}"))).alias("slot"))
    return spine.join(means, ["farm_id", "dataset_id", "slot"], "left")
