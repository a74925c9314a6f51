"""Statistics of vectors by model, in Arrow batches: moments and exact percentiles of every position.

Rows are (model, x array<double>, or packed as bytes); NULLs in x are missing values. Nothing here explodes or shuffles the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.session import stored

#: Points that a block of rows sends for each position, positions of a row of the sketch, sketches that meet in one group.
POINTS, STRIPE, FAN = 64, 32, 128
#: Bytes of vectors that a task holds before it sketches them.
HELD = 64 << 20
#: Models times positions up to which the brackets go to the tasks with the plan: 24 bytes each and share.
CELLS = 1_000_000


#: A column of all features of a row as the bytes of doubles, NULL as NaN: one value to write, read and send instead of a hundred.
PACKED = "_packed"


def packed(name: str, names: list[str]) -> T.StructField:
    """The field of packed columns; their names go with it."""
    return T.StructField(name, T.BinaryType(), True, {"names": list(names)})


def packed_names(df: DataFrame) -> list[str] | None:
    """Names of a table's packed columns, in order, or None."""
    return list(df.schema[PACKED].metadata["names"]) if PACKED in df.columns else None


def pack(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as the bytes of their doubles."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(8 * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x, np.float64))])


def unpack(column: pa.Array, positions: int) -> np.ndarray:
    """The matrix of a packed column."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2][int(ends[0]) : int(ends[-1])], np.float64).reshape(-1, positions)


def nested(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as arrays, NaN as NULL."""
    flat = np.ascontiguousarray(x).ravel()
    gaps = np.isnan(flat)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1])), pa.array(flat, pa.float64(), mask=gaps if gaps.any() else None))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays as a matrix, NULL as NaN."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def cut(names: list[str], wanted: list[str], out: str = "x") -> Column:
    """The packed column with the wanted positions alone, packed too: bytes are cut where they are, before any task of Python.
    Its field tells how many there are, see ``reader``."""
    runs: list[list[int]] = []  # first position, positions
    for k in map(names.index, wanted):
        if runs and sum(runs[-1]) == k:
            runs[-1][1] += 1
        else:
            runs.append([k, 1])
    parts = [F.substring(PACKED, 8 * a + 1, 8 * n) for a, n in runs]
    whole = F.col(PACKED) if runs == [[0, len(names)]] else parts[0] if len(parts) == 1 else F.concat(*parts)
    return whole.alias(out, metadata={"of": len(wanted)})


def reader(df: DataFrame, name: str = "x") -> Callable[[pa.Array], np.ndarray]:
    """What makes a matrix of a column of the table, packed (``cut``) or of arrays."""
    positions = (df.schema[name].metadata or {}).get("of")
    return matrix if positions is None else lambda column: unpack(column, positions)


def by_model(batches: Iterator[pa.RecordBatch], read: Callable[[pa.Array], np.ndarray] = matrix) -> Iterator[tuple[str, np.ndarray]]:
    """(model, rows as a matrix) of each batch of (model, x); NULL models are one model, None."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, codes = read(batch.column(1)), batch.column(0).dictionary_encode(null_encoding="encode")
        names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy()
        if len(names) == 1:
            yield names[0], x
            continue
        order = np.argsort(code, kind="stable")
        edges = np.searchsorted(code[order], np.arange(len(names) + 1))
        for k, name in enumerate(names):
            yield name, x[order[edges[k] : edges[k + 1]]]


class _Held:
    """Rows by model, given out in blocks when a model or the task holds enough of them."""

    def __init__(self, most: int = HELD):
        self.most, self.rows, self.bytes, self.total = most, {}, {}, 0

    def add(self, model: str, x: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        self.rows.setdefault(model, []).append(x)
        self.bytes[model] = self.bytes.get(model, 0) + x.nbytes
        self.total += x.nbytes
        if self.total >= self.most:  # the largest goes; the others wait for more
            yield self.take(max(self.bytes, key=self.bytes.get))

    def take(self, model: str) -> tuple[str, np.ndarray]:
        self.total -= self.bytes.pop(model)
        return model, np.concatenate(self.rows.pop(model))

    def rest(self) -> Iterator[tuple[str, np.ndarray]]:
        for model in list(self.rows):
            yield self.take(model)


def _sketch(x: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Count, mean and squared deviations of each column, and a systematic sample of its sorted values with its weight.

    A column of n values sends all of them, or POINTS, one of each n / POINTS in order from a random start.
    """
    ok = ~np.isnan(x)
    n = ok.sum(axis=0)
    mean = np.where(ok, x, 0.0).sum(axis=0) / np.maximum(n, 1)
    dev = (np.where(ok, x - mean, 0.0) ** 2).sum(axis=0)
    s = np.sort(x, axis=0)
    step = np.maximum(n / POINTS, 1.0)
    at = np.floor((np.arange(POINTS)[:, None] + np.where(n > POINTS, rng.random(x.shape[1]), 0.0)) * step)
    points = np.take_along_axis(s, np.clip(at, 0, len(s) - 1).astype(np.int64), axis=0)
    return {"n": n.astype(np.float64), "mean": mean, "dev": dev, "weight": step, "noise": np.where(n > POINTS, step**2, 0.0), "points": np.where(at < n, points, np.nan)}


_SKETCH = "model string, stripe int, part int, rows long, n array<double>, mean array<double>, dev array<double>, noise array<double>, points array<array<double>>, weights array<array<double>>"


def _sent(model: str, rows: int, part: int, found: dict[str, np.ndarray]) -> Iterator[dict]:
    for stripe in range(0, len(found["n"]), STRIPE):
        own = slice(stripe, stripe + STRIPE)
        points = found["points"][:, own].T
        keep = [~np.isnan(v) for v in points]
        yield {
            "model": model, "stripe": stripe // STRIPE, "part": part, "rows": rows, **{k: found[k][own].tolist() for k in ("n", "mean", "dev", "noise")},
            "points": [v[k].tolist() for v, k in zip(points, keep, strict=True)], "weights": [np.full(k.sum(), w).tolist() for k, w in zip(keep, found["weight"][own], strict=True)],
        }


def _as_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"model": pa.string(), "stripe": pa.int32(), "part": pa.int32(), "rows": pa.int64()} | dict.fromkeys(("n", "mean", "dev", "noise"), pa.list_(pa.float64())) | dict.fromkeys(("points", "weights"), pa.list_(pa.list_(pa.float64())))
    return pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], t) for k, t in kinds.items()})


def _sketches(x: DataFrame, seed: int = 42) -> DataFrame:
    read = reader(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng, held = np.random.default_rng([seed, part]), _Held()
        for model, rows in by_model(batches, read):
            for m, block in held.add(model, rows):
                yield _as_batch(list(_sent(m, len(block), part, _sketch(block, rng))))
        for m, block in held.rest():
            yield _as_batch(list(_sent(m, len(block), part, _sketch(block, rng))))

    return x.select("model", "x").mapInArrow(run, _SKETCH)


def _joined(rows: list[dict], cap: int = 32 * POINTS) -> dict:
    """Sketches of one stripe as one: moments merge, points are united, and beyond ``cap`` sampled in order again."""
    n, mean, dev = (np.array([r[k] for r in rows], np.float64) for k in ("n", "mean", "dev"))
    total = n.sum(axis=0)
    grand = (n * mean).sum(axis=0) / np.maximum(total, 1)
    out = {"rows": sum(r["rows"] for r in rows), "n": total.tolist(), "mean": grand.tolist(), "dev": (dev + n * (mean - grand) ** 2).sum(axis=0).tolist(), "points": [], "weights": [], "noise": []}
    noise = np.array([r["noise"] for r in rows], np.float64).sum(axis=0)
    for k in range(len(total)):
        v, w = (np.concatenate([np.asarray(r[c][k], np.float64) for r in rows]) for c in ("points", "weights"))
        order = np.argsort(v, kind="stable")
        v, w, extra = v[order], w[order], 0.0
        if len(v) > cap:
            step = w.sum() / cap
            v, w, extra = v[np.searchsorted(np.cumsum(w), (np.arange(cap) + 0.5) * step).clip(0, len(v) - 1)], np.full(cap, step), step**2
        out["points"].append(v.tolist())
        out["weights"].append(w.tolist())
        out["noise"].append(noise[k] + extra)
    return out


def summaries(x: DataFrame) -> DataFrame:
    """(model, stripe, rows, n, mean, dev, noise, points, weights): the sketch of each model, STRIPE positions a row.

    Tasks' sketches meet in groups of FAN tasks, and those, written, again, until one is left: no group grows with the data.
    """

    def join(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: (r["part"], r["points"]))
        return pa.Table.from_batches([_as_batch([_joined(rows) | {"model": rows[0]["model"], "stripe": rows[0]["stripe"], "part": rows[0]["part"] // FAN}])])

    out = _sketches(x)
    while True:
        out = stored(out.groupBy("model", "stripe", F.floor(F.col("part") / FAN)).applyInArrow(join, _SKETCH), "sketches")
        if not out.agg(F.max("part")).first()[0]:
            return out.drop("part")


def _brackets(row: dict, shares: list[float], wide: float) -> list[list[tuple]]:
    """For each position and share (lo, hi) between which the wanted ranks lie, but for rare errors of the sample; equal to
    the wanted values where the sketch holds every value. 5 deviations of the counts below a value, at least."""
    out = []
    for k, n in enumerate(row["n"]):
        v, upto = np.asarray(row["points"][k]), np.cumsum(row["weights"][k])
        e = wide * (5 * (row["noise"][k] / 4) ** 0.5 + (max(row["weights"][k]) if row["noise"][k] else 0)) if n else 0.0
        own = []
        for share in shares:
            at = share * (n - 1)
            a = int(np.searchsorted(upto, np.floor(at) - e, side="right")) - (1 if e else 0)
            b = int(np.searchsorted(upto, np.ceil(at) + 1 + e, side="left"))
            if not n:
                own.append((np.nan, np.nan))
            else:
                own.append((v[a] if a >= 0 else -np.inf, v[b] if b < len(v) else np.inf))
        out.append(own)
    return out


def _counted(x: DataFrame, brackets: dict, positions: int) -> DataFrame:
    """(model, share, position, below, values, counts): of each bracket, how many values lie below it, and those inside."""

    read = reader(x)

    def told(rows: list[tuple]) -> pa.RecordBatch:
        names = ("model", "share", "position", "below", "values", "counts")
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))

    def flush(model: str, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        lo, hi = brackets[model]  # (shares, positions) each
        rows = []
        for s in range(len(lo)):
            below, inside = (x < lo[s]).sum(axis=0), (x >= lo[s]) & (x <= hi[s])
            for p in range(positions):
                v, c = np.unique(x[inside[:, p], p], return_counts=True)
                if below[p] or len(v):
                    rows.append((model, s, p, int(below[p]), v, c))
        if rows:
            yield told(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for model, rows in by_model(batches, read):
            for block in held.add(model, rows) if model in brackets else ():
                yield from flush(*block)
        for block in held.rest():
            yield from flush(*block)

    return x.select("model", "x").mapInArrow(run, "model string, share int, position int, below long, values array<double>, counts array<long>")


def _picked(counted: DataFrame, sizes: dict, shares: list[float]) -> DataFrame:
    """(model, share, position, value, missed): the percentile of each bracket; missed where the ranks lie outside it."""

    def pick(table: pa.Table) -> pa.Table:
        model, s, p = (table[c][0].as_py() for c in ("model", "share", "position"))
        v, c = (np.concatenate([np.asarray(x, float) for x in table[k].to_pylist()]) for k in ("values", "counts"))
        order = np.argsort(v, kind="stable")
        ends, below = np.cumsum(c[order]) if len(v) else np.zeros(0), sum(table["below"].to_pylist())
        at = shares[s] * (sizes[model][p] - 1)
        low, high = np.floor(at), np.ceil(at)
        missed = not len(v) or low < below or high >= below + ends[-1]
        if missed:
            value = None
        else:
            a, b = (float(v[order[np.searchsorted(ends, r - below, side="right")]]) for r in (low, high))
            value = a + (b - a) * (at - low)
        return pa.table({"model": pa.array([model], pa.string()), "share": pa.array([s], pa.int32()), "position": pa.array([p], pa.int32()), "value": pa.array([value], pa.float64()), "missed": [missed]})

    return counted.groupBy("model", "share", "position").applyInArrow(pick, "model string, share int, position int, value double, missed boolean")


def _decided(kept: DataFrame, shares: list[float], wide: float) -> DataFrame:
    """(model, stripe, sure, n, lo, hi): of each sketch either the percentiles, as lo, or brackets around their ranks; arrays
    by share, then position. Sketches stay where they are; what they come to is a few numbers a position."""
    brackets = _brackets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                sure = not any(row["noise"])
                found = _exact(row, shares) if sure else brackets(row, shares, wide)
                lo, hi = ([[float(found[k][s][e]) for k in range(len(found))] for s in range(len(shares))] for e in (0, 1))
                out.append((row["model"], row["stripe"], sure, row["n"], lo, hi))
            if out:
                nested = pa.list_(pa.list_(pa.float64()))
                kinds = (pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.float64()), nested, nested)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["model", "stripe", "sure", "n", "lo", "hi"])

    return kept.mapInArrow(run, "model string, stripe int, sure boolean, n array<double>, lo array<array<double>>, hi array<array<double>>")


def percentiles(x: DataFrame, shares: list[float]) -> tuple[DataFrame, DataFrame] | None:
    """((model, stripe, rows, n, mean, dev), (model, share, position, value)): moments and exact percentiles by position,
    linear between ranks; None where more than CELLS positions need a second pass (see ``stats.exact_percentiles`` then).

    One pass sketches every position: of each block of rows a systematic sample of its sorted values, from which a bracket
    around each wanted rank follows. Where a sketch holds all values (small models) that is the value. A second pass counts
    what lies below the brackets and sends only what lies inside: of n values some sqrt(n * rows of a block) / POINTS. A
    bracket that misses its rank, which the counts show, is made wider until none does, so results are exact.
    """
    kept = summaries(x)
    moments = kept.select("model", "stripe", "rows", "n", "mean", "dev")
    first = _decided(kept, shares, 1.0)
    at = first.where("sure").select("model", "stripe", F.posexplode("lo").alias("share", "v")).select("model", "share", "stripe", F.posexplode("v").alias("k", "value"))
    out = at.where(~F.isnan("value")).select("model", "share", (F.col("stripe") * STRIPE + F.col("k")).alias("position"), "value")
    left, wide = first.where("not sure"), 1.0
    if (left.agg(F.sum(F.size("n"))).first()[0] or 0) > CELLS:
        return None
    rows = left.collect()  # 8 + 16 bytes a share for each of CELLS positions at most
    while rows:
        positions = max(r["stripe"] * STRIPE + len(r["n"]) for r in rows)
        brackets, sizes = {}, {}
        for r in rows:
            own = slice(r["stripe"] * STRIPE, r["stripe"] * STRIPE + len(r["n"]))
            ends = brackets.setdefault(r["model"], tuple(np.full((len(shares), positions), np.nan) for _ in range(2)))
            sizes.setdefault(r["model"], np.zeros(positions))[own] = r["n"]
            for e, name in zip(ends, ("lo", "hi"), strict=True):
                e[:, own] = np.array(r[name], np.float64)
        found = stored(_picked(_counted(x, brackets, positions), sizes, shares), "percentiles")
        missed = {(r["model"], r["position"] // STRIPE) for r in found.where("missed").select("model", "position").distinct().collect()}
        if missed:
            wide *= 8
            redone = x.sparkSession.createDataFrame(sorted(missed, key=str), "model string, stripe int")
            same = lambda d: (d["model"].eqNullSafe(redone["model"])) & (d["stripe"] == redone["stripe"])
            found = found.withColumn("stripe", F.floor(F.col("position") / STRIPE).cast("int"))
            found = found.join(redone, same(found), "left_anti")
            rows = _decided(kept.join(redone, same(kept), "left_semi"), shares, wide).collect()
        else:
            rows = []
        out = out.unionByName(found.select("model", "share", "position", "value"))
    return moments, out


def _exact(row: dict, shares: list[float]) -> list[list[tuple]]:
    """For each position and share the percentile, twice, of a sketch that holds every value; NaN where there is none."""
    out = []
    for k, n in enumerate(row["n"]):
        v, own = np.asarray(row["points"][k], np.float64), []
        for share in shares:
            at = share * (n - 1)
            a, b = (v[int(np.floor(at))], v[int(np.ceil(at))]) if n else (np.nan, np.nan)
            own.append((a + (b - a) * (at - np.floor(at)),) * 2)
        out.append(own)
    return out
