"""Sums of products of all pairs of columns, pairwise complete, in tiles: for correlations of any number of columns.

Columns are cut into blocks; each pair of blocks is one tile, scanned as a task set of its own that reads the columns of its
two blocks only. A task adds up its rows' products as numpy matrices and sends a tile's rows as arrays; arrays of FAN tasks
are added in one group, and their sums, written, again, until one is left. So a task holds six tiles at most, whatever the number of
columns, and no row of the table is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.operators import vectors
from vanewright.session import stored

#: Columns of a block, rows of a tile that are added in one group, and tasks whose arrays are.
TILE, STRIPE, FAN = 1024, 16, 128
#: Rows of a batch whose columns are made at once.
PIECE = 2048
#: Columns made in the tasks: of a table's columns by name, NULL as NaN, and the names wanted, a matrix with a row a name.
Make = Callable[[dict[str, np.ndarray], list[str]], np.ndarray]
SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")
_PART = "first int, second int, stripe int, part int, " + ", ".join(f"{s} array<array<double>>" for s in SUMS)


def columns_of(batch: pa.RecordBatch) -> np.ndarray:
    """Columns of numbers as the rows of a matrix, NULL as NaN."""
    x = np.empty((batch.num_columns, batch.num_rows))
    for k, c in enumerate(batch.columns):
        x[k] = c.to_numpy(zero_copy_only=False)
    return x


def read(df: DataFrame, columns: list[str], make: Make | None = None) -> tuple[DataFrame, Callable[[pa.RecordBatch], Iterator[np.ndarray]]]:
    """(table to read, what gives its batches' ``columns`` as rows of matrices). With ``make`` the columns are none of the
    table's but made of them, a piece of a batch at a time, so that hundreds of columns of few are neither written nor sent.
    Packed columns (``vectors.PACKED``) come as one."""
    names = vectors.packed_names(df)
    if make is None and names is not None:
        at = [names.index(c) for c in columns]

        def unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            for a in range(0, batch.num_rows, PIECE):
                yield np.ascontiguousarray(vectors.unpack(batch.column(0).slice(a, PIECE), len(names)).T[at])

        return df.select(vectors.PACKED), unpacked
    if make is None:
        return df.select(*[F.col(f"`{c}`").cast("double") for c in columns]), lambda batch: iter([columns_of(batch)] if batch.num_rows else [])

    def pieces(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for a in range(0, batch.num_rows, PIECE):
            part = batch.slice(a, PIECE)
            yield make(dict(zip(part.schema.names, columns_of(part), strict=True)), columns)

    return df, pieces


def near(df: DataFrame, columns: list[str], make: Make) -> np.ndarray | None:
    """A number near each column's values, to be taken off them so that a large offset costs no digits: the mean of the table's
    first rows. Sums about any such number give the same correlations and variances. None where these rows have no value."""
    found = [x for batch in df.limit(PIECE).toArrow().to_batches() for x in read(df, columns, make)[1](batch)]
    x = np.hstack([np.empty((len(columns), 0)), *found])
    ok = ~np.isnan(x)
    return np.where(ok, x, 0.0).sum(axis=1) / ok.sum(axis=1) if ok.any(axis=1).all() else None


def spread(df: DataFrame) -> DataFrame:
    """The table dealt over all cores where its files are fewer parts than that takes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(4 * cores)


class _Tile:
    """Six sums for each pair of a column of block a and one of block b. Rows without NULLs need one product, which of a block
    with itself (the same array) is half the work and has the squares on its diagonal."""

    def __init__(self, a: int, b: int):
        self.n, self.sab, self.same = 0, np.zeros((a, b)), False
        self.sums = [np.zeros(a), np.zeros(b), np.zeros(a), np.zeros(b)]
        self.gaps: list[np.ndarray] | None = None

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        self.same = same = x is y
        sx = x.sum(axis=1)
        sy = sx if same else y.sum(axis=1)
        if np.isnan(sx).any() or np.isnan(sy).any():
            whole = ~(np.isnan(x).any(axis=0) | np.isnan(y).any(axis=0))
            self._add_gaps(x[:, ~whole], y[:, ~whole])
            x = x[:, whole]
            y = x if same else y[:, whole]
            sx, sy = x.sum(axis=1), y.sum(axis=1)
        self.n += x.shape[1]
        self.sab += x @ y.T
        self.sums[0] += sx
        self.sums[1] += sy
        if not same:
            self.sums[2] += np.einsum("ij,ij->i", x, x)
            self.sums[3] += np.einsum("ij,ij->i", y, y)

    def _add_gaps(self, x: np.ndarray, y: np.ndarray) -> None:
        m, k = (~np.isnan(v) for v in (x, y))
        x, y, m, k = np.where(m, x, 0.0), np.where(k, y, 0.0), m.astype(np.float64), k.astype(np.float64)
        new = (m @ k.T, x @ k.T, m @ y.T, (x * x) @ k.T, m @ (y * y).T, x @ y.T)
        self.gaps = list(new) if self.gaps is None else [a + b for a, b in zip(self.gaps, new, strict=True)]

    def matrices(self) -> list[np.ndarray]:
        one = np.ones_like(self.sab)
        sa, sb, saa, sbb = [*self.sums[:2], np.diag(self.sab), np.diag(self.sab)] if self.same else self.sums
        out = [self.n * one, sa[:, None] * one, sb[None, :] * one, saa[:, None] * one, sbb[None, :] * one, self.sab]
        return out if self.gaps is None else [a + b for a, b in zip(out, self.gaps, strict=True)]


def _nested(m: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(m).ravel())
    rows = pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), flat)
    return pa.ListArray.from_arrays(pa.array([0, len(m)], pa.int32()), rows)


def _sent(first: int, second: int, stripe: int, part: int, sums: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int32()) for v in (first, second, stripe, part)], *map(_nested, sums)], names=["first", "second", "stripe", "part", *SUMS])


def _tile(df: DataFrame, columns: list[str], centre: np.ndarray, first: int, second: int, tile: int, make: Make | None = None) -> DataFrame:
    a, b = columns[first * tile : (first + 1) * tile], columns[second * tile : (second + 1) * tile]
    both = a if first == second else a + b
    shift = np.concatenate([centre[first * tile :][: len(a)], centre[second * tile :][: len(b)]])[: len(both), None]
    rows, matrices = read(df, both, make)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, any_row = _Tile(len(a), len(b)), False
        for batch in batches:
            for x in matrices(batch):
                x -= shift
                sums.add(*((x, x) if first == second else (x[: len(a)], x[len(a) :])))
                any_row = True
        if any_row:
            part, found = TaskContext.get().partitionId(), sums.matrices()
            for k in range(0, len(a), STRIPE):
                yield _sent(first, second, k // STRIPE, part, [m[k : k + STRIPE] for m in found])

    return rows.mapInArrow(run, _PART)


def _array(column: pa.ChunkedArray, row: int) -> np.ndarray:
    rows = column[row].values
    return np.asarray(rows.flatten(), np.float64).reshape(len(rows), -1)


def pair_sums(df: DataFrame, columns: list[str], centre: np.ndarray, tile: int = TILE, make: Make | None = None) -> DataFrame:
    """(first, second, stripe, sums): of values less ``centre``, for tiles with first <= second, STRIPE columns of the first
    block a row: arrays by (column of the first block, column of the second). Empty for an empty table."""
    df = spread(df) if make else df
    blocks = range(-(-len(columns) // tile))
    out = None
    for i in blocks:
        for j in blocks[i:]:
            one = _tile(df, columns, centre, i, j, tile, make)
            out = one if out is None else out.unionByName(one)

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table["part"].to_numpy(), kind="stable")  # one order of adding up
        sums = [sum(_array(table[s], int(k)) for k in order) for s in SUMS]
        at = [table[c][0].as_py() for c in ("first", "second", "stripe", "part")]
        return pa.Table.from_batches([_sent(*at[:3], at[3] // FAN, sums)])

    while True:
        out = stored(out.groupBy("first", "second", "stripe", F.floor(F.col("part") / FAN)).applyInArrow(add, _PART), "products")
        if not out.agg(F.max("part")).first()[0]:
            return out.drop("part")


def own_moments(sums: DataFrame, columns: list[str], centre: np.ndarray, tile: int = TILE) -> DataFrame:
    """(feature, n, mean, variance) of the columns' values, from the pairs of each column with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                k = batch.column("stripe")[row].as_py() * STRIPE
                n, s, ss = (np.diagonal(_array(batch.column(name), row), k) for name in ("n", "sa", "saa"))
                at = batch.column("first")[row].as_py() * tile + k + np.arange(len(n))
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean, var = centre[at] + s / n, np.maximum(ss - s * s / n, 0.0) / (n - 1)
                cells = (pa.array(v, mask=n < least) for v, least in ((mean, 1), (var, 2)))
                yield pa.RecordBatch.from_arrays([pa.array([columns[j] for j in at]), pa.array(n), *cells], names=["feature", "n", "mean", "variance"])

    return sums.where("first = second").mapInArrow(run, "feature string, n double, mean double, variance double")


def correlated(sums: DataFrame, columns: list[str], centre: np.ndarray, tile: int = TILE, above: float | None = None) -> DataFrame:
    """(a, b, r) for a before b in ``columns``: absolute Pearson correlation, NULL where a side does not vary among the
    pair's rows, up to rounding; only those over ``above`` if it is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                i0 = batch.column("first")[row].as_py() * tile + batch.column("stripe")[row].as_py() * STRIPE
                j0 = batch.column("second")[row].as_py() * tile
                n, sa, sb, saa, sbb, sab = (_array(batch.column(s), row) for s in SUMS)
                i, j = np.arange(i0, i0 + len(n)), np.arange(j0, j0 + n.shape[1])
                va, vb = n * saa - sa * sa, n * sbb - sb * sb
                flat = lambda v, ss, c: v <= 1e-12 * n * (ss + n * (c * 1e-3) ** 2)  # noqa: E731,B023
                fixed = flat(va, saa, centre[i][:, None]) | flat(vb, sbb, centre[j][None, :])
                with np.errstate(divide="ignore", invalid="ignore"):
                    r = np.abs((n * sab - sa * sb) / np.sqrt(np.abs(va) * np.abs(vb)))
                r[fixed] = np.nan
                keep = (i[:, None] < j[None, :]) & (True if above is None else r > above)
                p, q = np.nonzero(keep)
                yield pa.RecordBatch.from_pydict({"a": pa.array([columns[k] for k in i[p]], pa.string()), "b": pa.array([columns[k] for k in j[q]], pa.string()), "r": pa.array(r[p, q], mask=np.isnan(r[p, q]))})

    return sums.mapInArrow(run, "a string, b string, r double")
