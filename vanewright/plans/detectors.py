"""Unsupervised detectors as distributed jobs: isolation forest, linear autoencoder, sequence autoencoder.

Every function takes ``keys``: one model an episode, an asset, a farm, or, with (), one global model. All models of a call
are fitted in one job. Fitting gives a ``Fitted``: tables (scaler, trees or directions, offsets) that can be saved, loaded in
another session, and score any rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.functions.columns import EPISODE, META
from vanewright.operators import stats, windows
from vanewright.operators import vectors as arrays
from vanewright.session import stored

TREES, SAMPLE, SEED, CONTAMINATION = 300, 256, 42, 0.01
_TREE = "model string, tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, depth array<double>, psi int"
#: Of a model of few rows those rows, from which its trees grow again wherever they are needed: they are far smaller.
_GROWS = "grows struct<trees:int,sample:int,seed:bigint,rows:array<array<double>>>"
#: Rows up to which a model counts as small: all of it is one group.
SMALL = 5120
#: Models up to which what was fitted goes to the tasks with the plan (and ``vectors.CELLS`` numbers), and numbers of a piece of a batch.
MODELS, PIECE = 1000, 1 << 20


@dataclass
class Fitted:
    """A fitted detector: its kind, features, keys and options, and its tables by name."""

    kind: str
    features: list[str]
    keys: tuple[str, ...]
    options: dict = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def save(self, root: str) -> None:
        save_tables(self.tables, {"kind": self.kind, "features": self.features, "keys": list(self.keys), "options": self.options}, root)

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> Fitted:
        tables, told = load_tables(spark, root)
        return cls(told["kind"], told["features"], tuple(told["keys"]), told["options"], tables)

    def score(self, rows: DataFrame) -> DataFrame:
        """Metadata and score of rows; those of models that were not fitted are left out."""
        return SCORERS[self.kind](self, rows)


def save_tables(tables: dict[str, DataFrame], told: dict, root: str) -> None:
    """Tables as Parquet below ``root``, and what else there is to tell as one JSON line."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{root}/{name}")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(json.dumps(told | {"tables": sorted(tables)}),)], "told string").coalesce(1).write.mode("overwrite").text(f"{root}/about")


def load_tables(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], dict]:
    told = json.loads(spark.read.text(f"{root}/about").first()[0])
    return {name: spark.read.parquet(f"{root}/{name}") for name in told["tables"]}, told


def model_name(keys: tuple[str, ...]) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("?")) for k in keys]) if keys else F.lit("all")


def rows_of(df: DataFrame, features: list[str], keys: tuple[str, ...]) -> DataFrame:
    """(model, metadata, x): model names the keys' values. x of a table with packed features is packed (``vectors.cut``), and
    the task that computes with it reads it; of others it is an array. NULL features are NULL in x."""
    own = [model_name(keys).alias("model"), *[c for c in (*META, "is_validation") if c in df.columns]]
    names = arrays.packed_names(df)
    packed = names is not None and features and set(features) <= set(names)
    return df.select(*own, arrays.cut(names, features) if packed else F.array(*[F.col(c).cast("double") for c in features]).alias("x"))


def listed(x: DataFrame) -> DataFrame:
    """The same rows with x as an array."""
    read = arrays.reader(x)
    if read is arrays.matrix:
        return x
    rows = x.select(*[c for c in x.columns if c != "x"], "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _with(batch, "x", arrays.nested(read(batch.column("x"))))

    return rows.mapInArrow(run, _as_arrays(rows))


def _as_arrays(x: DataFrame) -> T.StructType:
    return T.StructType([*[f for f in x.schema if f.name != "x"], T.StructField("x", T.ArrayType(T.DoubleType()))])


def vectors(df: DataFrame, features: list[str], keys: tuple[str, ...]) -> DataFrame:
    """(model, metadata, x): model names the keys' values; NULL features are NULL in x, an array."""
    return listed(rows_of(df, features, keys))


def _with(batch: pa.RecordBatch, name: str, values: pa.Array, instead: str = "x") -> pa.RecordBatch:
    """The batch with another column for ``instead``, at the end."""
    names = [c for c in batch.schema.names if c != instead]
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], values], names=[*names, name])


def preprocessed(x: DataFrame, fitted: DataFrame) -> DataFrame:
    """Impute medians and standardise. fitted: (model, median, mean, std arrays)."""
    out = x.join(fitted, "model")
    z = F.zip_with(F.zip_with("x", "median", lambda v, m: F.coalesce(v, m)), F.zip_with("mean", "std", lambda m, s: F.struct(m.alias("m"), s.alias("s"))), lambda v, p: F.coalesce((v - p["m"]) / p["s"], F.lit(0.0)))
    return out.withColumn("x", z).drop("median", "mean", "std")


def sent(table: DataFrame, *numbers: str) -> dict[str, pa.Table] | None:
    """Rows of a fitted table by model, where it has so few models and numbers (in the columns told) that they go to the tasks
    with the plan; else None."""
    cells = sum((F.size(F.flatten(c) if dict(table.dtypes)[c].startswith("array<array") else c) for c in numbers), F.lit(0))
    other = F.max(F.col("grows").isNotNull()) if "grows" in table.columns else F.lit(False)  # trees that grow where they score
    models, size, grows = table.agg(F.count_distinct("model"), F.sum(cells), other).first()
    if models > MODELS or (size or 0) > arrays.CELLS or grows:
        return None
    whole = table.toArrow()
    return {m: whole.filter(pc.equal(whole["model"], m)) for m in pc.unique(whole["model"]).to_pylist()}


def _scalers(fitted: DataFrame) -> dict[str, tuple] | None:
    rows = sent(fitted, "median", "mean", "std")
    return rows and {m: tuple(np.array(t[c][0].as_py(), np.float64) for c in ("median", "mean", "std")) for m, t in rows.items()}


def _standardised(model: pa.Array, x: np.ndarray, scalers: dict[str, tuple]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(model, its rows in the batch, those standardised) of models that were fitted."""
    codes = model.dictionary_encode()
    code = np.asarray(codes.indices)
    for k, m in enumerate(codes.dictionary.to_pylist()):
        if m in scalers:
            at, (median, mean, std) = np.flatnonzero(code == k), scalers[m]
            own = x[at]
            z = (np.where(np.isnan(own), median, own) - mean) / std
            yield m, at, np.where(np.isnan(z), 0.0, z)


def standardised(x: DataFrame, fitted: DataFrame) -> DataFrame:
    """``preprocessed``, by numpy where the models are few."""
    scalers, read = _scalers(fitted), arrays.reader(x)
    if not scalers:
        return preprocessed(listed(x), fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keep = read(batch.column("x")), np.zeros(batch.num_rows, bool)
            z = np.empty_like(rows)
            for _, at, own in _standardised(batch.column("model"), rows, scalers) if batch.num_rows else ():
                z[at], keep[at] = own, True
            out = _with(batch, "x", arrays.nested(z))
            yield out if keep.all() else out.filter(pa.array(keep))

    return x.select(*[c for c in x.columns if c != "x"], "x").mapInArrow(run, _as_arrays(x))


def scored_in_tasks(x: DataFrame, scalers: dict[str, tuple], models: dict[str, pa.Table], ready: Callable[[pa.Table], Callable[[np.ndarray], np.ndarray]], out: str, steps: int = 1) -> DataFrame:
    """Replace x, not standardised, by ``out``, what ``ready(the model's fitted rows)(rows of x standardised)`` gives, or of the
    last ``steps`` rows of the episode, where few models go with the plan: no row is shuffled for its model. Rows of models
    that were not fitted go."""
    names, read = [c for c in x.columns if c != "x"], arrays.reader(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, last = {}, _Last(steps)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, got = read(batch.column("x")), np.full(batch.num_rows, np.nan)
            z, own, keep = np.zeros_like(rows), [], np.zeros(batch.num_rows, bool)
            for m, at, s in _standardised(batch.column("model"), rows, scalers):
                z[at] = s
                if m in models:
                    own.append((m, at))
                    keep[at] = True
                    made[m] = made.get(m) or ready(models[m])
            seen = last.add(batch, z)
            for m, at in own:
                most = max(1, PIECE // max(1, steps * z.shape[1]))
                for a in range(0, len(at), most):
                    got[at[a : a + most]] = made[m](seen(at[a : a + most]))
            done = _with(batch, out, pa.array(got, pa.float64()))
            yield done if keep.all() else done.filter(pa.array(keep))

    rows = _in_order(x) if steps > 1 else x
    return rows.mapInArrow(run, T.StructType([*[x.schema[c] for c in names], T.StructField(out, T.DoubleType())]))


def _in_order(x: DataFrame) -> DataFrame:
    return x.repartition(*EPISODE).sortWithinPartitions(*EPISODE, "time_stamp", "id")


class _Last:
    """The last ``steps`` rows of the episode for each row of batches that come in order, an episode's first repeated in front."""

    def __init__(self, steps: int):
        self.steps, self.key, self.place, self.before = steps, None, 0, None

    def add(self, batch: pa.RecordBatch, z: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """What gives the rows wanted of this batch as rows of steps times positions."""
        if self.steps == 1:
            return lambda rows: z[rows]
        held = self.steps - 1
        at, self.key = windows.places(batch, self.key, self.place)
        self.place = int(at[-1])
        whole = np.concatenate([np.zeros((held, z.shape[1])) if self.before is None else self.before, z])
        self.before = whole[-held:]
        back = np.arange(held, -1, -1)
        return lambda rows: whole[held + rows[:, None] - np.minimum(back, at[rows][:, None])].reshape(len(rows), -1)


def fit_preprocessor(x: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """(model, median, mean, std) arrays by feature position; features without any value become 0.
    counted: rows with the same models that are cheaper to count.

    Medians are exact whatever the size of a model, and no row is shuffled for them, see ``vectors.percentiles``. Mean and
    deviation are those after imputing the median; they follow from the sums of what is there.
    """
    if all_small(x if counted is None else counted):
        return listed(x.select("model", "x")).groupBy("model").applyInArrow(_fit_small, "model string, median array<double>, mean array<double>, std array<double>")
    found = arrays.percentiles(x, [0.5])
    if found is None:  # more models times features than brackets have room for
        return _fit_exploded(listed(x))
    moments, middle = found
    whole = lambda name: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("stripe", name))), lambda r: r[name])).alias(name)
    sums = moments.groupBy("model").agg(F.first("rows").alias("rows"), whole("n"), whole("mean"), whole("dev"))
    named = middle.groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct("position", "value"))).alias("middle"))
    cell = F.arrays_zip("n", "mean", "dev", F.transform(F.sequence(F.lit(0), F.size("n") - 1), lambda k: F.try_element_at("middle", k)).alias("median"))

    def fitted(v: Column) -> Column:
        gap = (F.col("rows") - v["n"]) / F.col("rows")
        mean = (1 - gap) * v["mean"] + gap * v["median"]
        off, low = v["mean"] - mean, v["median"] - mean
        std = F.sqrt((1 - gap) * (v["dev"] / v["n"] + off * off) + gap * low * low)
        one = lambda m, a, s: F.struct(m.alias("median"), a.alias("mean"), s.alias("std"))
        return F.when(v["n"] > 0, one(v["median"], mean, F.when(std > 0, std).otherwise(1.0))).otherwise(one(F.lit(0.0), F.lit(0.0), F.lit(1.0)))

    cells = sums.join(named, "model", "left").select("model", F.transform(cell, fitted).alias("c"))
    return cells.select("model", *[F.transform("c", lambda v: v[k]).alias(k) for k in ("median", "mean", "std")])


def all_small(x: DataFrame) -> bool:
    """Whether no model has more than SMALL rows."""
    return (x.groupBy("model").count().agg(F.max("count")).first()[0] or 0) <= SMALL


def _fit_small(t: pa.Table) -> pa.Table:
    """The same for all rows of one model."""
    x = arrays.matrix(t["x"].combine_chunks())
    ok = ~np.isnan(x)
    n = ok.sum(axis=0)
    s, at = np.sort(x, axis=0), 0.5 * np.maximum(n - 1, 0)
    a, b = (np.take_along_axis(s, f(at).astype(np.int64)[None, :], axis=0)[0] for f in (np.floor, np.ceil))
    median = np.where(n > 0, a + (b - a) * (at - np.floor(at)), 0.0)
    filled = np.where(ok, x, median)
    mean, std = filled.mean(axis=0), filled.std(axis=0)
    fixed = ~(filled.max(axis=0) > filled.min(axis=0))  # rounding of the mean may leave a fixed column a deviation
    mean, std = np.where(fixed, filled[0], mean), np.where(fixed | ~(std > 0), 1.0, std)
    cell = lambda v: pa.array([v], pa.list_(pa.float64()))
    return pa.table({"model": t["model"].slice(0, 1), "median": cell(median), "mean": cell(mean), "std": cell(std)})


def _fit_exploded(x: DataFrame) -> DataFrame:
    t = x.select("model", F.posexplode("x").alias("sensor", "value"))
    s = stats.preprocessor(t, "model")
    n = x.groupBy("model").agg(F.max(F.size("x")).alias("p"))
    m = s.groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct("sensor", F.struct("median", "mean", "std")))).alias("m")).join(n, "model")
    at = F.sequence(F.lit(0), F.col("p") - 1)
    pick = lambda c, d: F.transform(at, lambda i: F.coalesce(F.try_element_at("m", i)[c], F.lit(d))).alias(c)
    return m.select("model", pick("median", 0.0), pick("mean", 0.0), pick("std", 1.0))


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n points (Liu, Ting, Zhou, 2008)."""
    n = np.asarray(n, np.float64)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _grow(pdf: pd.DataFrame, sample: int, seed: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["h", "row"]).head(sample)
    model, tree = pdf["model"].iloc[0], int(pdf["tree"].iloc[0])
    x = np.array(pdf["x"].tolist(), np.float64)
    rng = np.random.default_rng([seed, tree, *model.encode()])
    limit = math.ceil(math.log2(max(2, len(x))))
    nodes: list[list] = []  # (feature, cut, left, right, path length of those that end here)
    todo = [(np.arange(len(x)), 0, -1, False)]
    while todo:
        rows, depth, parent, on_right = todo.pop()
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + float(average_path(len(rows)))])
        if parent >= 0:
            nodes[parent][3 if on_right else 2] = me
        if depth >= limit or len(rows) < 2:
            continue
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        able = np.flatnonzero(high > low)
        if not len(able):
            continue
        f = int(rng.choice(able))
        cut = float(rng.uniform(low[f], high[f]))
        goes = x[rows, f] <= cut
        nodes[me][:2] = [f, cut]
        todo += [(rows[~goes], depth + 1, me, True), (rows[goes], depth + 1, me, False)]
    cols = list(zip(*nodes, strict=True))
    return pd.DataFrame({"model": [model], "tree": [tree], "feature": [list(cols[0])], "cut": [list(cols[1])], "left": [list(cols[2])], "right": [list(cols[3])], "depth": [list(cols[4])], "psi": [len(x)]})


def _grown(x: np.ndarray, trees: int, sample: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """All trees of one model's rows, level by level side by side: flat arrays of nodes ordered by tree, and their ``sizes``.

    A node tries features at random until one varies among its rows, which is a uniform choice among those that do; where
    three tries fail, all features are looked at.
    """
    n, p = x.shape
    psi = min(n, sample)
    rows = np.tile(np.arange(n), trees) if n <= sample else np.concatenate([rng.choice(n, psi, replace=False) for _ in range(trees)])
    limit, counts, tree = math.ceil(math.log2(max(2, psi))), np.full(trees, psi), np.arange(trees)
    levels, begun = [], 0  # (tree, feature, cut, left, depth) of each level's nodes; nodes are numbered as they begin
    for depth in range(limit + 1):
        m, starts = len(counts), np.cumsum(counts) - counts
        feature, cut, left = np.full(m, -1), np.zeros(m), np.full(m, -1)
        levels.append((tree, feature, cut, left, depth + average_path(counts)))
        begun += m
        todo = np.flatnonzero(counts > 1) if depth < limit and p else np.zeros(0, np.int64)
        low, high = np.zeros(m), np.zeros(m)
        for attempt in range(4):
            if not len(todo):
                break
            c = counts[todo]
            first = np.cumsum(c) - c
            own = rows[np.repeat(starts[todo] - first, c) + np.arange(c.sum())]
            if attempt < 3:
                f = rng.integers(p, size=len(todo))
                v = x[own, np.repeat(f, c)]
                lo, hi = np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)
            else:
                los, his = (g.reduceat(x[own], first, axis=0) for g in (np.minimum, np.maximum))
                able = his > los
                nth = np.floor(rng.random(len(todo)) * able.sum(axis=1)) + 1
                f = np.argmax(np.cumsum(able, axis=1) == nth[:, None], axis=1)
                lo, hi = los[np.arange(len(todo)), f], his[np.arange(len(todo)), f]
            good = hi > lo
            at = todo[good]
            feature[at], low[at], high[at] = f[good], lo[good], hi[good]
            todo = todo[~good]
        at = np.flatnonzero(feature >= 0)
        if not len(at):
            break
        u = low[at] + rng.random(len(at)) * (high[at] - low[at])
        cut[at] = np.where(u < high[at], u, low[at])
        left[at] = begun + 2 * np.arange(len(at))
        c = counts[at]
        own = rows[np.repeat(starts[at] - (np.cumsum(c) - c), c) + np.arange(c.sum())]
        node = np.repeat(np.arange(len(at)), c)
        side = 2 * node + (x[own, feature[at][node]] > cut[at][node])
        rows, counts, tree = own[np.argsort(side, kind="stable")], np.bincount(side, minlength=2 * len(at)), np.repeat(tree[at], 2)
    tree, feature, cut, left, ends = (np.concatenate(v) for v in zip(*levels, strict=True))
    order = np.argsort(tree, kind="stable")
    sizes = np.bincount(tree, minlength=trees)
    place = np.empty(len(tree), np.int64)  # of each node in its tree
    place[order] = np.arange(len(tree)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = left[order]
    child = lambda k: np.where(left < 0, -1, place[np.where(left < 0, 0, left + k)])
    return {"sizes": sizes, "feature": feature[order], "cut": cut[order], "left": child(0), "right": child(1), "depth": ends[order], "psi": np.full(trees, psi)}


def fit_forest(x: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED, counted: DataFrame | None = None, scaler: DataFrame | None = None) -> DataFrame:
    """One row a tree, or for a model of up to SMALL rows one row with those, from which ``_Forest`` grows its trees.
    scaler: rows are not standardised yet; only those that trees grow from will be."""
    n = stored((x if counted is None else counted).groupBy("model").agg(F.count("*").alias("n")), "rows")
    least, most = n.agg(F.min("n"), F.max("n")).first()
    of = lambda keep: x.join(n.where(keep).select("model"), "model", "left_semi") if least <= SMALL < most else x
    kinds = [F.lit(None).cast(t).alias(c) for c, t in (v.split(" ") for v in _TREE.split(", ")[1:])]
    none = F.lit(None).cast(_GROWS.removeprefix("grows ")).alias("grows")
    if most is None or most <= SMALL:
        large = None
    else:
        large = _fit_drawn(of(F.col("n") > SMALL), n, trees, sample, seed, scaler).select("*", none)
    if least is not None and least > SMALL:
        return large
    ready = (lambda d: listed(d)) if scaler is None else (lambda d: standardised(d, scaler))
    row = _row(x)
    held = F.transform(F.array_sort(F.collect_list(F.struct(row.alias("row"), "x"))), lambda r: r["x"])  # one order of the rows
    small = ready(of(F.col("n") <= SMALL)).groupBy("model").agg(held.alias("rows")).select(F.col("model").alias("model"), *kinds, F.struct(F.lit(trees).alias("trees"), F.lit(sample).alias("sample"), F.lit(seed).cast("long").alias("seed"), "rows").alias("grows"))
    return small if large is None else large.unionByName(small)


def _row(x: DataFrame) -> Column:
    """A hash that names a row: by its metadata, since the last bits of what is standardised depend on how rows are dealt."""
    return F.xxhash64(*[c for c in x.columns if c in META] or ["x"])


def _fit_drawn(x: DataFrame, n: DataFrame, trees: int, sample: int, seed: int, scaler: DataFrame | None = None) -> DataFrame:
    """One row a tree. Only drawn rows are standardised and shuffled; trees grow in groups.

    Trees are dealt into groups whose shares of the rows add up to one at most. One hash of (row, group) falls into one
    tree's interval or none, so a row costs about as many hashes as it is drawn times.
    """
    row = _row(x)
    share = F.least(F.lit(1.0), (1.4 * sample + 24) / F.col("n"))
    draw = x.withColumn("row", row).join(n.select("model", share.alias("share"), F.floor(1 / share).cast("int").alias("together")), "model")
    groups = F.sequence(F.lit(0), F.ceil(F.lit(trees) / F.col("together")).cast("int") - 1)
    unit = lambda *c: F.pmod(F.xxhash64(*c, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    place = lambda g: F.floor(unit(F.col("row"), g) / F.col("share")).cast("int")
    picks = F.transform(groups, lambda g: F.when(place(g) < F.col("together"), g * F.col("together") + place(g)))
    hits = F.filter(picks, lambda t: t.isNotNull() & (t < trees))
    drawn = draw.select("model", "x", "row", F.explode(hits).alias("tree")).withColumn("h", F.xxhash64("row", "tree", F.lit(seed)))
    drawn = listed(drawn) if scaler is None else standardised(drawn, scaler)
    return drawn.groupBy("model", "tree").applyInPandas(lambda pdf: _grow(pdf, sample, seed), _TREE)


class _Forest:
    """Trees side by side in flat arrays: an end leads to itself, so all trees take the same number of steps."""

    def __init__(self, trees: pa.Table):
        grows = trees["grows"][0].as_py() if "grows" in trees.column_names else None
        if grows:
            rng = np.random.default_rng([grows["seed"], *(trees["model"][0].as_py() or "").encode()])
            nodes = _grown(np.array(grows["rows"], np.float64), grows["trees"], grows["sample"], rng)
            sizes, psi = nodes["sizes"], nodes["psi"]
            flat = lambda c, kind: nodes[c].astype(kind)
        else:
            trees = trees.sort_by("tree").combine_chunks()  # one order of adding up
            flat = lambda c, kind: trees[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
            sizes, psi = pc.list_value_length(trees["feature"]).to_numpy(), trees["psi"].to_numpy()
        self.roots = np.cumsum([0, *sizes[:-1]]).astype(np.int32)
        base, feature = np.repeat(self.roots, sizes), flat("feature", np.int32)
        own, ends = np.arange(len(feature), dtype=np.int32), feature < 0
        self.feature, self.cut, self.depth = np.where(ends, 0, feature), np.where(ends, np.inf, flat("cut", np.float64)), flat("depth", np.float64)
        self.next = np.stack([np.where(ends, own, base + flat("left", np.int32)), np.where(ends, own, base + flat("right", np.int32))], axis=1).ravel()
        self.steps = max(1, math.ceil(math.log2(max(2, int(psi.max())))))
        self.norm = max(float(average_path(float(psi.mean()))), 1e-9)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """2^(-E[path length] / c(psi))."""
        out, n, p = np.zeros(len(x)), len(self.roots), x.shape[1]
        for a in range(0, len(x), 256):
            part = np.ascontiguousarray(x[a : a + 256])
            start = (np.arange(len(part), dtype=np.int32) * np.int32(p))[:, None]
            node = np.broadcast_to(self.roots, (len(part), n)).copy()
            for _ in range(self.steps):
                goes = part.ravel().take(start + self.feature.take(node)) > self.cut.take(node)
                node = self.next.take(2 * node + goes)
            out[a : a + 256] = self.depth.take(node).sum(axis=1)
        return 2.0 ** (-(out / n) / self.norm)


def scored(x: DataFrame, fitted: DataFrame, score: Callable[[np.ndarray, pa.Table], np.ndarray], out: str, rows: int = 20_000) -> DataFrame:
    """Replace x by ``out``, what ``score(rows of x as a matrix, the model's rows of ``fitted``)`` gives.

    Rows of a model are dealt into blocks that each meet a copy of what was fitted, so a model with most of the rows is no
    one task and nothing is broadcast. Rows of models that were not fitted go.
    """
    # Written, so that its size is known: of few models it is broadcast, and no model's rows meet in one task for it.
    n = stored(x.groupBy("model").agg(F.ceil(F.count("*") / rows).cast("int").alias("blocks")), "blocks")
    left = x.join(n, "model").withColumn("block", F.pmod(F.xxhash64("x", *[c for c in x.columns if c in META]), F.col("blocks")).cast("int")).drop("blocks")
    right = fitted.join(n, "model").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    names = [c for c in x.columns if c != "x"]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            a = a.slice(0, 0)
        got = score(arrays.matrix(a["x"].combine_chunks()), b) if a.num_rows else np.zeros(0)
        return a.select(names).append_column(out, pa.array(got, pa.float64()))

    schema = ", ".join(f"`{c}` {dict(x.dtypes)[c]}" for c in names) + f", {out} double"
    return left.groupBy("model", "block").cogroup(right.groupBy("model", "block")).applyInArrow(run, schema)


def score_forest(x: DataFrame, forest: DataFrame, rows: int = 20_000) -> DataFrame:
    """Add raw = 2^(-E[depth] / c(psi))."""
    return scored(x, forest, lambda m, trees: _Forest(trees).raw(m), "raw", rows)


def fit_scaler(train: DataFrame, features: list[str], keys: tuple[str, ...]) -> DataFrame:
    """The scaler that every detector of these rows uses, written."""
    return stored(fit_preprocessor(rows_of(train, features, keys), vectors(train, [], keys)), "scaler")


def fit_isolation_forest(train: DataFrame, features: list[str], keys: tuple[str, ...] = (), trees: int = TREES, sample: int = SAMPLE, contamination: float = CONTAMINATION, scaler: DataFrame | None = None) -> Fitted:
    """Scores are positive beyond the training share ``contamination``. scaler: what ``fit_scaler`` gave for the same rows."""
    x, counted = rows_of(train, features, keys), vectors(train, [], keys)
    scaler = fit_scaler(train, features, keys) if scaler is None else scaler
    forest = stored(fit_forest(x, trees, sample, counted=counted, scaler=scaler), "trees")
    offset = stats.exact_percentiles(_raw(x, scaler, forest), ["model"], "raw", {"offset": 1 - contamination}, keep=True)
    return Fitted("isolation_forest", features, keys, {}, {"scaler": scaler, "trees": forest, "offset": stored(offset, "offset")})


def _raw(x: DataFrame, scaler: DataFrame, forest: DataFrame) -> DataFrame:
    """``score_forest`` of rows that are not standardised yet."""
    scalers = _scalers(scaler)
    trees = sent(forest, "feature") if scalers else None
    if not trees:
        return score_forest(preprocessed(listed(x), scaler), forest)
    return scored_in_tasks(x, scalers, trees, lambda t: _Forest(t).raw, "raw")


def _score_forest(f: Fitted, rows: DataFrame) -> DataFrame:
    out = _raw(rows_of(rows, f.features, f.keys), f.tables["scaler"], f.tables["trees"]).join(f.tables["offset"], "model")
    return out.withColumn("score", F.col("raw") - F.col("offset")).drop("raw", "offset")


def isolation_forest(train: DataFrame, rows: DataFrame, features: list[str], keys: tuple[str, ...] = (), **options) -> DataFrame:
    return fit_isolation_forest(train, features, keys, **options).score(rows)


def _principal(z: DataFrame, size: int, counted: DataFrame | None = None, scaler: DataFrame | None = None, steps: int = 1) -> DataFrame:
    """(model, w): the leading directions of each model's second moments, of the last ``steps`` vectors of the episode.
    scaler: rows are not standardised yet.

    Products are summed by task and model; a task that holds many models sends what it has when it holds enough. Rows of the
    matrices, a few of a model together, are added before one task of each model, which the features bound, decomposes.
    """
    kind = "model string, n long, stripe int, g array<array<double>>"
    table = lambda model, n, stripe, g: pa.table({"model": pa.array([model], pa.string()), "n": pa.array([n], pa.int64()), "stripe": pa.array([stripe], pa.int32()), "g": pa.array([g.tolist()], pa.list_(pa.list_(pa.float64())))})
    array = lambda v: np.array(v.as_py(), np.float64)

    def sent(sums: dict) -> Iterator[pa.RecordBatch]:
        for m, (n, g) in sums.items():
            for k in range(0, len(g), arrays.STRIPE):
                yield from table(m, n, k // arrays.STRIPE, g[k : k + arrays.STRIPE]).to_batches()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for m, x in by_model(batches):
            s = sums.setdefault(m, [0, 0.0])
            s[0] += len(x)
            s[1] = s[1] + x.T @ x
            if len(sums) * s[1].nbytes > arrays.HELD:
                yield from sent(sums)
                sums = {}
        yield from sent(sums)

    def add(t: pa.Table) -> pa.Table:
        return table(t["model"][0].as_py(), sum(t["n"].to_pylist()), t["stripe"][0].as_py(), sum(array(g) for g in t["g"]))

    def directions(t: pa.Table) -> pa.Table:
        order = np.argsort(t["stripe"].to_numpy())
        g = np.concatenate([array(t["g"][int(k)]) for k in order]) / max(1, t["n"][0].as_py())
        value, vector = np.linalg.eigh((g + g.T) / 2)
        w = vector[:, np.argsort(-value, kind="stable")[:size]].T
        return pa.table({"model": pa.array([t["model"][0].as_py()], pa.string()), "w": pa.array([w.tolist()], pa.list_(pa.list_(pa.float64())))})

    def whole(t: pa.Table) -> pa.Table:
        x = arrays.matrix(t["x"].combine_chunks())
        return directions(table(t["model"][0].as_py(), len(x), 0, x.T @ x))

    small = all_small(z if counted is None else counted)
    scalers = None if scaler is None or small else _scalers(scaler)
    if scalers:  # standardised and put together by the tasks that add up
        by_model = lambda batches: _by_model_in_order(batches, read, scalers, steps)
        rows, read = _in_order(z) if steps > 1 else z.select("model", "x"), arrays.reader(z)
    else:
        rows, by_model = listed(z) if scaler is None else standardised(z, scaler), arrays.by_model
        rows = (_sequenced(rows, steps) if steps > 1 else rows).select("model", "x")
    if small:
        return rows.groupBy("model").applyInArrow(whole, "model string, w array<array<double>>")
    parts = rows.mapInArrow(partial, kind)
    return parts.groupBy("model", "stripe").applyInArrow(add, kind).groupBy("model").applyInArrow(directions, "model string, w array<array<double>>")


def _by_model_in_order(batches: Iterator[pa.RecordBatch], read: Callable[[pa.Array], np.ndarray], scalers: dict[str, tuple], steps: int) -> Iterator[tuple[str, np.ndarray]]:
    """(model, rows standardised, each with the ``steps`` - 1 before it) of batches, which come in the order of the episodes
    where steps are more than one; models that were not fitted are left out."""
    last = _Last(steps)
    for batch in batches:
        if not batch.num_rows:
            continue
        x, own = read(batch.column("x")), []
        z = np.zeros_like(x)
        for m, at, s in _standardised(batch.column("model"), x, scalers):
            z[at] = s
            own.append((m, at))
        seen, most = last.add(batch, z), max(1, PIECE // max(1, steps * x.shape[1]))
        for m, at in own:
            for a in range(0, len(at), most):
                yield m, seen(at[a : a + most])


def residuals(x: np.ndarray, w: np.ndarray, last: int | None = None, chunk: int = 2048) -> np.ndarray:
    """Mean squared distance of the rows of x from their projections on the rows of w, over all or the last ``last``
    positions: two matrix products a chunk, so the cost is rows times positions times directions."""
    keep = slice(x.shape[1] - (last or x.shape[1]), None)
    out = np.empty(len(x))
    for a in range(0, len(x), chunk):
        part = x[a : a + chunk]
        out[a : a + chunk] = ((part[:, keep] - (part @ w.T) @ w[:, keep]) ** 2).mean(axis=1)
    return out


def _sequenced(z: DataFrame, steps: int) -> DataFrame:
    """x as the last ``steps`` vectors of the episode, its first one repeated in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = _Last(steps)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = arrays.matrix(batch.column("x"))
            seen, most = last.add(batch, x), max(1, PIECE // max(1, steps * x.shape[1]))
            for a in range(0, len(x), most):
                part = batch.slice(a, most)
                yield _with(part, "x", arrays.nested(seen(np.arange(a, a + part.num_rows))))

    rows = z.select(*[c for c in z.columns if c != "x"], "x")
    return _in_order(rows).mapInArrow(run, rows.schema)


def _fit_autoencoder(kind: str, train: DataFrame, features: list[str], keys: tuple[str, ...], steps: int, size: int | None, scaler: DataFrame | None = None) -> Fitted:
    x, counted = rows_of(train, features, keys), vectors(train, [], keys)
    scaler = fit_scaler(train, features, keys) if scaler is None else scaler
    p = steps * len(features)
    w = _principal(x, size or min(p, max(8, p // 4)), counted, scaler, steps)
    return Fitted(kind, features, keys, {"steps": steps}, {"scaler": scaler, "directions": stored(w, "directions")})


def fit_linear_autoencoder(train: DataFrame, features: list[str], keys: tuple[str, ...] = (), size: int | None = None, scaler: DataFrame | None = None) -> Fitted:
    """Score: mean squared reconstruction error from max(8, p/4) principal directions."""
    return _fit_autoencoder("linear_autoencoder", train, features, keys, 1, size, scaler)


def fit_sequence_autoencoder(train: DataFrame, features: list[str], keys: tuple[str, ...] = (), steps: int = 6, size: int | None = None, scaler: DataFrame | None = None) -> Fitted:
    """The same on the last ``steps`` standardised vectors; the error is that of the last one."""
    return _fit_autoencoder("sequence_autoencoder", train, features, keys, steps, size, scaler)


def _score_autoencoder(f: Fitted, rows: DataFrame) -> DataFrame:
    x, steps = rows_of(rows, f.features, f.keys), f.options["steps"]
    last = len(f.features) if steps > 1 else None
    scalers = _scalers(f.tables["scaler"])
    found = sent(f.tables["directions"], "w") if scalers else None
    way = lambda t: arrays.matrix(t["w"].combine_chunks().flatten())
    if found:

        def ready(t: pa.Table) -> Callable[[np.ndarray], np.ndarray]:
            w = way(t)
            return lambda x: residuals(x, w, last)

        return scored_in_tasks(x, scalers, found, ready, "score", steps)
    z = preprocessed(listed(x), f.tables["scaler"])
    z = _sequenced(z, steps) if steps > 1 else z
    return scored(z, f.tables["directions"], lambda x, fitted: residuals(x, way(fitted), last), "score")


def linear_autoencoder(train: DataFrame, rows: DataFrame, features: list[str], keys: tuple[str, ...] = (), **options) -> DataFrame:
    return fit_linear_autoencoder(train, features, keys, **options).score(rows)


def sequence_autoencoder(train: DataFrame, rows: DataFrame, features: list[str], keys: tuple[str, ...] = (), **options) -> DataFrame:
    return fit_sequence_autoencoder(train, features, keys, **options).score(rows)


@dataclass
class Local:
    """One fitted model as arrays, for tasks that score few rows at a time."""

    features: list[str]
    median: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    directions: np.ndarray | None = None
    forest: _Forest | None = None
    offset: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of ``features``, missing ones as NaN."""
        z = (np.where(np.isnan(x), self.median, x) - self.mean) / self.std
        return residuals(z, self.directions) if self.forest is None else self.forest.raw(z) - self.offset


def local(fitted: Fitted, most: int = 1000) -> dict[str, Local]:
    """Model name -> ``Local`` of a fitted forest or linear autoencoder; more than ``most`` models are an error."""
    if fitted.kind == "sequence_autoencoder":
        raise ValueError("a sequence detector scores sequences, not single rows")
    scaler = fitted.tables["scaler"].limit(most + 1).collect()
    if len(scaler) > most:
        raise ValueError(f"more than {most} models")
    array = lambda v: np.array(v, np.float64)
    out = {r["model"]: Local(fitted.features, array(r["median"]), array(r["mean"]), array(r["std"])) for r in scaler}
    if fitted.kind == "linear_autoencoder":
        for r in fitted.tables["directions"].collect():
            out[r["model"]].directions = array(r["w"])
        return {m: v for m, v in out.items() if v.directions is not None}
    trees = fitted.tables["trees"].toArrow()
    offsets = {r["model"]: r["offset"] for r in fitted.tables["offset"].collect()}
    for m in pc.unique(trees["model"]).to_pylist():
        out[m].forest, out[m].offset = _Forest(trees.filter(pc.equal(trees["model"], m))), offsets[m]
    return {m: v for m, v in out.items() if v.forest is not None}


DETECTORS = {"isolation_forest": fit_isolation_forest, "linear_autoencoder": fit_linear_autoencoder, "sequence_autoencoder": fit_sequence_autoencoder}
SCORERS = {"isolation_forest": _score_forest, "linear_autoencoder": _score_autoencoder, "sequence_autoencoder": _score_autoencoder}
