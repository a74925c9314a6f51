"""Aggregations: references, baselines, drift and selection statistics. All partial sums combine before the shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.functions.columns import EPS, fingerprint, training_normal, wind_bin
from vanewright.operators import gramian, vectors
from vanewright.session import stored


#: Values up to which a group is sorted whole.
FEW = 5120


def power_curve(df: DataFrame, power: str = "power", wind: str = "wind_speed", width: float = 0.5, keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """(keys, wind_bin, expected_power, n): median power by wind bin over normal training rows."""
    rows = df.where(training_normal() & F.col(power).isNotNull()).withColumn("wind_bin", wind_bin(wind, width)).where("wind_bin is not null")
    return rows.groupBy(*keys, "wind_bin").agg(F.median(power).alias("expected_power"), F.count("*").alias("n"))


def curve_edges(df: DataFrame, power: str = "power", wind: str = "wind_speed", least: int = 20, keys: tuple[str, ...] = ("farm_id", "asset_id")) -> DataFrame:
    """(keys, n_rows, max_wind, too_few) of the rows that a curve is fitted to."""
    rows = df.where(training_normal() & F.col(power).isNotNull() & F.col(wind).isNotNull())
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.max(wind).alias("max_wind")).withColumn("too_few", F.col("n_rows") < least)


def baseline(t: DataFrame) -> DataFrame:
    """(farm_id, asset_id, sensor, mean, std) of tall readings; a deviation of nearly 0 or NULL is 1."""
    out = t.groupBy("farm_id", "asset_id", "sensor").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return out.where("mean is not null").withColumn("std", F.when(F.col("std") > 1e-9, F.col("std")).otherwise(1.0))


def missing(t: DataFrame, *keys: str) -> DataFrame:
    """(keys, sensor, missing_fraction) of tall readings."""
    return t.groupBy(*keys, "sensor").agg(F.avg(F.isnull("value").cast("double")).alias("missing_fraction"))


def variances(t: DataFrame, *keys: str) -> DataFrame:
    return t.groupBy(*keys, "sensor").agg(F.var_samp("value").alias("variance"))


def preprocessor(t: DataFrame, *keys: str) -> DataFrame:
    """(keys, sensor, median, mean, std) after imputing the median; population deviation, 0 as 1; sensors without any
    value are left out. The mean and deviation after imputation follow from sums, so one pass does."""
    middle = exact_percentiles(t, [*keys, "sensor"], "value", {"median": 0.5})
    s = t.groupBy(*keys, "sensor").agg(F.count("value").alias("n"), F.count("*").alias("total"), F.avg("value").alias("m"), F.var_pop("value").alias("v")).where("n > 0").join(middle, [*keys, "sensor"])
    gap = (F.col("total") - F.col("n")) / F.col("total")
    mean = (1 - gap) * F.col("m") + gap * F.col("median")
    var = (1 - gap) * (F.col("v") + (F.col("m") - mean) ** 2) + gap * (F.col("median") - mean) ** 2
    return s.select(*keys, "sensor", "median", mean.alias("mean"), F.when(F.sqrt(var) > 0, F.sqrt(var)).otherwise(1.0).alias("std"))


def correlations(df: DataFrame, columns: list[str], means: dict[str, float] | None = None, above: float | None = None, tile: int = gramian.TILE, make: gramian.Make | None = None) -> DataFrame:
    """(a, b, r) for a before b: absolute pairwise-complete Pearson; NULL where one side does not vary, up to rounding; with
    ``above`` only larger ones. See ``gramian``: one form for any number of columns.

    Values are centred by ``means`` (by default one more pass finds them), so that a large offset costs no digits. make: the
    columns are made of the table's in the tasks, see ``gramian.read``, once: they are centred by numbers near them.
    """
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    centre = gramian.near(df, columns, make) if make and means is None else None
    if centre is None:
        means = {r["feature"]: r["mean"] for r in moments(df, columns, make).collect()} if means is None else means
        centre = np.array([means.get(c) or 0.0 for c in columns])
    return gramian.correlated(gramian.pair_sums(df, columns, centre, tile, make), columns, centre, tile, above)


def moments(df: DataFrame, columns: list[str], make: gramian.Make | None = None) -> DataFrame:
    """(feature, missing_fraction, mean, variance) of many columns: counts, means and squared deviations by task, then merged."""
    rows, matrices = gramian.read(df, columns, make)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(columns))
        total, mean, dev = n.copy(), n.copy(), n.copy()
        for x in (x for batch in batches for x in matrices(batch)):
            ok = ~np.isnan(x)
            k = ok.sum(axis=1)
            total += x.shape[1]
            own = np.where(ok, x, 0.0).sum(axis=1) / np.maximum(k, 1)
            d = (np.where(ok, x - own[:, None], 0.0) ** 2).sum(axis=1)
            step = own - mean
            both = np.maximum(n + k, 1)
            dev += d + step**2 * n * k / both
            mean += step * k / both
            n += k
        if total.any():
            yield pa.RecordBatch.from_pydict({"feature": columns, "n": n, "total": total, "mean": mean, "dev": dev})

    parts = rows.mapInArrow(partial, "feature string, n double, total double, mean double, dev double")
    parts = stored(parts, "moments")  # a row a task and column; read twice
    grand = parts.groupBy("feature").agg(F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("grand"))
    whole = parts.join(grand, "feature").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.first("grand").alias("mean"), F.sum(F.col("dev") + F.col("n") * F.pow(F.col("mean") - F.col("grand"), F.lit(2))).alias("dev")
    )
    return whole.select("feature", (1 - F.col("n") / F.col("total")).alias("missing_fraction"), "mean", F.when(F.col("n") > 1, F.col("dev") / (F.col("n") - 1)).alias("variance"))


def asset_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("farm_id", "asset_id").agg(F.count("*").alias("n_rows"), F.array_join(F.sort_array(F.collect_set(F.col("dataset_id").cast("string"))), ",").alias("datasets"))


def date_ranges(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min("time_stamp").alias("first_ts"), F.max("time_stamp").alias("last_ts"), F.count("*").alias("n_rows"))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def summary(t: DataFrame, *keys: str) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum of each sensor."""
    ks = [*keys, "sensor"]
    s = t.groupBy(*ks).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_percentiles(t, ks, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return s.join(q, ks, "left").select(*ks, "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def threshold(scores: DataFrame, keys: Iterable[str], score: str = "score", percentile: float = 0.99) -> DataFrame:
    """(keys, threshold): a percentile of validation scores, linear between ranks; NULL scores are left out."""
    return exact_percentiles(scores, keys, score, {"threshold": percentile}, keep=True)


def exact_percentiles(t: DataFrame, keys: Iterable[str], value: str, shares: dict[str, float], keep: bool = False) -> DataFrame:
    """(keys, a column a share): exact percentiles, linear between ranks, of groups of any size. NULL values are left out.

    Groups are sketched and bracketed, see ``vectors.percentiles``; keys of other types than text, whole numbers, booleans
    and dates, or more groups than that has room for, go by ``ranged_percentiles``. keep: write the values first, where
    computing them twice is dearer; where no group has more than FEW of them, each is then sorted whole.
    """
    ks = list(keys)
    rows = t.where(F.col(value).isNotNull()).select(*ks, F.col(value).cast("double").alias("_v"))
    rows = stored(rows, "values") if keep else rows
    if keep and (rows.groupBy(*ks).count().agg(F.max("count")).first()[0] or 0) <= FEW:
        v, at = F.sort_array("_all"), lambda share: F.lit(share) * (F.size("_all") - 1)
        nth = lambda k: F.element_at(v, k.cast("int") + 1)
        one = lambda a: nth(F.floor(a)) + (nth(F.ceil(a)) - nth(F.floor(a))) * (a - F.floor(a))
        return rows.groupBy(*ks).agg(F.collect_list("_v").alias("_all")).select(*ks, *[F.when(F.size("_all") > 0, one(at(s))).alias(name) for name, s in shares.items()])
    plain = all(isinstance(rows.schema[k].dataType, (T.StringType, T.IntegralType, T.BooleanType, T.DateType)) for k in ks)
    model = F.to_json(F.struct(*ks)) if ks else F.lit("{}")
    found = vectors.percentiles(rows.select(model.alias("model"), F.array("_v").alias("x")), list(shares.values())) if plain else None
    if found is None:
        return ranged_percentiles(rows, ks, "_v", shares)
    out = found[1].groupBy("model").agg(*[F.max(F.when(F.col("share") == k, F.col("value"))).alias(name) for k, name in enumerate(shares)])
    if not ks:
        return out.select(*shares)
    kinds = T.StructType([T.StructField(k, rows.schema[k].dataType) for k in ks])
    return out.select(F.from_json("model", kinds).alias("k"), *shares).select("k.*", *shares)


def ranged_percentiles(t: DataFrame, keys: Iterable[str], value: str, shares: dict[str, float]) -> DataFrame:
    """The same for any number of groups.

    Values are counted by (key, value) and range-partitioned by both; sums by partition give each partition's first rank,
    so the two values beside a wanted rank are found without bringing a group together. NULL values are left out.
    """
    from pyspark.sql import Window

    ks = list(keys)
    counts = t.where(F.col(value).isNotNull()).groupBy(*ks, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    parts = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(counts.repartitionByRange(parts, *ks, "_v").withColumn("_p", F.spark_partition_id()), "percentiles")
    before = Window.partitionBy(*ks).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*ks, "_p").agg(F.sum("_n").alias("_s")).withColumns({"_start": F.coalesce(F.sum("_s").over(before), F.lit(0)), "_all": F.sum("_s").over(Window.partitionBy(*ks))})
    upto = Window.partitionBy(*ks, "_p").orderBy("_v")
    rows = placed.join(sums, [*ks, "_p"]).withColumn("_end", F.col("_start") + F.sum("_n").over(upto)).withColumn("_begin", F.col("_end") - F.col("_n"))
    out = []
    for name, share in shares.items():
        at = F.lit(share) * (F.col("_all") - 1)
        low, high = F.floor(at), F.ceil(at)
        has = lambda r: (F.col("_begin") <= r) & (r < F.col("_end"))
        a, b = F.max(F.when(has(low), F.col("_v"))), F.max(F.when(has(high), F.col("_v")))
        out.append((a + (b - a) * (F.max(at) - F.max(low))).alias(name))
    return rows.groupBy(*ks).agg(*out)


def histogram(t: DataFrame, bounds: DataFrame, bins: int = 10, keys: tuple[str, ...] = ("sensor",)) -> DataFrame:
    """(keys, bin, n): equal-width bins from 1, the last one closed. bounds: (keys, lo, hi)."""
    rows = t.where("value is not null").join(bounds, list(keys)).where("hi > lo")
    b = F.least(F.floor((F.col("value") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)) + 1, F.lit(bins)).cast("int")
    return rows.groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"))


def psi(reference: DataFrame, current: DataFrame, bins: int = 10, keys: tuple[str, ...] = ("sensor",)) -> DataFrame:
    """(keys, psi) of tall tables: both are binned on their joint range, shares are at least 1e-4; features in both only;
    0 where the joint range is a point."""
    ks = list(keys)
    ends = lambda d: d.where("value is not null").groupBy(*ks).agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))
    r, c = ends(reference), ends(current)
    both = r.select(*ks, F.col("lo").alias("a"), F.col("hi").alias("b"), F.col("n").alias("nr")).join(c.select(*ks, F.col("lo").alias("c"), F.col("hi").alias("d"), F.col("n").alias("nc")), ks)
    both = both.select(*ks, F.least("a", "c").alias("lo"), F.greatest("b", "d").alias("hi"), "nr", "nc")
    hr = histogram(reference, both.select(*ks, "lo", "hi"), bins, keys).withColumnRenamed("n", "r")
    hc = histogram(current, both.select(*ks, "lo", "hi"), bins, keys).withColumnRenamed("n", "c")
    spine = both.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    cells = spine.join(hr, [*ks, "bin"], "left").join(hc, [*ks, "bin"], "left")
    pr = F.greatest(F.coalesce(F.col("r") / F.col("nr"), F.lit(0.0)), F.lit(EPS))
    pc = F.greatest(F.coalesce(F.col("c") / F.col("nc"), F.lit(0.0)), F.lit(EPS))
    return cells.groupBy(*ks).agg(F.sum(F.when(F.col("hi") > F.col("lo"), (pc - pr) * F.log(pc / pr)).otherwise(0.0)).alias("psi"))


def ks_distance(reference: DataFrame, current: DataFrame, keys: tuple[str, ...] = ("sensor",)) -> DataFrame:
    """(keys, ks): largest distance of the two empirical distributions. Values are range-partitioned by (key, value), and
    sums by partition give each partition's start, so a common sensor is no one task."""
    from pyspark.sql import Window

    ks = list(keys)
    both = reference.where("value is not null").select(*ks, "value", F.lit(1).alias("r")).union(current.where("value is not null").select(*ks, "value", F.lit(0).alias("r")))
    steps = both.groupBy(*ks, "value").agg(F.sum("r").alias("r"), F.sum(1 - F.col("r")).alias("c"))
    parts = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(steps.repartitionByRange(parts, *ks, "value").withColumn("_p", F.spark_partition_id()), "distances")
    before = Window.partitionBy(*ks).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*ks)
    sums = placed.groupBy(*ks, "_p").agg(F.sum("r").alias("_r"), F.sum("c").alias("_c"))
    sums = sums.select(*ks, "_p", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in ("_r", "_c")], *[F.sum(x).over(every).alias(f"{x}1") for x in ("_r", "_c")])
    upto = Window.partitionBy(*ks, "_p").orderBy("value")
    rows = placed.join(sums, [*ks, "_p"])
    d = F.abs((F.col("_r0") + F.sum("r").over(upto)) / F.col("_r1") - (F.col("_c0") + F.sum("c").over(upto)) / F.col("_c1"))
    return rows.select(*ks, d.alias("d")).groupBy(*ks).agg(F.max("d").alias("ks"))


def drifted(psis: DataFrame, most: float = 0.2) -> DataFrame:
    return psis.where(F.col("psi") > most)


def retrain(psis: DataFrame, age_days: float | Column, most: float = 0.2, oldest: float = 30) -> DataFrame:
    """One row: n_drifted, should_retrain."""
    age = age_days if isinstance(age_days, Column) else F.lit(age_days)
    return psis.agg(F.count_if(F.col("psi") > most).alias("n_drifted"), (F.coalesce(F.bool_or(F.col("psi") > most), F.lit(False)) | (F.first(age) > oldest)).alias("should_retrain"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """One row: n_duplicates, all rows whose (time, asset) occurs more than once."""
    return df.groupBy(*(keys or ("time_stamp", "asset_id"))).agg(F.count("*").alias("n")).where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_duplicates"))


def unexpected(df: DataFrame, column: str, allowed: Iterable, *keys: str) -> DataFrame:
    """(keys, unexpected): distinct values outside the allowed set, sorted."""
    return df.groupBy(*keys).agg(F.sort_array(F.array_except(F.collect_set(column), F.array(*map(F.lit, allowed)))).alias("unexpected"))


def schema_fingerprint(features: DataFrame, name: str = "feature", *keys: str) -> DataFrame:
    return features.groupBy(*keys).agg(fingerprint(F.collect_set(name)).alias("schema_sha256"))


def guarded(df: DataFrame, least: int, what: str = "rows") -> DataFrame:
    """The same table, or an error when it has fewer than ``least`` rows."""
    n = df.limit(least).count()
    if n < least:
        raise ValueError(f"{n} {what}; at least {least} are needed")
    return df


def gate(registry: DataFrame, candidate: DataFrame) -> DataFrame:
    """(model, new, production, promoted): a new composite that is no lower than the last production version's."""
    prod = registry.groupBy("model").agg(F.max_by("composite", "version").alias("production"))
    return candidate.select("model", F.col("composite").alias("new")).join(prod, "model", "left").withColumn("promoted", F.col("production").isNull() | (F.col("new") >= F.col("production")))
