"""Drift of logged values from counts by day that add up: nothing that was counted is read again.

Bins are fixed by a reference: equal widths between its smallest and largest value, and one bin on either side for what
lies beyond. Counts by (key, day, bin) of any batches are summed, so a scan over any days reads sums, not values.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vanewright.functions.columns import EPS

BINS = 20
KEYS = ("farm_id", "sensor")


def edges(reference: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, lo, hi) of tall values; keys without a value are left out."""
    return reference.where("value is not null").groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def day_counts(values: DataFrame, ends: DataFrame, bins: int = BINS, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, day, bin, n): bins 1 to ``bins`` within the reference, the last one closed; 0 below and bins + 1 above.

    Keys that the reference lacks and NULL values are left out. A reference of one value has it in bin 1.
    """
    rows = values.where("value is not null").select(*keys, F.to_date(F.col("time_stamp").cast("timestamp")).alias("day"), "value").join(ends, list(keys))
    width = (F.col("hi") - F.col("lo")) / bins
    inner = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("value") - F.col("lo")) / width) + 1, F.lit(bins))).otherwise(1)
    at = F.when(F.col("value") < F.col("lo"), 0).when(F.col("value") > F.col("hi"), bins + 1).otherwise(inner)
    return rows.groupBy(*keys, "day", at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def log(counts: DataFrame, root: str, batch: int) -> None:
    """Keep the counts of one numbered batch; a batch that comes again takes its own place, so each counts once."""
    counts.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(root)


def logged(spark: SparkSession, root: str, kinds: str = "farm_id string, sensor string", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, day, bin, n) summed over all batches; nothing before the first."""
    schema = f"{kinds}, day date, bin int, n long, batch long"
    try:
        rows = spark.read.schema(schema).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    return rows.groupBy(*keys, "day", "bin").agg(F.sum("n").alias("n"))


def between(counts: DataFrame, reference: Column, current: Column, *by: str, bins: int = BINS, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, by, n_reference, n_current, psi, ks) of the days that two conditions choose; ``by`` (such as day) tells current
    periods apart. Shares are at least 1e-4 in the PSI; the KS distance is taken at the bins' edges. Keys on both sides only.
    """
    ks, own = list(keys), [*keys, *by]
    ref = counts.where(reference).groupBy(*ks, "bin").agg(F.sum("n").alias("r"))
    cur = counts.where(current).groupBy(*own, "bin").agg(F.sum("n").alias("c"))
    totals = cur.groupBy(*own).agg(F.sum("c").alias("n_current")).join(ref.groupBy(*ks).agg(F.sum("r").alias("n_reference")), ks)
    spine = totals.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins + 1))))
    cells = spine.join(ref, [*ks, "bin"], "left").join(cur, [*own, "bin"], "left")
    r, c = F.coalesce("r", F.lit(0)) / F.col("n_reference"), F.coalesce("c", F.lit(0)) / F.col("n_current")
    upto = Window.partitionBy(*own).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    shares = cells.select(*own, "n_reference", "n_current", r.alias("r"), c.alias("c"), F.abs(F.sum(r).over(upto) - F.sum(c).over(upto)).alias("gap"))
    pr, pc = F.greatest("r", F.lit(EPS)), F.greatest("c", F.lit(EPS))
    return shares.groupBy(*own).agg(F.first("n_reference").alias("n_reference"), F.first("n_current").alias("n_current"), F.sum((pc - pr) * F.log(pc / pr)).alias("psi"), F.max("gap").alias("ks"))
