"""Event-level evaluation of flags, summaries and model comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewright.functions.columns import EPISODE, abnormal, fbeta, hours
from vanewright.operators.windows import episode, islands


def point_counts(df: DataFrame, truth: str = "truth", flag: str = "flag", keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """(keys, tp, fp, fn, tn)."""
    t, p = F.col(truth) == 1, F.col(flag) == 1
    return df.groupBy(*keys).agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))


def _events(df: DataFrame, keys: tuple[str, ...]) -> Column:
    """1 where a run of flags begins among the rows given."""
    return ((F.col("flag") == 1) & (F.coalesce(F.lag("flag").over(episode(*keys)), F.lit(0)) == 0)).cast("int")


def evaluate(flags: DataFrame, events: DataFrame, keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """One row an episode (and further keys): coverage, accuracy, reliability, earliness_hours, n_flagged_points, n_eval_points.

    flags: prediction rows with flag 0/1. events: keys of an episode, is_anomaly, onset (NULL where unknown). Only rows of
    normal status count, and runs are counted over what they leave; an episode without such rows counts runs over all its
    rows and has no coverage or accuracy. An episode without a record is a normal one.
    """
    known = events.select(*EPISODE, "is_anomaly", F.col("onset").cast("timestamp").alias("onset"))
    rows = flags.join(known, list(EPISODE), "left").withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))
    rows = rows.withColumn("ok", ~abnormal()).withColumn("ts", F.col("time_stamp").cast("timestamp"))
    some = F.max(F.col("ok").cast("int")).over(Window.partitionBy(*keys)) == 1
    rows = rows.withColumn("some", some).where(F.col("ok") | ~F.col("some")).withColumn("begins", _events(rows, keys))
    hit, before, ok = F.col("flag") == 1, F.col("ts") < F.col("onset"), F.col("ok")
    a = rows.groupBy(*keys).agg(
        F.first("is_anomaly").alias("is_anomaly"), F.first("onset").alias("onset"),
        F.count_if(ok).alias("n_eval_points"), F.count_if(ok & hit).alias("n_flagged_points"),
        F.count_if(ok & hit & before).alias("tp"), F.count_if(ok & hit & ~before).alias("fp"), F.count_if(ok & ~hit & before).alias("fn"),
        F.min(F.when(ok & hit, F.col("ts"))).alias("first_flag"), F.sum("begins").alias("n_events"),
    )
    n, flagged = F.col("n_eval_points"), F.col("n_flagged_points")
    anomaly, known = F.col("is_anomaly"), F.col("onset").isNotNull() & (n > 0)
    share = F.when(n > 0, flagged / n)
    found = F.least(F.col("n_events"), F.lit(1))
    return a.select(
        *keys, "is_anomaly",
        F.when(anomaly, F.when(known, fbeta(F.col("tp"), F.col("fp"), F.col("fn"))).otherwise(share)).alias("coverage"),
        F.when(~anomaly & (n > 0), (n - flagged) / n).alias("accuracy"),
        F.when(anomaly, fbeta(found, F.greatest(F.col("n_events") - 1, F.lit(0)), 1 - found)).alias("reliability"),
        F.when(anomaly & known, F.coalesce(F.greatest(hours("onset", "first_flag"), F.lit(0.0)), F.lit(0.0))).alias("earliness_hours"),
        "n_flagged_points", "n_eval_points",
    )


def _mean_of_known(parts: list[Column]) -> Column:
    known = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known))


def summarize(results: DataFrame, *keys: str) -> DataFrame:
    """Means over anomalous and normal episodes, and the composite of coverage, accuracy, reliability and earliness
    (capped at 48 hours; none counts as 0)."""
    mean = lambda c: F.avg(F.when(F.col("is_anomaly"), F.col(c)))
    s = results.groupBy(*keys).agg(
        F.count_if("is_anomaly").alias("n_anomaly_datasets"), F.count_if(~F.col("is_anomaly")).alias("n_normal_datasets"), mean("coverage").alias("mean_coverage"),
        mean("reliability").alias("mean_reliability"), mean("earliness_hours").alias("mean_earliness_hours"), F.avg(F.when(~F.col("is_anomaly"), F.col("accuracy"))).alias("mean_accuracy_on_normal"),
    )
    early = F.least(F.coalesce(F.col("mean_earliness_hours"), F.lit(0.0)) / 48.0, F.lit(1.0))
    return s.withColumn("composite", _mean_of_known([F.col("mean_coverage"), F.col("mean_accuracy_on_normal"), F.col("mean_reliability"), early]))


def run_composites(results: DataFrame) -> DataFrame:
    """Add composite to each result row: the mean of what it has, earliness capped at 48 hours."""
    early = F.least(F.col("earliness_hours") / 48.0, F.lit(1.0))
    return results.withColumn("composite", _mean_of_known([F.col("coverage"), F.col("accuracy"), F.col("reliability"), early]))


def compare_models(results: DataFrame) -> DataFrame:
    """(model, n, mean_composite) of results with a model column."""
    return run_composites(results).groupBy("model").agg(F.count("composite").alias("n"), F.avg("composite").alias("mean_composite"))


def detected_events(flags: DataFrame, score: str = "score", keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """(keys, event_id, start, end, duration_hours, peak_score, mean_score): one row a run of flags, at least 0.166 h."""
    runs = islands(flags, "flag", keys).where("flag = 1")
    out = runs.groupBy(*keys, "run_id").agg(F.min("time_stamp").alias("start"), F.max("time_stamp").alias("end"), F.max(score).alias("peak_score"), F.avg(score).alias("mean_score"))
    out = out.withColumn("duration_hours", F.greatest(hours("end", "start"), F.lit(0.166)))
    return out.withColumn("event_id", F.row_number().over(Window.partitionBy(*keys).orderBy("start"))).select(*keys, "event_id", "start", "end", "duration_hours", "peak_score", "mean_score")
