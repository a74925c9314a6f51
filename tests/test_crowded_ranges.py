"""Ranges that all share time are dealt into parts on both sides, so that copies stay far below the pairs."""

from pyspark.sql import functions as F

from vanewright.operators import joins


def crowded(spark, n):
    """Two assets, of each of which all ranges share time."""
    return spark.range(n).select(F.lit("A").alias("farm_id"), (F.col("id") % 2).cast("string").alias("asset_id"), F.col("id").alias("dataset_id"), F.timestamp_seconds(F.col("id")).alias("start"), F.timestamp_seconds(F.col("id") + 9000).alias("end"))


def test_copies_grow_slower_than_pairs(spark, monkeypatch):
    """With one side copied whole to each part of the other, 800 ranges would be 77,000 rows here."""
    monkeypatch.setattr(joins, "DENSE", 4)
    n, df = 800, crowded(spark, 800)
    out = joins.all_overlaps(df)
    assert out.count() == out.distinct().count() == 2 * (n // 2) * (n // 2 - 1) // 2
    assert sum(side.count() for side in joins._dealt_ranges(df)) <= 2 * n * (n / 2 / 4 + 1) ** 0.5 * 1.3


def test_every_part_meets_every_part(spark, monkeypatch):
    df = crowded(spark, 90)
    few = {tuple(r) for r in joins.all_overlaps(df).collect()}
    monkeypatch.setattr(joins, "DENSE", 1)
    many = joins.all_overlaps(df).collect()
    assert {tuple(r) for r in many} == few and len(many) == len(few) == 45 * 44
