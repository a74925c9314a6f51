"""The corpus pipeline: five stages over ``documents``, each one operator of ``vanewright.llm`` on what its predecessor kept.

Extra columns of the input go; nulls may stand in any column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.llm import decontam, langid, mixing, neardup, secrets
from vanewright.llm.common import materialise, shuffled

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a decided language go: null texts and those without a letter. Repeated rows stay each; an empty
    table gives an empty one, and so does one without a labelled row."""
    docs = docs.select(*COLUMNS)
    found = langid.identify(docs, langid.fit(docs))
    return found.where(found["lang_pred"] != langid.UNDECIDED).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 or more, the document with the smallest id stays.

    Rows with a null id are in no group and stay. Rows that share an id are one document to the groups: each of its
    different texts stays, repeated ones once.
    """
    docs = docs.select(*COLUMNS)
    kept = neardup.near_duplicates(docs).where("kept and doc is not null").select(F.col("doc").alias("doc_id")).distinct()
    named = docs.where("doc_id is not null").join(shuffled(kept), "doc_id", "left_semi")
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    one = named.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("row")).select("doc_id", "text", "row.*")
    return one.unionByName(docs.where("doc_id is null")).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark covers a twentieth of the words or more go. Null and empty texts stay; each of
    repeated rows is judged alike; an empty table or benchmark leaves all as it is."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.decontaminate(docs.select(*COLUMNS), bench).where("not contaminated").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a secret go. Null and empty texts hold none; each of repeated rows is judged alike; an empty
    table gives an empty one."""
    return secrets.scan(docs.select(*COLUMNS)).where(F.size("secrets") == 0).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with the number of words taken, repeats counted.

    Null sources are one source, the last; documents without words are never taken; repeated rows are rows of their own;
    ties of ids are ordered by size; an empty table gives an empty one.
    """
    _, _, out = mixing.mix(docs.select(*COLUMNS))
    return out.where("taken > 0").select(F.col("doc").alias("doc_id"), "source", "size", "source_size", "target", "taken")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secret_scan", secret_scan), ("mix", mix)]

#: Language identification has no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
