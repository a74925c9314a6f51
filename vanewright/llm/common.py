"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Separators of a word: space, tab, newline, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared folder (``spark.checkpoint.dir``).

    Only where that setting is absent and the master is local, as in tests, a temporary folder is made and set; on a
    cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by a Parquet table in the shared folder, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote and that no later plan reads."""
    for table in tables:
        if path := getattr(table, "scratch_path", None):
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shuffled(df: DataFrame) -> DataFrame:
    """Mark a side of a join that grows with the corpus: compressed files look small, but it must not be broadcast.

    Where both sides of the join are tables, their exchanges stand right under it, and Spark's adaptive skew join splits
    the rows of a hot key over many tasks. So what is aggregated before a join on a key that may be hot is written first.
    """
    return df.hint("merge")


def id_text(column: str) -> Column:
    """An id as text; a null id counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """True for the fifth of the ids that no model learns from."""
    return F.crc32(id_text(column).cast("binary")) % 5 == 0


def append(df: DataFrame, text: str, fields: list[tuple[str, str]], start: Callable[[], Callable]) -> DataFrame:
    """Add ``fields`` (name, Spark type) computed from the text column, one Arrow batch at a time.

    ``start`` runs once a task and returns ``texts -> list of columns``; nulls reach it as None.
    Columns of ``df`` with the name of a field are replaced.
    """
    names = {name for name, _ in fields}
    keep = [c for c in df.columns if c not in names]
    df = df.select(*[F.col(f"`{c}`") for c in keep]) if len(keep) < len(df.columns) else df
    extra = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    at = df.columns.index(text)
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in extra]
    labels = [f.name for f in extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            if not batch.num_rows:
                continue
            made = work(batch.column(at).to_pylist())
            columns = [pa.array(v, type=k) for v, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *labels])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *extra.fields]))
