"""Files to layers: raw CSV to bronze, bronze to silver, silver to gold, and their readers.

All datasets of a farm go in one job. The driver sees file names, header lines and manifests, as Spark's own file index does.

A layer is a folder of Parquet files, each with whole runs of episodes in the order of their readings. Every write goes to a
folder of its own and is committed by one manifest file, moved into place when all data are there: which episodes and times
each file holds, how many rows, and the columns. The last commit of an episode holds; earlier ones are passed over. So a
failed write shows nothing, writers of different episodes don't meet, and reads open only the files that their episodes and
times are in. Layers hold farms of different columns: a read's schema is the union of those committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.functions.columns import EPISODE, event_time, no_nan, text, whole
from vanewright.operators import conform, joins

#: Parts of file names that mark metadata, and event files by preference.
METADATA = ("event_info", "sensor", "description", "readme", "metadata")
EVENT_FILES = ("comma_event_info.csv", "event_info.csv", "event_info.json", "metadata.json")
CORRUPT = "_corrupt_record"
#: Bytes of a file that are read for its header line; more only where the line is longer.
FIRST = 1 << 14


def dataset_id(path: Column) -> Column:
    """The last part of a path without a comma_ prefix and .csv."""
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?i)^comma_", ""), r"(?i)\.csv$", "")


def _plain(path: Column) -> Column:
    """A path as readers take it: percent codes decoded, one slash after file:."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, length) of all files below a folder. Only names and sizes are read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "length")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """(dataset_id, path, folder): data files below a folder; of comma_X and X in one folder the first."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    kept = files(spark, root, "*.csv").where(~name.rlike("|".join(METADATA))).withColumns({"dataset_id": dataset_id(F.col("path")), "folder": F.regexp_replace("path", "/[^/]*$", ""), "_comma": name.startswith("comma_")})
    first = Window.partitionBy("folder", "dataset_id").orderBy(F.col("_comma").desc(), "path")
    return kept.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("dataset_id", "path", "folder")


def headers(spark: SparkSession, paths: list[str], first: int = FIRST) -> dict[str, tuple[str, str]]:
    """path -> (header line, separator): the first line, read from each file's first block alone, and the commoner of comma
    and semicolon in it. A line that is not valid UTF-8 is latin-1."""
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def one(path: str) -> tuple[str, str]:
        stream = (p := path_of(path)).getFileSystem(conf).open(p)
        try:
            raw, more, size = b"", b"-", first
            while b"\n" not in raw and more:
                raw += (more := bytes(stream.readNBytes(size)))
                size *= 8
        finally:
            stream.close()
        line = raw.split(b"\n")[0].removesuffix(b"\r")
        try:
            header = line.decode("utf-8-sig")
        except UnicodeDecodeError:
            header = line.decode("latin-1")
        return header, ";" if header.count(";") > header.count(",") else ","

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(paths, pool.map(one, paths), strict=True))


def not_utf8(spark: SparkSession, paths: list[str]) -> set[str]:
    """The files of which a line is not valid UTF-8."""
    lines = spark.read.text(paths).select("value", _plain(F.col("_metadata.file_path")).alias("path"))
    return {r["path"] for r in lines.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("ok")).where("not ok").collect()} if paths else set()


def names_of(header: str, sep: str) -> list[str]:
    """Trimmed column names of a header line; empty and repeated ones get their number, so every field is kept."""
    import csv

    out: list[str] = []
    for k, n in enumerate(next(csv.reader([header], delimiter=sep), [])):
        n = n.strip() or f"column_{k}"
        out.append(n if n.lower() not in {o.lower() for o in out} else f"{n}_{k}")
    return out


def read_csv(spark: SparkSession, paths: list[str], encoding: str | None = None, heads: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Files of any separator, encoding and order of columns as one table by column names, all text, with dataset_id.

    Files with one header line are one scan with that header as the schema. Lines with a field too many or too few stay,
    with their text in _corrupt_record. encoding: None finds out by a pass of its own which files are not UTF-8.
    """
    heads = heads or headers(spark, paths)
    odd = not_utf8(spark, paths) if encoding is None else set()
    groups: dict[tuple[str, str, str], list[str]] = {}
    for p in paths:
        groups.setdefault((*heads[p], encoding or ("ISO-8859-1" if p in odd else "UTF-8")), []).append(p)
    out = None
    for (header, sep, code), own in sorted(groups.items()):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names_of(header, sep), CORRUPT]])
        df = spark.read.schema(schema).options(header=True, sep=sep, encoding=code, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=True).csv(own)
        df = df.select(*[F.col(f"`{c}`") for c in df.columns], dataset_id(_plain(F.col("_metadata.file_path"))).alias("dataset_id"))
        df = conform.canonical(df)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def ingest(spark: SparkSession, raw: str, bronze: str, farm: str, force: bool = False) -> DataFrame:
    """CSV files of a farm to bronze; done datasets are skipped unless forced.

    Returns (farm_id, dataset_id, n_rows, n_corrupt, error), a row for each file taken up. A file without a readable header
    or without a required column is left out and told in ``error``; the others go on. Files of no bytes are not seen.

    Raw bytes are read once, as UTF-8, besides each header's first block, and go to bronze without a shuffle. Only where
    the writing job has seen characters that stand for bytes outside UTF-8 are their files looked at again, and those that
    are not UTF-8 as a whole read and committed anew as latin-1.
    """
    found = discover(spark, raw).withColumn("farm_id", F.lit(farm))
    todo = joins.unprocessed(found, done(spark, bronze), force)
    named = {r["dataset_id"]: r["path"] for r in todo.select("dataset_id", "path").collect()}  # files of one farm
    heads = headers(spark, list(named.values()))
    good, bad = {}, []
    for dataset, path in named.items():
        have = {c.strip().lower() for c in names_of(*heads[path])}
        missing = [c for c in conform.REQUIRED if have.isdisjoint(conform.ALIASES[c])]
        if missing:
            bad.append((farm, dataset, 0, 0, f"missing columns {', '.join(missing)}"))
        else:
            good[dataset] = path
    errors = spark.createDataFrame(bad, "farm_id string, dataset_id string, n_rows long, n_corrupt long, error string")
    if not good:
        return errors

    def written(paths: list[str], encoding: str) -> tuple[DataFrame, int]:
        seen, df = Observation(), read_csv(spark, paths, encoding, heads).withColumn("farm_id", F.lit(farm))
        odd = F.count_if(F.contains(F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns]), F.lit("\ufffd")))
        write(df.observe(seen, odd.alias("odd")), bronze, cluster=False)
        return df, seen.get["odd"]

    df, odd = written(list(good.values()), "UTF-8")
    if odd:
        text_of = F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns])
        again = [good[r["dataset_id"]] for r in df.where(F.contains(text_of, F.lit("\ufffd"))).select("dataset_id").distinct().collect()]
        if latin := sorted(not_utf8(spark, again)):
            written(latin, "ISO-8859-1")
    own = live(spark, bronze).where(F.col("farm_id") == farm).join(spark.createDataFrame([(d,) for d in good], "dataset_id string"), "dataset_id", "left_semi")
    counts = own.groupBy(*EPISODE).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_corrupt").alias("n_corrupt"))
    return counts.withColumn("error", F.lit(None).cast("string")).unionByName(errors)


_ENTRY = "version long, write string, farm_id string, dataset_id string, file string, n_rows long, n_corrupt long, first_ts string, last_ts string, n_columns int, n_bytes long, source string, schema string"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Every commit of a layer: a row for each (write, episode, file), and one a write that tells its schema; none before
    the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).json(str(path))


def live(spark: SparkSession, root: str) -> DataFrame:
    """The (episode, file) rows that hold: those of each episode's last commit."""
    last = Window.partitionBy(*EPISODE)
    rows = commits(spark, root).where("dataset_id is not null").withColumn("_at", F.struct("version", "write"))
    return rows.withColumn("_last", F.max("_at").over(last)).where("_at = _last").drop("_at", "_last", "schema")


def layer_schema(spark: SparkSession, root: str) -> T.StructType | None:
    """The union of all columns committed to a layer; None before the first write. Two types of one column are an error."""
    told = [r["schema"] for r in commits(spark, root).where("schema is not null").select("version", "write", "schema").orderBy("version", "write").collect()]
    return _merged(root, *[T.StructType.fromJson(json.loads(x)) for x in told]) if told else None


def _merged(root: str, *schemas: T.StructType) -> T.StructType:
    have: dict[str, T.StructField] = {}
    for f in (f for s in schemas for f in s):
        known = have.setdefault(f.name.lower(), T.StructField(f.name, f.dataType))
        if known.dataType != f.dataType:
            raise ValueError(f"column {f.name} is {known.dataType.simpleString()} in {root}, not {f.dataType.simpleString()}")
    return T.StructType(list(have.values()))


def write(df: DataFrame, root: str, cluster: bool = True, sources: DataFrame | None = None) -> str:
    """Add the episodes of a table to a layer, or put them in place of those that are there; the name of the write.

    cluster: rows are range-partitioned by episode first, into as many files as their size asks for; without it each task
    writes the rows that it has, which suits tables that already come by episode. Either way files are sorted by episode
    and time. sources: (farm_id, dataset_id, source) for the manifest, what an episode was made from.
    """
    spark, root, name = df.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    df = df.withColumns({c: F.col(c).cast("string") for c in EPISODE})
    schema, known = df.schema, layer_schema(spark, root)
    _merged(root, *([known] if known else []), schema)
    order = [*EPISODE, *[c for c in ("time_stamp", "id") if c in df.columns]]
    placed = df.repartitionByRange(*EPISODE) if cluster else df
    placed.sortWithinPartitions(*order).write.partitionBy("farm_id").parquet(f"{root}/write={name}")
    back = spark.read.schema(df.schema).parquet(f"{root}/write={name}")
    stamp = [f("time_stamp").cast("string").alias(n) if "time_stamp" in df.columns else F.lit(None).cast("string").alias(n) for f, n in ((F.min, "first_ts"), (F.max, "last_ts"))]
    # Only the columns named here are read again.
    entries = back.groupBy(*EPISODE, _plain(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("size")).agg(
        F.count("*").alias("n_rows"), (F.count(CORRUPT) if CORRUPT in df.columns else F.lit(0)).cast("long").alias("n_corrupt"), *stamp
    )
    entries = entries.join(sources.select(*EPISODE, "source"), list(EPISODE), "left") if sources is not None else entries.withColumn("source", F.lit(None).cast("string"))
    share = F.floor(F.col("size") * F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy("path"))).cast("long")
    version = (commits(spark, root).agg(F.max("version")).first()[0] or 0) + 1
    told = [F.lit(version).cast("long").alias("version"), F.lit(name).alias("write")]
    rows = entries.select(*told, *EPISODE, F.regexp_extract("path", f"write={name}/(.*)$", 1).alias("file"), "n_rows", "n_corrupt", "first_ts", "last_ts", F.lit(len(schema)).alias("n_columns"), share.alias("n_bytes"), "source")
    rows = rows.unionByName(spark.range(1).select(*told, F.lit(schema.json()).alias("schema")), allowMissingColumns=True)
    draft = f"{root}/_draft-{name}"
    rows.coalesce(1).write.json(draft)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(root).getFileSystem(spark._jsc.hadoopConfiguration())
    [part] = [x.getPath() for x in fs.listStatus(path_of(draft)) if x.getPath().getName().startswith("part-")]
    fs.mkdirs(path_of(f"{root}/_manifest"))
    if not fs.rename(part, path_of(f"{root}/_manifest/{version:010d}-{name}.json")):
        raise OSError(f"the write {name} of {root} could not be committed")
    fs.delete(path_of(draft), True)
    return name


def read(spark: SparkSession, root: str, columns: Iterable[str] | None = None, where: Column | str | None = None, limit: int | None = None, episodes: DataFrame | Column | str | None = None) -> DataFrame:
    """A pruned scan. episodes: (farm_id, dataset_id) rows, or a condition on the manifest (farm_id, dataset_id, first_ts
    and last_ts as text, n_rows, ...) that chooses episodes, so only their files are opened; where: a condition on the rows, which with the columns reaches
    the files. Columns that a farm lacks are NULL in its rows; a layer without a commit is an error.
    """
    schema = layer_schema(spark, root)
    if schema is None:
        raise ValueError(f"no write was committed to {root}")
    root, held = root.rstrip("/"), live(spark, root)
    chosen = held if episodes is None else held.join(episodes, list(EPISODE), "left_semi") if isinstance(episodes, DataFrame) else held.where(episodes)
    files = [f"{root}/write={r['write']}/{r['file']}" for r in chosen.select("write", "file").distinct().collect()]
    names = [f.name for f in schema]
    if files:
        df = spark.read.schema(T.StructType([*schema, T.StructField("write", T.StringType())])).option("basePath", root).parquet(*sorted(files))
        # Files also hold episodes that were not chosen, or written again since.
        df = df.join(chosen.select("write", *EPISODE).distinct(), ["write", *EPISODE], "left_semi").select(*[F.col(f"`{n}`") for n in names])
    else:
        df = spark.createDataFrame([], schema)
    df = df if where is None else df.where(where)
    df = df if columns is None else df.select(*columns)
    return df if limit is None else df.limit(limit)


def done(spark: SparkSession, root: str) -> DataFrame:
    """(farm_id, dataset_id) of a layer, from its manifest; none when nothing was written yet."""
    return live(spark, root).select(*EPISODE).distinct()


def layer_report(spark: SparkSession, root: str) -> DataFrame:
    """(farm_id, dataset_id, n_rows, n_columns, n_files, n_bytes) of a layer from its manifest, for run reports; n_columns are
    those that the episode was written with, n_bytes its share of its files."""
    return live(spark, root).groupBy(*EPISODE).agg(F.sum("n_rows").alias("n_rows"), F.max("n_columns").alias("n_columns"), F.count_distinct("write", "file").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))


def to_silver(spark: SparkSession, bronze: str, silver: str, events: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Clean what bronze has and silver has not, and return (farm_id, dataset_id, rows_in, rows_out, rows_dropped) of all.

    An episode is done when silver holds it from the same write of bronze, unless forced. Lines that did not fit their
    header are left out, as are rows without a readable time. Rows are cleaned where they are, without a shuffle, and
    counted in the manifests.
    """
    have = live(spark, bronze).groupBy(*EPISODE).agg(F.max("write").alias("source"), F.sum("n_rows").alias("rows_in"))
    made = live(spark, silver).select(*EPISODE, "source").distinct()
    todo = have if force else have.join(made, [*EPISODE, "source"], "left_anti")
    if not todo.isEmpty():
        raw = read(spark, bronze, episodes=todo)
        clean = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw
        clean = no_nan(conform.readings(clean))
        if events is not None:
            clean = clean.join(joins.with_events(todo.select(*EPISODE), events), list(EPISODE), "left")
        write(clean, silver, cluster=False, sources=todo)
    out = live(spark, silver).groupBy(*EPISODE).agg(F.sum("n_rows").alias("rows_out"))
    return have.join(out, list(EPISODE), "left").select(*EPISODE, "rows_in", F.coalesce("rows_out", F.lit(0)).alias("rows_out")).withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))


def to_gold(features: DataFrame, metadata: DataFrame, root: str) -> None:
    """Feature tables by episode, and their metadata as JSON lines."""
    write(features, f"{root}/features")
    metadata.write.mode("overwrite").json(f"{root}/metadata")


def read_gold(spark: SparkSession, root: str) -> tuple[DataFrame, list[str]]:
    """(features, feature names): the names that any episode has, in order; a feature that an episode lacks is NULL there."""
    each = spark.read.json(f"{root}/metadata").select(F.explode(F.split("features", ",")).alias("name")).where("name <> ''")
    return read(spark, f"{root}/features"), [r["name"] for r in each.distinct().orderBy("name").collect()]  # as many as columns


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event records of CSV or JSON: headers trimmed and lower, ids cleaned, empty text NULL, times parsed."""
    df = spark.read.option("multiLine", True).json(path) if path.endswith(".json") else read_csv(spark, [path]).drop("dataset_id", CORRUPT)
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    return events_typed(df)


def events_typed(df: DataFrame) -> DataFrame:
    out = df.select(*[text(F.col(c).cast("string")).alias(c) for c in df.columns])
    extra = {c: whole(c) for c in ("event_start_id", "event_end_id") if c in out.columns} | {f"{c}_ts": event_time(c) for c in ("event_start", "event_end") if c in out.columns}
    number = whole("event_id")
    return out.withColumns(extra | {"event_id": F.coalesce(number.cast("string"), F.col("event_id"))})


def preferred_file(files: DataFrame, names: Iterable[str] = EVENT_FILES) -> DataFrame:
    """(folder, path): of the files (folder, path) the one whose name comes first in ``names``."""
    rank = F.array_position(F.array(*map(F.lit, names)), F.lower(F.element_at(F.split("path", "/"), -1)))
    return files.withColumn("_r", rank).where("_r > 0").groupBy("folder").agg(F.min_by("path", "_r").alias("path"))


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """Sensor descriptions with an ordinal; sensor_name, description and is_angle must be there."""
    df = read_csv(spark, [path]).drop("dataset_id", CORRUPT)
    df = conform.require(df.toDF(*[c.strip().lower() for c in df.columns]), ("sensor_name", "description", "is_angle"))
    return df.withColumn("ordinal", F.monotonically_increasing_id())


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def manifest(df: DataFrame) -> DataFrame:
    """(farm_id, dataset_id, n_rows, n_columns) of a layer."""
    return df.groupBy(*EPISODE).agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
