"""Mixing sources to target weights, in DataFrame functions only.

The words of each source, its documents in the order of their ids, are one stream that is packed into blocks of a fixed
number of words. A source offers slots: up to three passes over its blocks, a little more than its target needs. Every
slot is drawn, by a hash of (source, slot, seed), into one of the output shards or left out, so a source's counts in the
shards are one multinomial draw whose expected sum is its target; the draw decides which slots are taken. Slot numbers
become block numbers by a permutation of the source's block numbers that differs by source and pass, and blocks are
fetched by a join on (source, block). A slot is drawn once, so no block is taken more than three times.

The permutation is an affine map followed by rounds of the swap-or-not shuffle (Hoang, Morris, Rogaway, 2012), which
permutes any range without tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewright.llm.common import WORD, materialise, shuffled

BLOCK = 64
#: Primes for the affine step; the first that doesn't divide the number of blocks is taken.
PRIMES = (1299709, 104729, 7919, 611953, 15485863, 32452843)
#: One multiplier for each round of the shuffle.
ROUNDS = (7907, 104723, 49157, 12289, 786433, 24593)
#: Slots generated from one row, and slots of an output shard on average.
CHUNK, SHARD = 4096, 8192
#: Slots offered for each slot wanted. The fewer are left out, the nearer the drawn sum is to the target.
OFFER = 1.02
#: Shifts and multipliers of a public 32-bit mixing function.
MIX = ((15, 739982445), (12, 695872825), (15, 1))


def sized(docs: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc, source, size): number of words; null texts have none."""
    return docs.select(F.col(doc).alias("doc"), F.col(source).alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def sources(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, block: int = BLOCK) -> DataFrame:
    """One row a source: rank by code point with null last, weight, size, target, blocks, slots offered, chance of each.

    Targets share the size of everything by weight, each at most ``most`` times the source's size. Sorted by that cap per
    unit of weight, the capped sources come first, so running sums find them without iteration. The windows here run
    over distinct sources, not over documents.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    s = s.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = everything.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    onward = everything.orderBy("ratio", "rank").rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(upto), F.lit(0))) / F.sum("weight").over(onward)
    s = s.withColumn("total", total).withColumn("capped", F.col("ratio") < level)
    spare = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    s = s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(spare.cast("double") * F.col("weight") / open_weight))
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
    # A slot of a source with a short last block holds a little less than ``block`` words on average.
    wanted = F.when(F.col("blocks") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0)
    s = s.withColumn("wanted", F.least(wanted, (most * F.col("blocks")).cast("double")))
    s = s.withColumn("slots", F.least(most * F.col("blocks"), F.ceil(F.col("wanted") * OFFER)).cast("long"))
    s = s.withColumn("chance", F.when(F.col("slots") > 0, F.least(F.lit(1.0), F.col("wanted") / F.col("slots"))).otherwise(0.0))
    return s.select("source", "rank", "source_size", "target", "blocks", "slots", "chance")


def mixed(key: Column) -> Column:
    """A number below 2^32 that depends on all bits of a number below 2^32. (A lambda's variable is computed once.)"""
    steps = F.array(*[F.struct(F.lit(1 << shift).cast("long").alias("by"), F.lit(factor).cast("long").alias("factor")) for shift, factor in MIX])
    return F.aggregate(steps, key.cast("long"), lambda x, k: (x.bitwiseXOR(F.floor(x / k["by"])) * k["factor"]) % 4294967296)


def uniform(slot: Column, rank: Column, seed: int) -> Column:
    """The slot's draw, in [0, 1)."""
    salted = mixed((rank * 40503 + seed * 7919 + F.floor(slot / 4294967296) * 104729) % 4294967296)
    return mixed((slot % 4294967296).bitwiseXOR(salted)) / F.lit(4294967296.0)


def permuted(slot: Column, blocks: Column, rank: Column) -> Column:
    """The block of a slot: within each pass over the source, a permutation of its block numbers."""
    turn = F.floor(slot / blocks)
    at = slot % blocks
    factor = F.coalesce(*[F.when(blocks % p != 0, F.lit(p)) for p in PRIMES], F.lit(1)).cast("long")
    start = ((at % blocks) * (factor % blocks) + rank * 7907 + turn * 104723) % blocks

    def swap(x: Column, key: Column) -> Column:
        other = ((key * (rank + 3 + 5 * turn)) % blocks + blocks - x) % blocks
        top = F.greatest(x, other)
        mixed = ((top % 2147483647) * 2654435761 + key * (rank + 1) + turn * 40503) % 4294967291
        return F.when(F.floor(mixed / 65536) % 2 == 1, other).otherwise(x)

    return F.aggregate(F.array(*[F.lit(r).cast("long") for r in ROUNDS]), start.cast("long"), lambda x, k: swap(x, k).cast("long"))


def slots(parts: DataFrame, shard: int = SHARD, seed: int = 0) -> DataFrame:
    """(rank, slot, shard, block): the slots drawn and their shards, the recipe of the mix.

    Rows are made in three steps of bounded arrays, so a large source is neither one row nor one task.
    """
    parts = parts.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.sum("slots").over(Window.partitionBy()) / shard)))
    wide = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / (CHUNK * CHUNK))))
    wide = parts.where("slots > 0").select("rank", "blocks", "slots", "shards", "chance", wide.alias("wide"))
    first = F.col("wide") * CHUNK
    last = F.least(first + CHUNK - 1, F.floor((F.col("slots") - 1) / CHUNK))
    chunks = wide.select("rank", "blocks", "slots", "shards", "chance", F.explode(F.sequence(first, last)).alias("chunk"))
    # A given number of partitions keeps few small rows, each of which becomes thousands, from being put into one task.
    chunks = chunks.repartition(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "chunk")
    first = F.col("chunk") * CHUNK
    each = chunks.select("rank", "blocks", "shards", "chance", F.explode(F.sequence(first, F.least(first + CHUNK, F.col("slots")) - 1)).alias("slot"))
    taken = each.withColumn("draw", uniform(F.col("slot"), F.col("rank"), seed)).where(F.col("draw") < F.col("chance"))
    return taken.select("rank", "slot", F.floor(F.col("draw") / F.col("chance") * F.col("shards")).cast("long").alias("shard"), permuted(F.col("slot"), F.col("blocks"), F.col("rank")).alias("block"))


def packed(rows: DataFrame) -> DataFrame:
    """Add ``offset``, the words before a document in its source's stream, ordered by id, then size.

    Rows are range-partitioned by (source, id); sums by (source, partition) give each partition's start, so no source
    goes through one task. ``rows`` has rank, doc, size. Equal ids with equal sizes are alike, so any order of them does.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(rows.repartitionByRange(parts, "rank", "doc", "size").withColumn("part", F.spark_partition_id()), "mix-ranges")
    sums = placed.groupBy("rank", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("rank", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("rank", "part").orderBy("doc", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    local = local.withColumn("nth", F.row_number().over(Window.partitionBy("rank", "part").orderBy("doc", "size")))
    return local.join(starts, ["rank", "part"]).withColumn("offset", F.col("start") + F.col("inner"))


def mix(docs: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source", block: int = BLOCK, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(slots, pieces, documents).

    slots: the recipe, see ``slots``. pieces: (rank, block, part, nth, words) - which words of a document a block holds,
    by its place. documents: (doc, source, size, source_size, target, taken). Null sources are one source, the last. Null ids
    come first in their source. Repeated rows are rows of their own. An empty table gives empty results.
    """
    sizes = materialise(sized(docs, text, doc, source), "mix-sizes")
    parts = materialise(sources(sizes, block=block), "mix-sources")
    rows = sizes.join(parts, sizes["source"].eqNullSafe(parts["source"])).select("doc", sizes["source"], "size", "rank", "source_size", "target")
    placed = packed(rows)
    recipe = slots(parts, seed=seed)
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block)
    pieces = placed.where("size > 0").select("rank", "part", "nth", "offset", "size", F.explode(F.sequence(first, last)).alias("block"))
    words = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("offset"), F.col("block") * block)
    pieces = pieces.select("rank", "block", "part", "nth", words.alias("words"))
    used = recipe.groupBy("rank", "block").agg(F.count("*").alias("times"))
    taken = pieces.join(shuffled(used), ["rank", "block"]).groupBy("rank", "part", "nth").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = placed.join(shuffled(taken), ["rank", "part", "nth"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return recipe, pieces, out.select("doc", "source", "size", "source_size", "target", "taken")


def op6(docs: DataFrame) -> DataFrame:
    _, _, out = mix(docs.select("doc_id", "text", "source"))
    return out.withColumnRenamed("doc", "doc_id").select("doc_id", "size", "source_size", "target", "taken")


def _mixed(name: str, at: int) -> str:
    """Steps of ``mixed`` on column k of the table name{at}."""
    return "\n".join(f"{name}{at + n + 1} AS (SELECT * EXCLUDE (k), (xor(k, k >> {shift}) * {factor}) % 4294967296 AS k FROM {name}{at + n})," for n, (shift, factor) in enumerate(MIX))


_PICK = " ".join(f"WHEN blocks % {p} <> 0 THEN {p}" for p in PRIMES)
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
a AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
b AS (SELECT *, rank % 3 + 1 AS w, 3 * ss AS cap, 3 * ss / (rank % 3 + 1) AS ratio, CAST(sum(ss) OVER () AS BIGINT) AS total FROM a),
c AS (SELECT *, ratio < (total - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY ratio, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped FROM b),
e AS (SELECT *, CASE WHEN capped THEN CAST(cap AS DOUBLE)
    ELSE CAST(total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS DOUBLE) * w / sum(CASE WHEN NOT capped THEN w END) OVER () END AS target,
    CAST(ceil(ss / {BLOCK}) AS BIGINT) AS blocks FROM c),
f AS (SELECT *, least(CASE WHEN blocks > 0 THEN target * blocks / ss ELSE 0.0 END, CAST(3 * blocks AS DOUBLE)) AS wanted FROM e),
f2 AS (SELECT *, least(3 * blocks, CAST(ceil(wanted * CAST({OFFER} AS DOUBLE)) AS BIGINT)) AS slots FROM f),
g AS (SELECT *, CASE WHEN slots > 0 THEN least(1.0, wanted / slots) ELSE 0.0 END AS chance FROM f2),
h0 AS (SELECT rank, blocks, chance, unnest(generate_series(0, slots - 1)) AS slot FROM g WHERE slots > 0),
h1 AS (SELECT *, CAST((rank * 40503) % 4294967296 AS BIGINT) AS k FROM h0),
{_mixed('h', 1)}
i1 AS (SELECT * EXCLUDE (k), xor(CAST(slot AS BIGINT), k) AS k FROM h{1 + len(MIX)}),
{_mixed('i', 1)}
s AS (SELECT rank, blocks, slot FROM i{1 + len(MIX)} WHERE k / CAST(4294967296 AS DOUBLE) < chance),
s0 AS (SELECT rank, blocks, slot // blocks AS turn, ((slot % blocks) * (CASE {_PICK} ELSE 1 END % blocks) + rank * 7907 + (slot // blocks) * 104723) % blocks AS x FROM s),
{"".join(f'''s{i + 1} AS (SELECT rank, blocks, turn, CASE WHEN (((greatest(x, y) % 2147483647) * 2654435761 + {k} * (rank + 1) + turn * 40503) % 4294967291) // 65536 % 2 = 1 THEN y ELSE x END AS x
  FROM (SELECT *, (({k} * (rank + 3 + 5 * turn)) % blocks + blocks - x) % blocks AS y FROM s{i})),
''' for i, k in enumerate(ROUNDS))}
u AS (SELECT rank, x AS block, count(*) AS times FROM s{len(ROUNDS)} GROUP BY rank, x),
o AS (SELECT d.r, d.doc_id, d.size, g.rank, g.ss, g.target,
    coalesce(sum(d.size) OVER (PARTITION BY g.rank ORDER BY d.doc_id NULLS FIRST, d.size, d.r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
p AS (SELECT r, rank, off, size, unnest(generate_series(CAST(off AS BIGINT) // {BLOCK}, CAST(off + size - 1 AS BIGINT) // {BLOCK})) AS block FROM o WHERE size > 0),
t AS (SELECT p.r, sum((least(off + size, (p.block + 1) * {BLOCK}) - greatest(off, p.block * {BLOCK})) * times) AS taken FROM p JOIN u ON p.rank = u.rank AND p.block = u.block GROUP BY p.r)
SELECT doc_id, CAST(size AS BIGINT) AS size, ss AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM o LEFT JOIN t ON o.r = t.r
"""
