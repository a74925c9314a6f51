import re
from collections import defaultdict

from pyspark.sql import functions as F

from vanewright.llm import mixing


def targets(sizes):
    """By the contract's iteration: cap what is above three times its source, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, out, fixed = sum(sizes.values()), {}, {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        out = fixed | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if out[s] > 3 * sizes[s]]
        if not over:
            return out
        fixed |= {s: 3 * sizes[s] for s in over}


def check(docs):
    rows = mixing.op6(docs).collect()
    texts = docs.select("doc_id", "text", "source").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in rows) == sorted((r["doc_id"] is None, r["doc_id"] or 0, len(re.findall(r"[^\x20\x09-\x0d]+", r["text"] or ""))) for r in texts)
    sizes = defaultdict(int)
    for r in texts:
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0d]+", r["text"] or ""))
    want = targets(sizes)
    _, _, full = mixing.mix(docs.select("doc_id", "text", "source"))
    taken = defaultdict(int)
    for r in full.collect():
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s, t in taken.items():
        # Five deviations of the draw, a rounded slot and the short last block.
        assert abs(t - want[s]) <= 5 * mixing.BLOCK * ((mixing.OFFER - 1) * want[s] / mixing.BLOCK) ** 0.5 + 1.5 * mixing.BLOCK, (s, t, want[s])
    assert sorted(map(str, rows)) == sorted(map(str, mixing.op6(docs).collect()))


def test_documents(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_permutations(spark):
    df = spark.range(1).select(F.explode(F.array(*[F.lit(n).cast("long") for n in (1, 2, 7, 64, 1000)])).alias("blocks")).withColumn("rank", F.lit(4).cast("long")).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), 3 * F.col("blocks") - 1)))
    rows = df.withColumn("block", mixing.permuted(F.col("slot"), F.col("blocks"), F.col("rank"))).collect()
    for n in (1, 2, 7, 64, 1000):
        passes = [[r["block"] for r in sorted(rows, key=lambda r: r["slot"]) if r["blocks"] == n and r["slot"] // n == k] for k in range(3)]
        assert all(sorted(p) == list(range(n)) for p in passes)
        assert n < 64 or passes[0] != passes[1]


def test_counts_fit_the_multinomial(spark):
    """Counts by (shard, source): sums near the target, shards by chi-square, other counts and slots by another seed."""
    parts = spark.createDataFrame([(0, 40_000, 60_000, 0.97), (1, 900, 1_000, 1.0), (2, 70_000, 70_000, 0.9)], "rank long, blocks long, slots long, chance double")
    drawn = {}
    for seed in (0, 1):
        rows = mixing.slots(parts, seed=seed).groupBy("rank", "shard").count().collect()
        counts = drawn[seed] = {(r["rank"], r["shard"]): r["count"] for r in rows}
        shards = -(-131_000 // mixing.SHARD)
        for rank, slots, chance in ((0, 60_000, 0.97), (1, 1_000, 1.0), (2, 70_000, 0.9)):
            own = [counts.get((rank, k), 0) for k in range(shards)]
            assert abs(sum(own) - slots * chance) <= 5 * (slots * chance * (1 - chance)) ** 0.5
            mean = sum(own) / shards
            chi = sum((c - mean) ** 2 / mean for c in own)
            assert 3 < chi < 45, (rank, chi)  # 16 shards: 15 degrees of freedom
    assert drawn[0] != drawn[1]
    slots = [{r["slot"] for r in mixing.slots(parts.where("rank = 0"), seed=s).select("slot").collect()} for s in (0, 1)]
    assert slots[0] != slots[1]


def test_odd_rows(odd, nothing, documents):
    check(odd)
    assert mixing.op6(nothing).count() == 0
    check(documents([(1, None, "a", None), (2, "", "a", "b")]))
    check(documents([(k, "w " * (k % 50), "en", None if k % 3 else "hot") for k in range(400)]))
