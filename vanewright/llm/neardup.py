"""MinHash near-duplicate detection with sequential Bayesian verification.

1. One pass over the texts gives each document's number of distinct shingles, a 128-bit digest of the set, and its
   MinHash signature. Documents with equal sets become one class, so exact copies never meet in pairs.
2. Signatures are cut into bands; equal bands make candidates. With 32 bands of 5 rows a pair at similarity 0.8 is missed
   with probability 3e-6.
3. In each bucket every member meets one pivot, not every other member. Links found so join into components.
   Buckets that still mix components are compared whole, in blocks (see ``_across``): first by signatures alone, then by
   the texts that some likely partner in another component needs; only links that join components leave the tasks.
4. A pair is verified in steps: signature batches are compared until the posterior probability that its similarity
   reaches the threshold falls below ``MISS``; survivors are verified exactly on the full sets of their texts.

Pairs inside one component are not all formed: links beyond those that join it change no result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import append, discard, materialise, shuffled
from vanewright.llm.graphs import components

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Signature values compared before each decision, and the probability of losing a pair at a decision.
BATCH, MISS = 32, 1e-8
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b in (9, 10, 11, 12, 13) else b for b in range(256))
_M = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """A-Z in lower case; words between spaces, tabs, newlines, vertical tabs, form feeds and carriage returns."""
    return (text or "").encode().translate(_LOWER).split()


def shingles(text: str | None, k: int) -> set[tuple[bytes, ...]]:
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def sketcher(k: int, seed: int = 1) -> Callable:
    """text -> (number of shingles, two digests, signature)."""
    rng = np.random.default_rng(seed)
    mult = rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
    known = _Words()

    def sketch(text: str | None) -> tuple[int, int, int, bytes | None]:
        w = words(text)
        if not w:
            return 0, 0, 0, None
        h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
        kk = min(k, len(w))
        s = np.full(len(w) - kk + 1, len(w) < k, np.uint64)
        for i in range(kk):
            s = _mix(s * _M + h[i : len(h) - kk + 1 + i])
        s = np.unique(s)
        one = int(np.bitwise_xor.reduce(_mix(s + _M)))
        two = int(_mix(s ^ np.uint64(0x1234567)).sum(dtype=np.uint64))
        low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
        for a in range(0, len(s), 4096):
            low = np.minimum(low, ((s[a : a + 4096, None] * mult) >> np.uint64(32)).min(axis=0).astype(np.uint32))
        signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
        return len(s), signed(one), signed(two), low.tobytes()

    return sketch


def fewest_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For n compared values, the fewest matches with which P(similarity >= threshold) is at least ``miss``.

    From a uniform prior, the posterior after m matches of n is Beta(m + 1, n - m + 1), whose upper tail at t is the
    chance of at most m successes in n + 1 trials of chance t.
    """
    out = [0]
    for n in range(1, HASHES + 1):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _sketched(docs: DataFrame, text: str, k: int) -> DataFrame:
    def start() -> Callable:
        sketch = sketcher(k)
        return lambda texts: list(map(list, zip(*map(sketch, texts), strict=True)))

    return append(docs, text, [("n", "long"), ("d1", "long"), ("d2", "long"), ("signature", "binary")], start).drop(text)


def _plausible(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that the sequential test doesn't rule out."""
    sig = lambda c: signatures.select(F.col("rep").alias(c), F.col("signature").alias(f"s{c}"))
    both = pairs.join(shuffled(sig("a")), "a").join(shuffled(sig("b")), "b").select("a", "b", "sa", "sb")
    need = fewest_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in (2, 3))
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, np.int64)
            for a in range(0, HASHES, BATCH):
                matches[alive] += (x[alive, a : a + BATCH] == y[alive, a : a + BATCH]).sum(axis=1)
                alive = alive[matches[alive] >= need[a + BATCH]]
            kept = batch.select([0, 1]).take(pa.array(alive))
            yield kept

    return both.mapInArrow(run, "a long, b long").distinct()


def _exact(pairs: DataFrame, docs: DataFrame, threshold: int, k: int) -> DataFrame:
    """A table of the pairs whose full sets overlap enough: 100 * intersection >= threshold * union."""
    texts = docs.where("doc is not null")
    ends = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    own = materialise(texts.join(shuffled(ends), "doc", "left_semi"), "dedup-texts")
    side = lambda c: own.select(F.col("doc").alias(c), F.col("text").alias(f"t{c}"))
    both = pairs.join(shuffled(side("b")), "b").join(shuffled(side("a")), "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, set()
        for batch in batches:
            keep = []
            ta, tb = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                if (t := ta[i].as_py()) != last:
                    last, x = t, shingles(t, k)
                y = shingles(tb[i].as_py(), k)
                common = len(x & y)
                if x and y and 100 * common >= threshold * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    links = materialise(both.mapInArrow(run, "a long, b long").distinct(), "dedup-links")
    discard(own)
    return links


def near_duplicates(docs: DataFrame, text: str = "text", doc: str = "doc_id", k: int = 5, threshold: int = 80) -> DataFrame:
    """(doc, n_shingles, component, kept) for each row.

    component: smallest id reachable by links of at least ``threshold`` percent Jaccard similarity of ``k``-word
    shingles. Null texts and texts without words have an empty set and link with nothing; shorter texts are one shingle.
    Null ids link with nothing: their component is null and they are kept. Rows that share an id are one document to the
    components. An empty table gives an empty one. Other columns are not read.
    """
    docs = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = materialise(_sketched(docs, "text", k), "dedup-sketches")
    reps = rows.where("n > 0 and doc is not null").groupBy("d1", "d2", "n").agg(F.min(F.struct("doc", "signature")).alias("m"))
    reps = materialise(reps.select("d1", "d2", "n", F.col("m.doc").alias("rep"), F.col("m.signature").alias("signature")), "dedup-classes")
    signatures = reps.select("rep", "signature")
    slices = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("signature"), i * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    bands = reps.select("rep", F.explode(slices).alias("band"))
    sizes = bands.groupBy("band").agg(F.min("rep").alias("pivot"), F.max("rep").alias("other")).where("pivot <> other").select("band", "pivot")
    sizes = materialise(sizes, "dedup-pivots")
    # A bucket's key is hot only where its members are; they carry two numbers each.
    members = materialise(bands.join(shuffled(sizes), "band").select("band", "rep", "pivot"), "dedup-members")
    tried = materialise(members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "dedup-pairs")
    links = _verified(tried, signatures, docs, threshold, k)
    labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    found = _across(members.select("band", "rep"), labels, reps.select("rep", "n", "signature"), docs, threshold, k)
    if not found.isEmpty():
        labels = components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).union(found.select("a", "b")))
    named = reps.select("d1", "d2", F.col("n").alias("size"), "rep").join(shuffled(labels.withColumnRenamed("node", "rep")), "rep", "left")
    named = materialise(named.select("d1", "d2", "size", F.coalesce("label", "rep").alias("component")), "dedup-named")
    discard(sizes, members, tried, links, found, reps)
    left = rows.select("doc", "n", F.when(F.col("doc").isNotNull(), F.col("d1")).alias("d1"), "d2", F.col("n").alias("size"))
    out = left.join(shuffled(named), ["d1", "d2", "size"], "left")
    component = F.coalesce("component", "doc")
    return out.select("doc", F.col("n").alias("n_shingles"), component.alias("component"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def _verified(pairs: DataFrame, signatures: DataFrame, docs: DataFrame, threshold: int, k: int) -> DataFrame:
    survivors = materialise(_plausible(pairs, signatures, threshold / 100), "dedup-plausible")
    links = _exact(survivors, docs, threshold, k)
    discard(survivors)
    return links


def _candidates(x: np.ndarray, y: np.ndarray, need: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of two signature blocks that the sequential test keeps, and their matches, some rows at a time."""
    for a in range(0, len(x), 128):
        part = x[a : a + 128]
        matches = np.zeros((len(part), len(y)), np.int16)
        for h in range(BATCH):
            matches += part[:, h, None] == y[None, :, h]
        i, j = np.nonzero(matches >= need[BATCH])
        m = matches[i, j].astype(np.int64)
        for h in range(BATCH, HASHES, BATCH):
            m = m + (part[i, h : h + BATCH] == y[j, h : h + BATCH]).sum(axis=1)
            keep = m >= need[h + BATCH]
            i, j, m = i[keep], j[keep], m[keep]
        yield i + a, j, m


_NEED = "family long, level int, up boolean, i int, j int, rep long, right boolean"


def _needed(threshold: int) -> Callable:
    """Rows of two large blocks, by signatures alone, that have a likely partner in another component: once for each pair
    of small blocks in which that partner is."""
    need = fewest_matches(threshold / 100)

    def run(table: pa.Table) -> pa.Table:
        first = {c: table[c][0].as_py() for c in ("family", "level", "up")}
        label, rep, small, right = (table[c].to_numpy() for c in ("label", "rep", "small", "right"))
        sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, HASHES)
        left_at = np.flatnonzero(~right)
        right_at = np.flatnonzero(right) if right.any() else left_at
        seen = []
        if len(left_at) and (label != label[0]).any():
            for p, q, _ in _candidates(sig[left_at], sig[right_at], need):
                p, q = left_at[p], right_at[q]
                keep = label[p] != label[q]
                p, q = p[keep], q[keep]
                if not first["up"]:  # within one level the lower block is the left one
                    swap = small[p] > small[q]
                    p, q = np.where(swap, q, p), np.where(swap, p, q)
                two = first["up"] | (small[p] != small[q])
                for rows, side in ((p, False), (q, two)):
                    seen.append(np.unique(np.stack([small[p], small[q], rows, np.broadcast_to(side, len(p))], axis=1), axis=0))
        every = np.unique(np.concatenate(seen), axis=0) if seen else np.zeros((0, 4), np.int64)
        columns = {k: pa.array([v] * len(every)) for k, v in first.items()}
        return pa.table(columns | {"i": every[:, 0], "j": every[:, 1], "rep": rep[every[:, 2]], "right": every[:, 3] > 0}).cast(_ARROW_NEED)

    return run


_ARROW_NEED = pa.schema([("family", pa.int64()), ("level", pa.int32()), ("up", pa.bool_()), ("i", pa.int32()), ("j", pa.int32()), ("rep", pa.int64()), ("right", pa.bool_())])


def _linked(threshold: int, k: int) -> Callable:
    """Links that join the components of one block or pair of blocks: a forest, not every pair.

    Likely pairs come first; pairs whose components have met meanwhile need no verification.
    """
    need = fewest_matches(threshold / 100)

    def run(table: pa.Table) -> pa.Table:
        pdf = table.to_pandas().drop_duplicates(["rep", "text"]).sort_values(["right", "rep", "text"]).reset_index(drop=True)
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        if pdf["label"].nunique() < 2:
            return schema.empty_table()
        sig = np.frombuffer(b"".join(pdf["signature"]), np.uint32).reshape(-1, HASHES)
        right = pdf["right"].to_numpy()
        left_at = np.flatnonzero(~right)
        right_at = np.flatnonzero(right) if right.any() else left_at
        if not len(left_at):  # the hash left the lower block empty; the right block has a task of its own
            return schema.empty_table()
        i, j, m = (np.concatenate(c) for c in zip(*_candidates(sig[left_at], sig[right_at], need), strict=True))
        i, j = left_at[i], right_at[j]
        keep = i != j if right.any() else i < j
        order = np.argsort(-m[keep], kind="stable")
        root = {x: x for x in pdf["label"]}

        def top(v: int) -> int:
            while root[v] != v:
                root[v] = v = root[root[v]]
            return v

        label, rep, texts = pdf["label"].to_numpy(), pdf["rep"].to_numpy(), pdf["text"].to_numpy()
        number: dict[tuple[bytes, ...], int] = {}  # shingles by number: full sets stay small enough to keep
        sets: dict[int, set[int]] = {}

        def full(r: int) -> set[int]:
            if r not in sets:
                sets[r] = {number.setdefault(g, len(number)) for g in shingles(texts[r], k)}
            return sets[r]

        links = []
        pairs = sorted(zip(-m[keep][order] // 8, i[keep][order], j[keep][order], strict=True))  # like rows together
        for _, p, q in pairs:
            u, v = top(label[p]), top(label[q])
            if u != v:
                x, y = full(p), full(q)
                common = len(x & y)
                if 100 * common >= threshold * (len(x) + len(y) - common):
                    root[max(u, v)] = min(u, v)
                    links.append((rep[p], rep[q]))
        return pa.table({"a": [int(x) for x, _ in links], "b": [int(y) for _, y in links]}, schema=schema)

    return run


def _across(members: DataFrame, labels: DataFrame, reps: DataFrame, docs: DataFrame, threshold: int, k: int) -> DataFrame:
    """Links between members of a bucket that are in different components after the pivots.

    Buckets that mix components are chained into families. A family is dealt by set size into levels, of which only equal
    and neighbouring ones can link, and each level into small blocks of bounded rows and words, eight of which are a large
    one. Signatures meet in pairs of large blocks; texts go only to the pairs of small blocks in which a row has a likely
    partner in another component. Only links that join components leave.
    """
    named = members.join(shuffled(labels.withColumnRenamed("node", "rep")), "rep", "left").select("band", "rep", F.coalesce("label", "rep").alias("label"))
    named = materialise(named, "dedup-labelled")
    mixed = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("rep").alias("first")).where("low <> high").select("band", "first")
    mixed = materialise(mixed, "dedup-buckets")
    here = materialise(named.join(shuffled(mixed), "band").select("rep", "label", "first"), "dedup-mixed")
    families = components(here.select(F.col("rep").alias("u"), F.col("first").alias("v")).where("u <> v"))
    step = math.log(100 / threshold)
    level = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("int")
    rows = here.select("rep", "label").distinct().join(shuffled(families.select(F.col("node").alias("rep"), F.col("label").alias("family"))), "rep").join(shuffled(reps), "rep")
    rows = materialise(rows.select("rep", "label", "n", "signature", "family", level.alias("level")), "dedup-families")
    sizes = rows.groupBy("family", "level").agg(F.ceil(F.greatest(F.count("*") / 1024, F.sum("n") / 400_000)).cast("int").alias("blocks"))
    sizes = materialise(sizes.select("family", "level", "blocks", F.ceil(F.col("blocks") / 8).cast("int").alias("large")), "dedup-blocks")
    at = lambda d, c: sizes.select("family", (F.col("level") - d).alias("level"), F.col("large").alias(c))
    near = sizes.join(at(1, "above"), ["family", "level"], "left").join(at(-1, "below"), ["family", "level"], "left")
    near, whole = materialise(near, "dedup-near"), rows
    rows = materialise(rows.join(shuffled(near), ["family", "level"]).withColumn("small", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "dedup-placed")
    block = F.floor(F.col("small") / 8).cast("int")
    none = F.array().cast("array<struct<level:int,up:boolean,i:int,j:int,right:boolean>>")
    many = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    task = lambda lv, up, i, j, right: F.struct(lv.alias("level"), F.lit(up).alias("up"), i.alias("i"), j.alias("j"), right.alias("right"))
    same = F.transform(many("large"), lambda o: task(F.col("level"), False, F.least(o, F.col("block")), F.greatest(o, F.col("block")), o < F.col("block")))
    above = F.when(F.col("above").isNotNull(), F.transform(many("above"), lambda o: task(F.col("level"), True, F.col("block"), o, F.lit(False)))).otherwise(none)
    below = F.when(F.col("below").isNotNull(), F.transform(many("below"), lambda o: task(F.col("level") - 1, True, o, F.col("block"), F.lit(True)))).otherwise(none)
    spread = rows.withColumn("block", block).withColumn("task", F.explode(F.concat(same, above, below)))
    by = ["family", "level", "up", "i", "j"]
    needed = spread.select("rep", "label", "signature", "small", "family", "task.*").groupBy(*by).applyInArrow(_needed(threshold), _NEED)
    needed = materialise(needed.distinct(), "dedup-needed")
    some = needed.select("rep").distinct()
    texts = docs.where("doc is not null").join(shuffled(some.select(F.col("rep").alias("doc"))), "doc", "left_semi").select(F.col("doc").alias("rep"), "text")
    texts = materialise(texts, "dedup-texts")
    ready = needed.join(shuffled(rows.select("rep", "label", "signature").distinct()), "rep").join(shuffled(texts), "rep")
    found = ready.groupBy(*by).applyInArrow(_linked(threshold, k), "a long, b long")
    links = materialise(found.distinct(), "dedup-links")
    discard(named, mixed, here, whole, sizes, near, rows, needed, texts)
    return links


def op8(docs: DataFrame) -> DataFrame:
    out = near_duplicates(docs.select("doc_id", "text"), k=2)
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 2 THEN w[1] ELSE w[p] || ' ' || w[p + 1] END AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 1))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM i JOIN n x ON u = x.doc_id JOIN n y ON v = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u, min(v) AS m FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id, least(d.doc_id, coalesce(c.m, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.u
"""
