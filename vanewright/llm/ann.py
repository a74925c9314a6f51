"""Near-duplicate embeddings by a robust-pruned flat graph built on overlapping cluster shards.

1. Equal vectors of a label become one class with a multiplicity.
2. Each class joins the shards of its ``overlap`` nearest centres, a hash sample of its label. Shards of more than twice
   ``shard`` classes are split around centres of their own until none is left, so neither the size of a shard nor the
   centres that one task sees grow with the data. The first shard of a class is its home.
3. In each shard every vector gets a robust-pruned list of near vectors, with reverse edges and a few random ones.
4. The lists that a class has in its shards are united: one flat graph, whose edges cross shards. Each edge knows its
   angle and its end's home.
5. Every class searches. It enters the homes of its nearest centres at their medoids, walks greedily, and expands over all
   vectors in range or a little out of it. In each home it enters, a blocked product with all vectors at home there
   verifies: it counts the links exactly, in double precision, and adds what the walk missed. Edges that leave for another
   home are followed unless the triangle inequality rules out a link behind them; a link that a home's vector was found
   with also sends that vector to the other's home. Searching goes on until nothing new is to be entered.
6. An audit compares a hash sample of queries with all rows. Below ``recall`` (mean over queries) the overlap grows, and
   at last every home is entered that the triangle inequality does not rule out, which is exact.

Tasks return counts, a spanning star of each component of their links, and homes to enter next: rows grow with the
vectors, not with the pairs of a group.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import discard, materialise, shuffled
from vanewright.llm.graphs import components

log = logging.getLogger(__name__)

#: Vectors of a shard aimed at, centres that one task sees at most, list length, random edges, pruning, beam of the walk.
SHARD, CENTRES, DEGREE, RANDOM, ALPHA, BEAM = 1000, 2048, 16, 2, 1.2, 24
#: Vectors that a list is pruned from.
POOL = 32
#: Expansion goes on from vectors that are this much under the threshold, since paths may leave the range.
SLACK = 0.06
#: Queries compared with a home in one task.
BLOCK = 2048


def classes(rows: DataFrame, vec: str = "embedding", doc: str = "vec_id", label: str = "label") -> DataFrame:
    """(rep, mult, label, dim, x): usable vectors, equal ones of a label as one row with the smallest id."""
    x = F.col(vec)
    usable = F.col(label).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = usable & F.exists(x, lambda v: v != 0)
    kept = rows.where(F.coalesce(usable, F.lit(False)) & F.col(doc).isNotNull())
    return kept.groupBy(F.col(label).cast("string").alias("label"), x.alias("x")).agg(F.min(doc).cast("long").alias("rep"), F.count("*").alias("mult")).select("rep", "mult", "label", F.size("x").alias("dim"), "x")


def unit(x) -> np.ndarray:
    m = np.array(x if isinstance(x, np.ndarray) and x.ndim == 2 else list(x), np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # no overflow of squares
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def robust_prune(near: np.ndarray, between: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """[p, k] -> kept, for candidates of each p in falling similarity ``near[p]``.

    A candidate c is kept while no kept one covers it, that is while alpha * d(kept, c) > d(p, c); ``degree`` at most.
    """
    n, pool = near.shape
    alive, kept, count = np.ones((n, pool), bool), np.zeros((n, pool), bool), np.zeros(n, int)
    for k in range(pool):
        take = alive[:, k] & (count < degree)
        kept[take, k] = True
        count += take
        alive &= ~take[:, None] | (alpha * (1 - between[:, k]) > 1 - near)
    return kept


def build(x: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Lists of near vectors (-1 fills up): pruned neighbours, random others, and up to ``degree`` reverse edges."""
    n = len(x)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    pool = min(n - 1, POOL)
    rng = np.random.default_rng(7)
    lists = np.full((n, degree), -1, np.int64)
    for a in range(0, n if pool > 0 else 0, 256):
        s = sims[a : a + 256]
        order = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        order = np.take_along_axis(order, np.argsort(-np.take_along_axis(s, order, 1), axis=1, kind="stable"), 1)
        kept = robust_prune(np.take_along_axis(s, order, 1), sims[order[:, :, None], order[:, None, :]], degree - RANDOM)
        first = np.argsort(~kept, axis=1, kind="stable")[:, : degree - RANDOM]
        found = np.where(np.take_along_axis(kept, first, 1), np.take_along_axis(order, first, 1), -1)
        lists[a : a + 256, : found.shape[1]] = found
    if n > 1:
        lists[:, degree - RANDOM :] = (np.arange(n)[:, None] + rng.integers(1, n, (n, RANDOM))) % n
    start, end = np.repeat(np.arange(n), degree), lists.ravel()
    start, end = start[end >= 0], end[end >= 0]
    order = np.lexsort((-sims[start, end], end))  # the nearest reverse edges of each end come first
    start, end = start[order], end[order]
    place = np.arange(len(end)) - np.searchsorted(end, end)
    back = np.full((n, degree), -1, np.int64)
    ok = place < degree
    back[end[ok], place[ok]] = start[ok]
    back[(back[:, :, None] == lists[:, None, :]).any(axis=2)] = -1
    return np.concatenate([lists, back], axis=1)


def walk(sims: np.ndarray, graph: np.ndarray, start: int, least: float, beam: int = BEAM) -> np.ndarray:
    """[query, vector] -> reached: greedily from the medoid ``start``, then over everything at ``least`` or nearer.

    ``sims`` are the similarities of queries and vectors, ``graph`` the lists of the vectors among themselves.
    """
    q, n = sims.shape
    seen, opened = np.zeros((q, n), bool), np.zeros((q, n), bool)
    seen[:, start] = True
    top = np.full((q, min(beam, n)), start)
    rows = np.arange(q)
    width = top.shape[1]
    while len(rows):  # open the best unopened vector of each query's beam
        score = np.where(opened[rows[:, None], top[rows]], -3.0, sims[rows[:, None], top[rows]])
        best = score.argmax(axis=1)
        more = score[np.arange(len(rows)), best] > -3
        rows = rows[more]
        nodes = top[rows, best[more]]
        opened[rows, nodes] = True
        near = graph[nodes]
        new = (near >= 0) & ~seen[rows[:, None], near]
        a, b = np.nonzero(new)
        seen[rows[a], near[a, b]] = True
        every = np.concatenate([top[rows], np.where(new, near, start)], axis=1)
        rank = np.where(np.concatenate([np.ones((len(rows), width), bool), new], axis=1), sims[rows[:, None], every], -3.0)
        pick = np.argpartition(-rank, width - 1, axis=1)[:, :width]
        top[rows] = np.take_along_axis(every, pick, 1)
    edges = None
    while True:  # range expansion
        front = seen & ~opened & (sims >= least)
        a, b = np.nonzero(front)
        if not len(a):
            return seen
        opened |= front
        if len(a) > q * n / 10:  # most are in range of each other: one product instead of lists
            if edges is None:
                edges = np.zeros((n, n + 1), np.float32)
                edges[np.repeat(np.arange(n), graph.shape[1]), graph.ravel()] = 1
            seen |= (front.astype(np.float32) @ edges[:, :n]) > 0
            continue
        for k in range(0, len(a), 100_000):
            near = graph[b[k : k + 100_000]]
            i, j = np.nonzero(near >= 0)
            seen[a[k : k + 100_000][i], near[i, j]] = True


def stars(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest id of its component) of every node with a link in a block of queries ``left`` and vectors ``right``."""
    low, top = left.copy(), right.copy()
    some, other = hit.any(axis=1), hit.any(axis=0)
    big = np.iinfo(np.int64).max
    h = hit[np.ix_(some, other)]
    a, b = low[some], top[other]
    while len(a):
        before = a.copy(), b.copy()
        for k in range(0, len(a), 256):
            a[k : k + 256] = np.minimum(a[k : k + 256], np.where(h[k : k + 256], b[None, :], big).min(axis=1))
        for k in range(0, len(b), 256):
            b[k : k + 256] = np.minimum(b[k : k + 256], np.where(h[:, k : k + 256], a[:, None], big).min(axis=0))
        if np.array_equal(a, before[0]) and np.array_equal(b, before[1]):
            break
    return np.concatenate([left[some], right[other]]), np.concatenate([a, b])


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    flat = table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _nearest(x: np.ndarray, c: np.ndarray, rep: np.ndarray, most: int) -> np.ndarray:
    """Numbers of the ``most`` nearest centres; centres that are as good as equal are dealt by a hash of the id."""
    most = min(most, len(c))
    score = x @ c.T + ((rep[:, None] % 1_000_003) * 40_503 + np.arange(len(c)) * 7919) % 1_000_003 * 1e-13
    near = np.argpartition(-score, most - 1, axis=1)[:, :most]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(score, near, 1), axis=1, kind="stable"), 1)


def _drawn(found: DataFrame, share, salt: str) -> DataFrame:
    return found.where(F.pmod(F.xxhash64("rep", F.lit(salt)), F.lit(1 << 30)) < F.floor(share * float(1 << 30)))


def _assigned(found: DataFrame, shard: int, probes: int) -> DataFrame:
    """Add ``shards``: numbers of the nearest centres of the row's label and dimension, nearest first."""
    total = found.count()
    out: dict = {}
    for number, r in enumerate(_drawn(found, F.lit(min(1.0, 2 / shard, CENTRES / max(total, 1))), "centre").select("label", "dim", "x").orderBy(F.xxhash64("rep")).limit(2 * CENTRES).collect(), start=1):
        numbers, xs = out.setdefault((r["label"], r["dim"]), ([], []))
        numbers.append(number)
        xs.append(r["x"])
    # A bounded number of centres, whatever the number of vectors.
    shared = found.sparkSession.sparkContext.broadcast({k: (np.array(n), unit(x)) for k, (n, x) in out.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shards = np.empty(len(pdf), object)
            for key, at in pdf.groupby(["label", "dim"]).indices.items():
                numbers, c = shared.value.get(key, (np.zeros(1, int), None))
                near = numbers[_nearest(unit(pdf["x"].iloc[at]), c, pdf["rep"].to_numpy()[at], probes)] if c is not None else np.zeros((len(at), 1), int)
                for k, row in zip(at, near, strict=True):
                    shards[k] = row.tolist()
            yield pdf.assign(shards=shards)

    return found.mapInPandas(run, found.schema.simpleString()[7:-1] + ", shards array<bigint>")


def _split(placed: DataFrame, overlap: int, shard: int, level: int) -> DataFrame | None:
    """``placed`` with the shards of more than twice ``shard`` classes split around their own centres; None if none is."""
    key = ["label", "dim", "cell"]
    sizes = placed.select("label", "dim", F.explode(F.slice("shards", 1, overlap)).alias("cell")).groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 2 * shard)
    big = materialise(sizes, "ann-big")
    if big.isEmpty():
        return None
    parts = placed.select("rep", "label", "dim", F.posexplode("shards").alias("pos", "cell"))
    inside = materialise(parts.join(shuffled(big), key).join(shuffled(placed.select("rep", "x")), "rep"), "ann-inside")
    own = inside.where("pos = 0")
    centres = _drawn(own, F.least(F.lit(1.0), F.lit(2.0) / shard, F.lit(float(CENTRES)) / F.col("n")), f"centre{level}")
    centres = materialise(centres.select(*key, "x", "n"), "ann-centres").withColumn("block", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / 20_000).cast("int"))))
    dealt = inside.withColumn("block", F.pmod(F.xxhash64("rep"), F.floor(F.col("n") / 20_000) + 1).cast("int"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("rep", pa.int64()), ("pos", pa.int32()), ("cells", pa.list_(pa.int64()))])
        if not right.num_rows:
            return schema.empty_table()
        cell, pos = right["cell"][0].as_py(), right["pos"].to_numpy()
        if not left.num_rows:
            return pa.table({"rep": right["rep"], "pos": right["pos"], "cells": right["cell"].to_numpy()[:, None].tolist()}, schema=schema)
        near = _nearest(unit(_matrix(right, "x")), unit(_matrix(left, "x")), right["rep"].to_numpy(), 2)
        near = cell * 4096 + near + 1
        return pa.table({"rep": right["rep"], "pos": right["pos"], "cells": [r.tolist() if p == 0 else [int(r[0])] for r, p in zip(near, pos, strict=True)]}, schema=schema)

    cells = centres.groupBy(*key, "block").cogroup(dealt.select("rep", "pos", *key, "block", "x").groupBy(*key, "block")).applyInArrow(run, "rep long, pos int, cells array<bigint>")
    rest = parts.join(shuffled(big), key, "left_anti").select("rep", "pos", F.array("cell").alias("cells"))
    joined = cells.unionByName(rest).groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("pos", "cells"))).alias("c"))  # as many as a class has shards
    shards = F.array_distinct(F.flatten(F.transform("c", lambda v: v["cells"])))
    return materialise(placed.drop("shards").join(shuffled(joined.select("rep", shards.alias("shards"))), "rep"), "ann-placed")


_LISTS = "rep long, ends array<bigint>, angles array<float>, homes array<bigint>"


def _lists(table: pa.Table) -> pa.Table:
    """The list of each vector of a shard: ends, their angles and homes."""
    table = table.sort_by("rep")
    x, rep, home = unit(_matrix(table, "x")), table["rep"].to_numpy(), table["home"].to_numpy()
    graph = build(x)
    at = np.repeat(np.arange(len(x)), graph.shape[1])
    to = graph.ravel()
    at, to = at[to >= 0], to[to >= 0]
    sims = np.concatenate([np.einsum("ij,ij->i", x[at[k : k + 50_000]], x[to[k : k + 50_000]]) for k in range(0, len(at), 50_000)] or [np.zeros(0)])
    cut = pa.array(np.searchsorted(at, np.arange(len(x) + 1)).astype(np.int32))
    lists = lambda v: pa.ListArray.from_arrays(cut, pa.array(v))
    return pa.table({"rep": rep, "ends": lists(rep[to]), "angles": lists(np.arccos(np.clip(sims, -1, 1)).astype(np.float32)), "homes": lists(home[to])})


#: What a search task returns: (COUNT, query, links), (EDGE, node, smallest id), (NEXT, query, home), (WALK, links reached, links).
COUNT, EDGE, NEXT, WALK = range(4)
_FOUND = "kind int, rep long, value long"


def _searched(least: float) -> Callable:
    """One block of queries in one home."""
    widest, schema = float(np.arccos(least)), pa.schema([("kind", pa.int32()), ("rep", pa.int64()), ("value", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left, here = left.sort_by("rep"), left["home"][0].as_py()
        rep, q = left["rep"].to_numpy(), right["rep"].to_numpy()
        x = unit(_matrix(left, "x"))
        sims = unit(_matrix(right, "x")) @ x.T
        counts = np.diff(left["ends"].combine_chunks().offsets.to_numpy())
        owner = np.repeat(np.arange(len(rep)), counts)
        end, angle, home = (left[c].combine_chunks().flatten().to_numpy() for c in ("ends", "angles", "homes"))
        inner = home == here
        graph = np.full((len(rep), max(1, int(np.bincount(owner[inner], minlength=1).max()))), -1, np.int64)
        o = owner[inner]
        graph[o, np.arange(len(o)) - np.searchsorted(o, o)] = np.searchsorted(rep, end[inner])
        reached = walk(sims, graph, int((x @ x.sum(axis=0)).argmax()), least - SLACK)
        hit = sims >= least
        mine = np.searchsorted(rep, q)
        own = np.flatnonzero(rep[np.minimum(mine, len(rep) - 1)] == q)
        hit[own, mine[own]] = False
        rows = [(COUNT, q, hit @ left["mult"].to_numpy()), (EDGE, *stars(hit, q, rep)), (WALK, np.array([int((hit & reached).sum())]), np.array([int(hit.sum())]))]
        spread = hit | reached & (sims >= least - SLACK)
        spread[own, mine[own]] = True
        o, h, a = owner[~inner], home[~inner], angle[~inner]
        order = np.lexsort((a, o, h))
        o, h, a = o[order], h[order], a[order]
        first = np.ones(len(o), bool)
        first[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
        o, h, a = o[first], h[first], a[first]
        for k in np.unique(h):
            at = h == k
            # An end at this angle of the vector may be in range only if the query is no nearer to the vector.
            able = spread[:, o[at]] & (np.cos(np.maximum(a[at] - widest - 1e-4, 0)) >= sims[:, o[at]])
            go = q[able.any(axis=1)]
            rows.append((NEXT, go, np.full(len(go), k)))
        origin = right["origin"].to_numpy()
        for k in np.unique(origin[origin != here]):
            back = rep[hit[origin == k].any(axis=0)]
            rows.append((NEXT, back, np.full(len(back), k)))
        rows = [(k, a, b) for k, a, b in rows if len(a)]
        return pa.table({"kind": np.concatenate([np.full(len(a), k) for k, a, _ in rows]), "rep": np.concatenate([a for _, a, _ in rows]), "value": np.concatenate([b for *_, b in rows])}).cast(schema)

    return run


def placed_in_shards(found: DataFrame, overlap: int, shard: int) -> DataFrame:
    placed, level = materialise(_assigned(found, shard, overlap + 2), "ann-placed"), 1
    while level < 5 and (finer := _split(placed, overlap, shard, level)) is not None:
        placed, level = finer, level + 1
    return placed.withColumn("home", F.element_at("shards", 1))


def flat_graph(placed: DataFrame, overlap: int) -> DataFrame:
    """Each class with the united list of its shards."""
    members = placed.select("label", "dim", F.explode(F.slice("shards", 1, overlap)).alias("shard"), "rep", "home", "x")
    lists = members.groupBy("label", "dim", "shard").applyInArrow(_lists, _LISTS)
    # A class has a few shards and a list a few dozen ends, so what meets in a row is bounded.
    united = lists.groupBy("rep").agg(F.collect_list(F.struct("ends", "angles", "homes")).alias("l")).select("rep", *[F.flatten(F.col("l")[c]).alias(c) for c in ("ends", "angles", "homes")])
    return materialise(placed.drop("shards").join(shuffled(united), "rep"), "ann-graph")


def search(graph: DataFrame, asked: DataFrame, least: float, onward: bool = True) -> DataFrame:
    """What all tasks return, from the first homes ``asked`` (rep, home) on, until nothing new is to be entered."""
    key, out, done, turn = ["label", "dim", "home"], None, None, 0
    queries = graph.select("rep", "label", "dim", "x", F.col("home").alias("origin"))
    while True:
        asked = materialise(asked, "ann-asked")
        ready = materialise(asked.join(shuffled(queries), "rep"), "ann-queries")
        sizes = materialise(ready.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "ann-blocks")
        q = ready.join(shuffled(sizes), key).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("blocks")
        g = graph.join(shuffled(sizes), key).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        hit = materialise(g.groupBy(*key, "block").cogroup(q.groupBy(*key, "block")).applyInArrow(_searched(least), _FOUND), "ann-found")
        discard(ready, sizes)
        out = hit if out is None else out.unionByName(hit)
        done = asked if done is None else done.unionByName(asked)
        turn += 1
        if not onward:
            return out
        asked = hit.where(F.col("kind") == NEXT).select("rep", F.col("value").alias("home")).distinct().join(shuffled(done), ["rep", "home"], "left_anti")
        asked = materialise(asked, "ann-asked")
        if asked.isEmpty():
            walked = out.where(F.col("kind") == WALK).agg(F.sum("rep"), F.sum("value")).first()
            log.info("search: %s turns; the walk alone reached %s of %s links in the homes entered", turn, *walked)
            return out


def possible_homes(graph: DataFrame, least: float) -> DataFrame:
    """(rep, home): every home of a class's label that the triangle inequality does not rule out. Exact, for the last resort."""
    key, widest = ["label", "dim", "home"], float(np.arccos(least))

    def ball(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(pdf["x"])
        c = x[int((x @ x.sum(axis=0)).argmax())]
        return pdf[key].head(1).assign(c=[c.tolist()], radius=float(np.arccos(np.clip(x @ c, -1, 1)).max()))

    balls = materialise(graph.select(*key, "x").groupBy(*key).applyInPandas(ball, "label string, dim int, home long, c array<double>, radius double"), "ann-balls")
    sizes = graph.groupBy("label", "dim").agg(F.ceil(F.count("*") / 8192).cast("int").alias("b1")).join(balls.groupBy("label", "dim").agg(F.ceil(F.count("*") / 4096).cast("int").alias("b2")), ["label", "dim"])
    sizes = materialise(sizes, "ann-ball-blocks")
    many = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = graph.select("rep", "label", "dim", "x").join(sizes, ["label", "dim"]).withColumn("i", F.pmod(F.xxhash64("rep"), F.col("b1")).cast("int")).withColumn("j", many("b2")).drop("b1", "b2")
    right = balls.join(sizes, ["label", "dim"]).withColumn("j", F.pmod(F.xxhash64("home"), F.col("b2")).cast("int")).withColumn("i", many("b1")).drop("b1", "b2")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"rep": pa.array([], pa.int64()), "home": pa.array([], pa.int64())})
        angle = np.arccos(np.clip(unit(_matrix(a, "x")) @ unit(_matrix(b, "c")).T, -1, 1))
        i, j = np.nonzero(angle - b["radius"].to_numpy()[None, :] <= widest + 1e-6)
        return pa.table({"rep": a["rep"].to_numpy()[i], "home": b["home"].to_numpy()[j]})

    by = ["label", "dim", "i", "j"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, "rep long, home long")


def audit(found: DataFrame, counts: DataFrame, least: float = 0.93, queries: int = 256) -> float:
    """Mean over sampled queries of the share of their true links that was counted; 1 when none has a link.

    About ``queries`` classes are drawn by a hash from all, and as many from those with links found; they are compared
    with all rows. counts: (rep, n).
    """
    total, some = found.count(), counts.where("n > 0").count()
    linked = _drawn(counts.where("n > 0"), F.lit(min(1.0, queries / max(some, 1))), "audit").select("rep")
    drawn = _drawn(found, F.lit(min(1.0, queries / max(total, 1))), "audit-all").select("rep").union(linked).distinct()
    rows = found.join(F.broadcast(drawn), "rep").join(counts, "rep", "left").select("label", "dim", "rep", "x", F.coalesce("n", F.lit(0)).alias("n")).collect()
    own: dict = {}
    for r in rows:
        own.setdefault((r["label"], r["dim"]), []).append((r["rep"], r["x"]))
    shared = found.sparkSession.sparkContext.broadcast({k: (np.array([r for r, _ in v]), unit(x for _, x in v)) for k, v in own.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, at in pdf.groupby(["label", "dim"]).indices.items():
                if key in shared.value:
                    rep, c = shared.value[key]
                    hit = (c @ unit(pdf["x"].iloc[at]).T >= least) & (rep[:, None] != pdf["rep"].to_numpy()[at][None, :])
                    yield pd.DataFrame({"rep": rep, "n": hit @ pdf["mult"].to_numpy()[at]})

    true = {r["rep"]: r["n"] for r in found.mapInPandas(run, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n")).collect()}
    shares = [r["n"] / true[r["rep"]] for r in rows if true.get(r["rep"])]
    return float(np.mean(shares)) if shares else 1.0


def near_duplicates(rows: DataFrame, vec: str = "embedding", doc: str = "vec_id", label: str = "label", least: float = 0.93, overlap: int = 2, shard: int = SHARD, recall: float = 0.999) -> DataFrame:
    """(doc, n_links, component, kept), one row for each input row.

    Null, zero and non-finite vectors, null labels and null ids link with nothing; vectors of unlike length never link.
    Rows with equal vectors and labels link with each other. Rows that share an id are one vector to the components. An
    empty table gives an empty one. Other columns are not read.
    """
    found = materialise(classes(rows, vec, doc, label), "ann-classes")
    for width in (overlap, overlap + 1, None):
        if width is not None:
            placed = placed_in_shards(found, width, shard)
            graph = flat_graph(placed, width)
            out = search(graph, placed.select("rep", F.explode("shards").alias("home")), least)
        else:
            out = search(graph, possible_homes(graph, least), least, onward=False)
        counts = materialise(out.where(F.col("kind") == COUNT).groupBy("rep").agg(F.sum("value").alias("n")), "ann-counts")
        reached = audit(found, counts, least)
        log.warning("recall of the audited queries: %.6f with %s", reached, f"overlap {width}" if width else "every possible home")
        if reached >= recall:
            break
    label_of = components(out.where(F.col("kind") == EDGE).select(F.col("rep").alias("u"), F.col("value").alias("v")).where("u > v"))
    per = found.select("rep", "mult", "label", "x").join(shuffled(counts), "rep", "left").join(shuffled(label_of.withColumnsRenamed({"node": "rep", "label": "component"})), "rep", "left")
    per = materialise(per.select("label", "x", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component")), "ann-result")
    left = rows.select(F.col(doc).alias("doc"), F.when(F.col(doc).isNotNull(), F.col(label).cast("string")).alias("label"), F.col(vec).alias("x"))
    out = left.join(shuffled(per), ["label", "x"], "left")
    component = F.coalesce("component", F.col("doc").cast("long"))
    return out.select("doc", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def op2(rows: DataFrame) -> DataFrame:
    out = near_duplicates(rows.select("vec_id", "embedding", "label"))
    return out.select(F.col("doc").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND list_bool_and(list_transform(embedding, lambda v: isfinite(v))) AND list_bool_or(list_transform(embedding, lambda v: v <> 0))),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS m FROM r GROUP BY u),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(c.m, vec_id)) AS component_id, least(vec_id, coalesce(c.m, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.u LEFT JOIN n ON vec_id = n.u
"""
