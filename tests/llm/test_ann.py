import numpy as np

from vanewright.llm import ann


def brute(rows, least=0.93):
    ok = {i: (np.array(v, float), lab) for i, v, lab in rows if lab is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    links = {i: set() for i, *_ in rows}
    for i, (x, a) in ok.items():
        for j, (y, b) in ok.items():
            if i != j and a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[i].add(j)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def made(n=700, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((40, dim))
    x = [(centres[k % 40] + rng.standard_normal(dim) * (0.12 if k % 3 else 0.6)).astype(np.float32) for k in range(n)]
    x[10] = x[11] = x[12]
    return [(i, [float(v) for v in x[i]], i % 3) for i in range(n)]


def test_against_all_pairs(spark):
    rows = made()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for shard in (60, 1000):  # many small shards, and one for each label
        got = {r["doc"]: (r["n_links"], r["component"], r["kept"]) for r in ann.near_duplicates(df, shard=shard).collect()}
        want = brute(rows)
        assert sum(n for n, _ in want.values()) > 500
        assert {i: g[:2] for i, g in got.items()} == want
        assert all(k == (i == c) for i, (_, c, k) in got.items())


def test_large_group_over_many_homes(spark):
    """Near copies, scaled copies and single vectors of one label, in shards that must be split."""
    rng = np.random.default_rng(5)
    c = rng.standard_normal(24)
    x = np.concatenate([c + rng.standard_normal((700, 24)) * 0.15, np.outer(1 + np.arange(250) / 7, rng.standard_normal(24)), rng.standard_normal((150, 24))])
    u = ann.unit(x)
    want = (u @ u.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in ann.op2(df).collect())
    assert [n for _, n, _ in got] == want.tolist()
    small = sorted((r["doc"], r["n_links"]) for r in ann.near_duplicates(df, shard=90).collect())
    assert [n for _, n in small] == want.tolist()


def test_last_resort_is_exact(spark):
    rows = made(300)
    found = ann.classes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    graph = ann.flat_graph(ann.placed_in_shards(found, 2, 40), 2)
    out = ann.search(graph, ann.possible_homes(graph, 0.93), 0.93, onward=False)
    got = {r["rep"]: r["n"] for r in out.where(f"kind = {ann.COUNT}").groupBy("rep").sum("value").toDF("rep", "n").collect()}
    want = brute(rows)
    assert all(got[r["rep"]] == want[r["rep"]][0] - (r["mult"] - 1) for r in found.collect() if r["mult"] == 1 and r["rep"] != 10)


def test_walk_reaches_what_is_in_range():
    rng = np.random.default_rng(3)
    x = ann.unit(rng.standard_normal((400, 24)))
    x = ann.unit(np.concatenate([x, x[:150] + rng.standard_normal((150, 24)) * 0.05, x[:1] + rng.standard_normal((200, 24)) * 0.02]))
    sims = x @ x.T
    seen = ann.walk(sims, ann.build(x), int(sims.sum(axis=1).argmax()), 0.93 - ann.SLACK)
    true = sims >= 0.93
    assert (true & seen).sum() >= 0.95 * true.sum()


def test_pruning_is_the_plain_one():
    rng = np.random.default_rng(9)
    x = ann.unit(rng.standard_normal((60, 4)))
    sims = x @ x.T
    for p in range(10):
        order = [int(c) for c in np.argsort(-sims[p]) if c != p][:20]
        kept: list[int] = []
        for c in order:
            if len(kept) < 6 and all(ann.ALPHA * (1 - sims[k, c]) > 1 - sims[p, c] for k in kept):
                kept.append(c)
        got = ann.robust_prune(sims[p, order][None], sims[np.ix_(order, order)][None], 6)
        assert [c for c, k in zip(order, got[0], strict=True) if k] == kept


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 0.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "'clash' as rep", "1 as component", "2 as x")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ann.op2(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (0, 10), 11: (2, 1), 12: (0, 12), None: (0, None)}
    assert ann.op2(df.where("false")).count() == 0
