import random

import pyarrow as pa

from vanewright.llm import neardup


def brute(rows, k, threshold=80):
    sets = {}
    for i, t in rows:
        sets[i] = neardup.shingles(t, k)
    ids = sorted(sets)
    near = {i: set() for i in ids}
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                near[i].add(j)
                near[j].add(i)
    out = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(sets[i]), min(seen))
    return out


def family(seed=0, n=260):
    """Copies of a few texts with more and more changed words, so that similarities lie on both sides of the limit."""
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdef") for _ in range(4))
    bases = [[word() for _ in range(random.choice([30, 120, 400]))] for _ in range(5)]
    rows = []
    for i in range(n):
        w = list(bases[i % 5])
        for _ in range(random.choice([0, 0, 1, 3, len(w) // 20, len(w) // 10])):
            w[random.randrange(len(w))] = word()
        rows.append((i + 1, " ".join(w)))
    return rows + [(n + 10, "single"), (n + 11, "Single "), (n + 12, "two words"), (n + 13, "TWO\tWORDS")]


def test_against_all_pairs(spark):
    rows = family()
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k in (2, 5):
        want = brute(rows, k)
        got = {r["doc"]: (r["n_shingles"], r["component"]) for r in neardup.near_duplicates(df, k=k).collect()}
        assert got == want
        assert len({c for _, c in want.values()}) > 20


def test_posterior_bound():
    need = neardup.fewest_matches(0.8, 1e-8)
    assert need[32] < 32 * 0.8 and need[160] < 160 * 0.8 and all(a <= b for a, b in zip(need, need[1:], strict=False))
    assert neardup.fewest_matches(0.8, 0.5)[160] > need[160]


def test_odd_rows(odd, nothing, spark):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.op8(odd).collect()]
    assert len(got) == 11
    by = {g[0]: g for g in got}
    assert by[1] == (1, 0, 1, True) and by[3] == (3, 0, 3, True) and by[None] == (None, 2, None, True) and by[6] == (6, 3, 6, True) and by[8][1] == 1
    assert neardup.op8(nothing).count() == 0


def test_components(spark):
    from vanewright.llm.graphs import components

    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 900)]
    want = {}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                m = min(want.get(a, a), want.get(b, b))
                want[a] = want[b] = m
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges + [(None, 1), (2, 2)], "u long, v long")).collect()}
    assert got == want


def test_empty_left_block():
    sketch = neardup.sketcher(2)
    texts = ["one two three four five", "one two three four six"]
    rows = [{"rep": i, "label": i, "signature": sketch(t)[3], "right": True, "text": t} for i, t in enumerate(texts)]
    for right, links in ((True, []), (False, [(0, 1)])):
        table = pa.Table.from_pylist([r | {"right": right} for r in rows])
        got = neardup._linked(60, 2)(table)
        assert list(zip(got["a"].to_pylist(), got["b"].to_pylist(), strict=True)) == links


def test_few_very_long_texts(spark):
    """Blocks count shingles too: two very long texts get two blocks, and both may fall into the second."""
    ids = [r["id"] for r in spark.range(1, 50).where("pmod(xxhash64(id), 2) = 1").orderBy("id").limit(2).collect()]
    random.seed(0)
    word = lambda: "".join(random.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(210_000)]
    texts = [base, base[:173_000] + [word() for _ in range(37_000)]]  # similar enough to share bands, not to link
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in zip(ids, texts, strict=True)], "doc_id long, text string")
    assert {r["doc"]: r["component"] for r in neardup.near_duplicates(df, k=2).collect()} == {i: i for i in ids}
