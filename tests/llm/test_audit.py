import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from vanewright.llm import audit

from .conftest import ODD


def slow(docs, labels):
    """Filters applied one after another to lists of documents, for every part and order."""
    fails, seen = [], defaultdict(list)
    for d in docs:
        if d[0] is not None:
            seen[d[1] or ""].append(d[0])
    for doc, text, _, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0d]+", t)
        bad = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t), "E": doc is not None and any(s < doc for s in seen[t])}
        own = [x for x in labels if x[0] is not None and x[0] == doc]
        fails.append((source or "", {f for f in bad if bad[f]}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = {}
    for part in {f[0] for f in fails}:
        shapley = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            left = gone = None
            left, gone = [f for f in fails if f[0] == part], []
            for k, f in enumerate(order):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                unique = sum(d[1] == {f} for d in fails if d[0] == part)
                out[part, order, k + 1] = [len(left), len(removed), sum(f in d[1] for d in gone), unique, sum(d[2] for d in removed), sum(d[3] for d in removed)]
                gone += removed
                shapley[f] += len(removed)
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley[key[1][key[2] - 1]])
    return out


def check(spark, docs, rows, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): [r[f] for f in audit.FIGURES] for r in audit.op13(docs, table).collect()}
    assert got == slow(rows, labels)


LABELS = [(1, 1, 0), (3, None, 1), (6, 1, None), (6, 0, 1), (None, 1, 1), (8, 1, 1), (99, 1, 1)]
MORE = [
    (20, "A B C " * 30, "en", "a"), (21, "all different words of this text " + " ".join(map(str, range(60))), "en", "a"), (22, "all different words of this text " + " ".join(map(str, range(60))), "en", "b"),
    (19, "all different words of this text " + " ".join(map(str, range(60))), "de", "b"), (None, "all different words of this text " + " ".join(map(str, range(60))), "de", ""), (23, "50 % off " + "x y z " * 20, "en", "c"), (24, "ÄÖÜ ÉÈ" * 100, "fr", None),
]


def test_every_order_equals_filters_applied_one_by_one(spark, documents):
    rows = ODD + MORE
    check(spark, documents(rows), rows, LABELS)


def test_random_texts(spark, documents):
    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "GAMMA", "#", "delta", "EPSILON ZETA"] + [f"w{k}" for k in range(80)]
    rows = [(int(k % 70), " ".join(rng.choice(words, size=int(rng.integers(0, 120))).tolist()) if k % 3 else f"copy {k % 5}", None, f"s{k % 4}" if k % 7 else None) for k in range(150)]
    labels = [(int(k), int(rng.integers(0, 2)), int(rng.integers(0, 2))) for k in range(0, 70, 2)]
    check(spark, documents(rows), rows, labels)


def test_nothing(spark, nothing):
    assert audit.op13(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_many_parts_share_a_batch(spark, documents):
    rows = [(k, f"text {k // 2}", None, f"site{k}") for k in range(300)]
    out = audit.op13(documents(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert out.count() == 300 * 600
    assert out.where("step = 5").agg({"kept": "max"}).first()[0] == 0 and out.where("filter_order = 'EABCD' and step = 1").agg({"removed": "sum"}).first()[0] == 150


@pytest.mark.parametrize("figure", sorted(audit.SELECT))
def test_contraction_of_one_document(figure):
    """A lone document of each outcome is counted where its bits say."""
    for cell in range(32):
        t = np.zeros((1, 2, 2, 2, 2, 2), np.int64)
        t[(0, *[cell >> k & 1 for k in range(5)])] = 1
        got = audit.contract(t, figure)[0]
        for at, (order, k) in enumerate((o, k) for o in audit.ORDERS for k in range(5)):
            bad = {f for j, f in enumerate("ABCDE") if cell >> j & 1}
            before = bool(bad & set(order[:k]))
            want = {"kept": not before and order[k] not in bad, "removed": not before and order[k] in bad, "failing": order[k] in bad, "unique_fails": bad == {order[k]}}[figure]
            assert got[at] == want
