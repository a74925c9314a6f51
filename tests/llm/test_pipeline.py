import re

import corpus_pipeline as cp
from vanewright.llm import decontam
from tests.llm.test_neardup import brute as near
from tests.llm.test_secrets import brute as found


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(10_000)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    automaton = decontam.automaton([(str(i), t) for i, t in bench])
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "language_id":
            want = {i for i, t in before.items() if re.search(r"[^\W\d_]", t or "")}
        elif name == "near_dedup":
            want = {i for i, (_, c) in near(list(before.items()), 5).items() if i == c}
        elif name == "decontaminate":
            want = set()
            for i, t in before.items():
                n, hit, _, _ = decontam.scan(t, [automaton])
                if not (hit and 20 * hit >= n):
                    want.add(i)
        elif name == "secret_scan":
            want = {i for i, t in before.items() if not found(t)}
        else:
            rows = out.collect()
            total = sum(len((t or "").split()) for t in before.values())
            assert abs(sum(r["taken"] for r in rows) - total) < 0.03 * total and {r["doc_id"] for r in rows} <= set(before)
            continue
        rows = out.collect()
        assert out.columns == cp.COLUMNS
        assert {r["doc_id"] for r in rows} == want and len(rows) == len(want), name
        assert 0 < len(want) <= len(before)
        docs = spark.createDataFrame(rows, out.schema)


def test_odd_rows(spark, odd, nothing, sf):
    for docs, most in ((odd, 11), (nothing, 0)):
        for name, stage in cp.STAGES:
            docs = stage(spark, docs, sf)
            rows = docs.collect()
            assert len(rows) <= most, name
            docs = spark.createDataFrame(rows, docs.schema)
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "decontaminate", "secret_scan", "mix"]
