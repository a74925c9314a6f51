import random
import re

from vanewright.llm import decontam


def brute(docs, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, x in items:
            v = words(x)
            k = min(13, len(v))
            for a in range(max(1, len(v) - 12)) if v else ():
                for b in range(len(w) - k + 1):
                    if w[b : b + k] == v[a : a + k]:
                        hit.update(range(b, b + k))
                        ids.add(str(i))
        out[d] = (len(w), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def made():
    random.seed(5)
    vocab = ["the", "of", "Ünit", "a1", "x", "word", "naïve", "b-c", "It's"]
    item = lambda n: " ".join(random.choice(vocab) for _ in range(n))
    items = [(k, item(random.choice([1, 2, 5, 13, 14, 30]))) for k in range(12)] + [(50, None), (51, " . "), (3, item(20)), (None, item(15))]
    items = [x for x in items if x[1] is None or len(x[1].split()) != 1 or x[1].islower()]
    docs = []
    for d in range(60):
        parts = [item(random.randint(0, 40))]
        if d % 2:
            x = random.choice([i for i in items if i[1]])[1]
            parts += [x.upper() if d % 3 and x.isascii() else x.replace(" ", ", "), item(random.randint(0, 200))]
        docs.append((d, " ".join(parts)))
    return docs, items


def test_against_plain_windows(spark):
    docs, items = made()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").selectExpr("coalesce(cast(item_id as string), '') as item_id", "text")
    want = brute(docs, [("" if i is None else i, t) for i, t in items])
    for size in (4_000_000, 200):  # one automaton, and many
        rows = decontam.decontaminate(d.selectExpr("*", "'clash' as items", "'clash' as n_hit"), b, block_chars=size).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], sorted(r["items"]), r["contaminated"]) for r in rows} == want
        text = dict(docs)
        for r in rows:
            for h in r["hits"]:
                assert len(decontam.words(text[r["doc_id"]][h["start"] : h["end"]])) == h["last"] - h["first"] + 1


def test_odd_rows(spark, odd, nothing, sf):
    bench = spark.createDataFrame([(1, "one"), (2, None), (3, "word word word")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["contaminated"]) for r in decontam.op10(odd, bench).collect()}
    assert got[1] == (0, 0, False) and got[4] == (1, 1, True) and got[8] == (30_000, 30_000, True)
    assert decontam.op10(nothing, bench).count() == 0
    assert decontam.op10(odd, bench.where("false")).agg({"n_hit": "sum"}).first()[0] == 0
