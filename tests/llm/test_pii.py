import hashlib
import random
import re

import numpy as np

from vanewright.llm import pii
from vanewright.llm.bilstm_crf import Tagger, viterbi

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, p in enumerate(PLAIN):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(x) > 255 for x in m.group().split(".")) or kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)) or kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_is_the_contract():
    random.seed(2)
    for _ in range(20_000):
        t = "".join(random.choice("0123456789..@@--  +()aZ%é") for _ in range(random.randint(0, 40)))
        assert plain(t) == pii.base(t), t
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.base("9" * 200_000 + "." + "a" * 200_000 + "@") == []


def test_gradients():
    rng = np.random.default_rng(0)
    t = Tagger(9, 5, embed=3, hidden=4)
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()} | {"trans": rng.standard_normal((5, 5))}
    codes, tags, mask = rng.integers(1, 9, (7, 3)), rng.integers(0, 5, (7, 3)), np.ones((7, 3))
    mask[5:, 1] = mask[3:, 2] = 0
    _, g = t.loss(codes, mask, tags)
    for k, v in t.p.items():
        at = tuple(rng.integers(0, s) for s in v.shape)
        was = v[at]
        v[at] = was + 1e-5
        up = t.loss(codes, mask, tags)[0]
        v[at] = was - 1e-5
        down = t.loss(codes, mask, tags)[0]
        v[at] = was
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-7


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(1)
    e, trans = rng.standard_normal((5, 1, 3)), rng.standard_normal((3, 3))
    score = lambda p: sum(e[t, 0, k] for t, k in enumerate(p)) + sum(trans[a, b] for a, b in itertools.pairwise(p))
    assert tuple(viterbi(e, np.ones((5, 1)), trans)[:, 0]) == max(itertools.product(range(3), repeat=5), key=score)


def test_tagger_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = pii.fit(docs).start()
    held = [r["text"] for r in docs.where(pii.held_out("doc_id")).collect()]
    hit = total = 0
    for t, got in zip(held, model.tagged(held), strict=True):
        want = pii.base(t)
        total, hit = total + len(want), hit + sum(s in got for s in want)
    assert total > 5 and hit >= 0.8 * total
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = pii.op4(docs).collect()
    assert len(out) == docs.count()
    for r in out:  # the query's columns against brute force
        spans = plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == n for k, *_ in spans) for n in range(4)]
        text = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(text) <= set(r["spans"].split(","))


def test_every_window_of_every_text_is_tagged(monkeypatch):
    model = pii.Model(Tagger(pii.SYMBOLS, 9)).start()
    seen = []
    fast = model.tagger.fast
    monkeypatch.setattr(model.tagger, "fast", lambda codes: seen.append(codes.shape[1]) or fast(codes))
    for size in (0, 1, 5_000, 290_000, 310_000, 620_000):
        seen.clear()
        model.tagged(["plain words " * (size // 12 + 1)][: size > 0])
        assert sum(seen) == (len(pii._starts((size // 12 + 1) * 12)) if size else 0)


def slow_tags(model, text):
    """Emissions of the plain network, averaged over the windows, and one best path of the whole text."""
    codes = model.table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    total, share = np.zeros((len(codes), model.tagger.p["bias"].size)), np.zeros((len(codes), 1))
    for a in pii._starts(len(codes)):
        own = codes[a : a + pii.LONG][:, None]
        e = model.tagger.emissions(own, np.ones(own.shape, np.float32))[:, 0]
        total[a : a + len(e)] += e * model.weight[: len(e)]
        share[a : a + len(e)] += model.weight[: len(e)]
    return pii._spans(viterbi((total / share)[:, None], np.ones((len(codes), 1)), model.tagger.p["trans"])[:, 0])


def test_whole_texts_have_one_best_path(monkeypatch):
    rng = np.random.default_rng(4)
    random.seed(1)
    tagger = Tagger(pii.SYMBOLS, 9)
    tagger.p["trans"] = rng.standard_normal((9, 9)).astype(np.float32)
    tagger.p["out"] *= 6
    tagger.p["bias"][0] = 4
    model = pii.Model(tagger).start()
    texts = ["".join(random.choice("ab 12@.é+") for _ in range(n)) for n in (1, 40, pii.LONG - 1, pii.LONG, pii.LONG + 1, 2 * pii.LONG, 5000)]
    want = [slow_tags(model, t) for t in texts]
    assert sum(map(len, want)) > 100 and model.tagged(texts) == want
    model.margin = float("inf")
    assert model.tagged(texts) == want
    model.margin, model.bounds = tagger.margin(), (1e9, 1e9, 1e9)
    assert model.tagged(texts) == want
    model.bounds = tagger.bounds()
    for held in (1, 2, 3):  # texts cut over several rounds
        monkeypatch.setattr(pii, "HELD", held)
        assert model.tagged(texts) == want


def test_the_query_finds_what_the_plain_tagger_finds(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 4000")
    model = pii.fit(docs, steps=150).start()
    texts = {r["doc_id"]: r["text"] for r in docs.where(pii.held_out("doc_id")).collect()}
    rows = pii.find(docs, model).where(pii.held_out("doc_id")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        known = pii.base(texts[r["doc_id"]])
        want = model._checked(texts[r["doc_id"]], slow_tags(model, texts[r["doc_id"]]), known)
        assert [tuple(x) for x in r["extra"]] == [(pii.KINDS[k], a, b) for k, a, b in sorted(want)]


def test_tagger_finds_written_out_addresses(spark):
    """Held-out addresses in forms that the base patterns miss; about 700 labelled texts are needed to learn them."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.fit(docs).start()
    held = [r["text"] for r in docs.where(pii.held_out("doc_id") & docs["text"].contains("@")).collect()]
    rng = np.random.default_rng(9)
    forms = [(t[:a] + w + t[b:], w) for t in held for k, a, b in pii.base(t) if k == 0 for w in (pii.rewritten(0, t[a:b], rng),)]
    texts = [t for t, _ in forms]
    extra = model.found(texts, [pii.base(t) for t in texts])
    assert forms and sum(any(t[a:b] == w for _, a, b in e) for (t, w), e in zip(forms, extra, strict=True)) >= 0.8 * len(forms)
    assert model.found(["no version 2.0 or 1999 here"], [[]]) == [[]]


def test_odd_rows(odd, nothing):
    rows = pii.op4(odd).collect()
    assert len(rows) == 11 and all(r["spans"] == "" for r in rows)
    assert pii.op4(nothing).count() == 0
