import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from vanewright.llm import boosting, toxicity


def test_trees_and_steps():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    t = boosting.Trees().fit(x[:2000], y[:2000], np.ones(2000))
    assert ((t.raw(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    at, rate = boosting.isotonic(rng.standard_normal(500), rng.integers(0, 2, 500).astype(float), np.ones(500))
    assert (np.diff(rate) > 0).all() and (np.diff(at) > 0).all()
    s = boosting.calibrated(np.linspace(-5, 5, 50), (at, rate))
    assert (np.diff(s) >= 0).all() and s.min() >= 0 and s.max() <= 1


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op5(docs, labels).where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic) and sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    order = np.array([[a["score"] > b["score"] for b in clean] for a in toxic])
    assert order.mean() > 0.93


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(2, 1), (4, 0), (4, 0), (6, 1), (99, 1), (None, 0), (8, None), (9, 0)], "doc_id long, toxic int")
    rows = toxicity.op5(odd, labels).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert toxicity.op5(nothing, labels).count() == 0
    assert toxicity.op5(odd, labels.where(F.lit(False))).count() == 11


def test_lexicon_counts_distinct_texts(spark):
    random.seed(5)
    common = ["".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    copied = " ".join(random.choices(common, k=90))
    rows = []
    for i in range(400):
        w = [*common, *random.choices(common, k=60)]  # one language: every text has the same words
        random.shuffle(w)
        rows.append((i, " ".join([*w, "grobian"] if i % 4 == 0 else w), int(i % 4 == 0)))
    rows += [(1000 + i, f"{copied} chancy {i}", 1) for i in range(60)]  # near copies of one text count once
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels).lexicon
    assert b"grobian" in lexicon and b"chancy" not in lexicon


def test_near_copies_keep_both_labels(spark):
    text = " ".join(f"word{i}" for i in range(100))
    rows = [(text, 0, 1.0, 2), (f"{text} end", 1, 1.0, 3), (f"{text} end", 1, 1.0, 5), (text[::-1], 1, 1.0, 4), (None, 0, 1.0, 1), ("", 0, 1.0, 0)]
    once = toxicity._once(spark.createDataFrame(rows, "text string, y int, weight double, fold int"))
    assert sorted((r["fold"], r["y"]) for r in once.collect()) == [(0, 0), (2, 0), (3, 1), (4, 1)]


def slow_features(text, lexicon, stems):
    """The features, by their definitions, a character and a word at a time."""
    if not text:
        return [0.0] * len(toxicity.FEATURES)
    low = text.lower().encode()
    words, word = [], b""
    for b in [*low, 32]:
        if chr(b).isalnum() or b >= 128 or b == 39:
            word += bytes([b])
        else:
            words += [word] if word else []
            word = b""
    n = max(1, len(words))
    hits = [k for k, w in enumerate(words) if w in lexicon]
    second = [k for k, w in enumerate(words) if w in toxicity.SECOND]
    stemmed = [w for w in words if len(w) > 5 and w[:5] in stems]
    near = sum(1 / (1 + min(abs(k - s) for s in second)) for k in hits) if second else 0.0
    raw = text.encode()
    capitals, small = sum(65 <= b < 91 for b in raw), sum(97 <= b < 123 for b in raw)
    letters = max(1, capitals + small)
    marks = sum(33 <= b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 127 for b in raw)
    letter, join = rb"[a-z\x80-\xff]", rb"[0-9@$*!|]"
    masked = [m.group() for m in re.finditer(letter + b"+(?:" + join + b"+" + letter + b"+)+", low)]
    leet = dict(zip(b"013457@$!|", b"oieastasil", strict=True))
    bare = sum(bytes(leet.get(b, b) for b in w) in lexicon or bytes(b for b in w if b != 42) in lexicon for w in masked)
    stretched = len(list(re.finditer(rb"([a-z])\1\1+", low)))
    strength = [lexicon[w] for w in dict.fromkeys(words[k] for k in hits)]
    shouted = sum(w.isupper() for w in raw.split()) / n if capitals > letters / 4 else 0.0
    return [
        len(hits) / n, max(strength, default=0.0), sum(strength), math.log1p(len(hits)), len(stemmed) / n, math.log1p(len(stemmed)), near / n, len(second) / n, capitals / letters, shouted,
        raw.count(b"!") / n, raw.count(b"?") / n, marks / len(raw), sum(b in b"#$%&*@" for b in raw) / len(raw), len(masked) / n, bare / n, stretched / n, sum(48 <= b < 58 for b in raw) / len(raw), math.log1p(len(words)), sum(b >= 128 for b in raw) / len(raw),
    ]


def slow_score(model, text):
    x = slow_features(text, model.lexicon, model.stems)
    raw = model.trees.start
    for features, limits, leaf in model.trees.trees:
        at = 0
        while at < len(features):
            at = 2 * at + (2 if x[features[at]] > limits[at] else 1)
        raw += leaf[at - len(features)]
    chance = 1 / (1 + math.exp(-raw))
    base = chance
    if len(model.steps[0]):
        base = model.steps[1][0]
        for value, rate in zip(*model.steps, strict=True):
            base = rate if raw >= value else base
    return min(1.0, max(0.0, 0.98 * base + 0.02 * chance))


def test_query_is_the_plain_computation(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = toxicity.op5(docs, labels).collect()
    assert len(rows) == len(texts) and model.trees.trees and (model.lexicon or model.stems)
    for r in rows:
        assert abs(r["score"] - slow_score(model, texts[r["doc_id"]])) < 1e-9 and r["predicted"] == int(r["score"] >= 0.5)
