"""Toxicity by gradient-boosted trees over dense features.

The lexicon (words and five-letter beginnings that mark toxic documents) is counted by Spark over a bounded labelled
sample; features of a training row use the lexicon of the other half, so chance words don't teach themselves. Features are
lexicon densities, nearness of lexicon words to the second person, capitals, punctuation, and obfuscation rates; the
trees' output is calibrated by isotonic regression on a fifth of the sample that the trees don't see.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.boosting import Trees, calibrated, isotonic
from vanewright.llm.common import append, held_out, id_text, materialise, shuffled
from vanewright.llm.neardup import near_duplicates

# Second-person words of English, German, French, Spanish.
SECOND = frozenset(w.encode() for w in "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu toi ton ta tes te vous votre vos tú ti tus usted ustedes vosotros vuestro".split())
_TABLE = bytes(b if chr(b).isalnum() or b >= 128 or b in (39,) else 32 for b in range(256))
_MASKED = re.compile(rb"[a-z\x80-\xff]+(?:[0-9@$*!|]+[a-z\x80-\xff]+)+")
_LEET = bytes.maketrans(b"013457@$!|", b"oieastasil")
_STRETCH = re.compile(rb"([a-z])\1\1+")
STEM = 5
FEATURES = ("density", "strongest", "strength", "hits", "stem_density", "stem_hits", "near_second", "second", "capitals", "shouted", "exclaims", "questions", "punctuation", "symbols", "masked", "masked_hits", "stretched", "digits", "log_words", "non_ascii")


def tokens(text: str) -> tuple[bytes, list[bytes]]:
    low = text.lower().encode()
    return low, low.translate(_TABLE).split()


def stem(word: bytes) -> bytes:
    return word[:STEM] if len(word) > STEM else b""


def features(text: str | None, lexicon: dict[bytes, float], stems: dict[bytes, float]) -> list[float]:
    """One row of FEATURES. Null and empty texts give zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    low, words = tokens(text)
    n = max(1, len(words))
    hits = [w for w in words if w in lexicon]
    stemmed = [s for w in words if (s := w[:STEM]) in stems and len(w) > STEM] if stems else []
    near = 0
    if hits and not SECOND.isdisjoint(words):
        at = np.flatnonzero([w in SECOND for w in words])
        own = np.flatnonzero([w in lexicon for w in words])
        k = np.searchsorted(at, own)
        gap = np.minimum(np.abs(own - at[np.minimum(k, len(at) - 1)]), np.abs(own - at[np.maximum(k - 1, 0)]))
        near = float((1 / (1 + gap)).sum())
    masked = _MASKED.findall(low)
    unmasked = sum((w.translate(_LEET)) in lexicon or w.replace(b"*", b"") in lexicon for w in masked)
    count = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = max(1, int(count.sum()))
    capitals = int(count[65:91].sum())
    letters = max(1, capitals + int(count[97:123].sum()))
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    return [
        len(hits) / n, max(map(lexicon.__getitem__, hits), default=0.0), sum(map(lexicon.__getitem__, set(hits))), float(np.log1p(len(hits))),
        len(stemmed) / n, float(np.log1p(len(stemmed))), near / n, sum(map(SECOND.__contains__, words)) / n,
        capitals / letters, sum(map(bytes.isupper, text.encode().split())) / n if capitals > letters / 4 else 0.0, int(count[33]) / n, int(count[63]) / n, marks / size,
        int(count[35] + count[36] + count[37] + count[38] + count[42] + count[64]) / size, len(masked) / n, unmasked / n, len(_STRETCH.findall(low)) / n,
        int(count[48:58].sum()) / size, float(np.log1p(len(words))), int(count[128:].sum()) / size,
    ]


class Model:
    def __init__(self, lexicon: dict[bytes, float], stems: dict[bytes, float], trees: Trees, steps: tuple[np.ndarray, np.ndarray]):
        self.lexicon, self.stems, self.trees, self.steps = lexicon, stems, trees, steps

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t, self.lexicon, self.stems) for t in texts], np.float64).reshape(len(texts), len(FEATURES))
        return calibrated(self.trees.raw(x), self.steps)


def sample(docs: DataFrame, labels: DataFrame, text: str, doc: str, label: str, toxic: int, clean: int) -> DataFrame:
    """(text, y, weight, fold): at most about ``toxic`` and ``clean`` labelled rows that aren't held out, by hash of the id."""
    own = labels.where(F.col(label).isin(0, 1) & ~held_out(doc)).select(F.col(doc).alias("doc"), F.col(label).cast("int").alias("y")).groupBy("doc").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    share = {1: min(1.0, toxic / max(1, counts.get(1, 0))), 0: min(1.0, clean / max(1, counts.get(0, 0)))}
    h = F.pmod(F.xxhash64(id_text("doc"), F.lit("toxicity")), F.lit(1_000_000))
    drawn = own.withColumn("h", h).where(F.col("h") < F.when(F.col("y") == 1, int(share[1] * 1e6)).otherwise(int(share[0] * 1e6)))
    drawn = drawn.withColumn("weight", F.when(F.col("y") == 1, 1 / share[1]).otherwise(1 / share[0])).withColumn("fold", F.pmod(F.xxhash64(id_text("doc"), F.lit("fold")), F.lit(10)).cast("int"))
    # The drawn ids are bounded by the two parameters, so they are broadcast.
    rows = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).join(F.broadcast(drawn), "doc")
    return materialise(rows.select("text", "y", "weight", "fold"), "toxicity-sample")


def _once(rows: DataFrame) -> DataFrame:
    """(fold, y, text) of the sample with near copies once: they would teach their chance words.

    One row of each component of near copies and label stays, so copies with different labels keep both.
    """
    named = rows.select("fold", "y", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("id"))
    near = near_duplicates(named, "text", "id").select(F.col("doc").alias("id"), "component").distinct()
    once = named.join(shuffled(near), "id").groupBy("component", "y").agg(F.min(F.struct("fold", "text")).alias("r"))
    return materialise(once.select("r.fold", "y", "r.text"), "toxicity-once")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        seen = {(f, y): Counter() for f in (0, 1) for y in (0, 1)}
        for t, y, fold in zip(pdf["text"], pdf["y"], pdf["fold"], strict=True):
            words = set(tokens(t or "")[1])
            seen[fold % 2, y].update(words)
            seen[fold % 2, y].update({b"^" + s for w in words if (s := stem(w))})
        rows = [(f, y, w.decode(errors="replace"), n) if w.decode(errors="replace").encode() == w else (f, y, w.hex() + "~", n) for (f, y), c in seen.items() for w, n in c.items()]
        yield pd.DataFrame(rows, columns=["half", "y", "term", "n"])


def _entries(counts: DataFrame, sizes: dict, halves: tuple[int, ...], most: int) -> tuple[dict, dict]:
    """Words and beginnings whose documents are toxic far beyond chance, with their strength.

    The test is a Chernoff bound on the binomial tail, with the level of one false entry in e among all terms tried; the
    strength is the logarithm of its exponent.
    """
    t, c = (max(1, sum(sizes.get((h, y), 0) for h in halves)) for y in (1, 0))
    q = t / (t + c)
    rows = counts.where(F.col("half").isin(*halves)).groupBy("term").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum("n").alias("d"))
    rate = F.col("a") / F.col("d")
    bound = F.col("d") * (rate * F.log(rate / q) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - q))).otherwise(0.0))
    rows = rows.where(F.col("a") >= 3)
    least = 1 + float(np.log(max(1, rows.count())))
    picked = rows.withColumn("bound", bound).where((rate > q) & (rate > 0.5) & (F.col("bound") > least)).orderBy(F.col("bound").desc(), "term").limit(most).collect()
    words, stems = {}, {}
    for r in picked:
        term = r["term"]
        raw = bytes.fromhex(term[:-1]) if term.endswith("~") else term.encode()
        (stems if raw[:1] == b"^" else words)[raw.removeprefix(b"^")] = float(np.log(r["bound"]))
    return words, stems


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc: str = "doc_id", label: str = "toxic", toxic: int = 6000, clean: int = 12000, most: int = 4000) -> Model:
    """Learn from a bounded sample: ``toxic`` and ``clean`` bound the rows, ``most`` the lexicon. Labels other than 0 and
    1 and rows without a document are left out; without both labels every score is the share of toxic labels."""
    rows = sample(docs, labels, text, doc, label, toxic, clean)
    once = _once(rows)
    sizes = {(r["half"], r["y"]): r["count"] for r in once.groupBy((F.col("fold") % 2).alias("half"), "y").count().collect()}
    counts = once.select("text", "y", "fold").mapInPandas(_counted, "half int, y int, term string, n long")
    counts = materialise(counts.groupBy("half", "y", "term").agg(F.sum("n").alias("n")), "toxicity-terms")
    other = {0: _entries(counts, sizes, (1,), most), 1: _entries(counts, sizes, (0,), most)}

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = [features(t, *other[f % 2]) for t, f in zip(pdf["text"], pdf["fold"], strict=True)]
            yield pd.DataFrame({"y": pdf["y"], "weight": pdf["weight"], "fold": pdf["fold"], "x": x})

    pdf = rows.mapInPandas(featured, "y int, weight double, fold int, x array<double>").toPandas()
    pdf = pdf.assign(key=pdf["x"].map(tuple)).sort_values(["fold", "y", "key"])  # the same model from any order of rows
    x, y, w = np.array(pdf["x"].tolist(), np.float64).reshape(len(pdf), len(FEATURES)), pdf["y"].to_numpy(np.float64), pdf["weight"].to_numpy(np.float64)
    aside = pdf["fold"].to_numpy() >= 8
    trees = Trees().fit(x[~aside], y[~aside], w[~aside])
    steps = isotonic(trees.raw(x[aside]), y[aside], w[aside]) if len(set(y[aside])) == 2 else (np.zeros(0), np.zeros(0))
    return Model(*_entries(counts, sizes, (0, 1), most), trees, steps)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add score (0 to 1) and predicted (1 from 0.5). Null texts count as empty; repeated rows get equal scores; an empty
    table stays empty; input columns with the names of results are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit's parameters

    def start() -> Callable:
        def work(texts: list) -> list:
            s = shared.value.scores(texts)
            return [s.tolist(), (s >= 0.5).astype(int).tolist()]

        return work

    return append(docs, text, [("score", "double"), ("predicted", "int")], start)


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
