"""Language identification by cross-parsing entropy.

For each language a suffix automaton of bounded pieces of labelled texts is built on the driver. A text is cut greedily
into the longest phrases that occur in that piece; few phrases mean a close language. Only letters and single spaces
count, in lower case. Texts are parsed in chunks of ``CHUNK`` symbols, all chunks of a batch side by side; this adds at
most one phrase a chunk, to every language alike. The language with the fewest phrases per symbol wins, by name on ties.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import append, held_out, id_text

CHUNK = 512
UNDECIDED = "und"


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``codes``; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return go


def letters(text: str) -> str:
    """Lower-case letters, other characters as single spaces."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Table:
    """A suffix automaton as a parse table over the symbols of its own text: 0 pads, 1 is a space, 2 a symbol it lacks.

    Few symbols make a dense table, many (as in Chinese) sorted keys of the transitions there are.
    """

    DENSE = 4_000_000

    def __init__(self, codes: list[int], symbols: int):
        """codes: 1 for a space, else numbers of letters, from 3 to below ``symbols``."""
        own = sorted(set(codes) - {1})
        self.local = np.full(symbols, 2, np.int32)
        self.local[0], self.local[1] = 0, 1
        self.local[own] = np.arange(3, 3 + len(own))
        self.width = width = 3 + len(own)
        go = suffix_automaton([int(self.local[c]) for c in codes])
        alone = len(go)  # after a symbol that the text lacks: it is a phrase of its own, and the next symbol ends it
        self.root = np.full(width, alone, np.int64)
        for c, s in go[0].items():
            self.root[c] = s
        self.dense = self.keys = None
        if (alone + 1) * width <= self.DENSE:
            # [state * width + symbol] -> 2 * next state * width + (1 if a phrase ends before the symbol)
            table = np.tile(2 * self.root * width + 1, (alone + 1, 1))
            for s, out in enumerate(go):
                for c, to in out.items():
                    table[s, c] = 2 * to * width
            table[:, 0] = 2 * np.arange(alone + 1) * width
            table[0, :] &= ~1  # nothing is open at the start
            self.dense = table.astype(np.int32).ravel()
        else:
            pairs = sorted((s * width + c, to) for s, out in enumerate(go) for c, to in out.items())
            self.keys, self.to = (np.array(v, np.int64) for v in zip(*pairs, strict=True))

    def parse(self, rows: np.ndarray) -> np.ndarray:
        """Phrases of each column of symbols; columns are padded with 0 at the end."""
        ends = np.ones(rows.shape[1], np.int32)
        if self.dense is not None:
            state = np.zeros(rows.shape[1], np.int32)
            for row in rows:
                state += self.local.take(row)
                state = self.dense.take(state)
                ends += state & 1
                state >>= 1
            return ends
        state = np.zeros(rows.shape[1], np.int64)
        for row in rows:
            c = self.local.take(row)
            key = state * self.width + c
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[at] == key
            pad = c == 0
            ends += ~on & ~pad & (state != 0)
            state = np.where(pad, state, np.where(on, self.to[at], self.root[c]))
        return ends


class Model:
    """One parse table a language over the letters of all samples. Symbols: 0 pads, 1 is a space, 2 a letter of no sample."""

    def __init__(self, samples: dict[str, str]):
        self.symbols = {c: k + 3 for k, c in enumerate(sorted(set("".join(samples.values())) - {" "}))}
        self.langs = sorted(samples)
        self.tables = [Table([1 if c == " " else self.symbols[c] for c in samples[x]], len(self.symbols) + 3) for x in self.langs]


class Parser:
    def __init__(self, model: Model):
        self.model = model
        self.code = np.ones(0x110000, np.int32)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                self.code[c] = model.symbols.get(chr(c).lower()[:1], 2)

    def symbols(self, text: str | None) -> np.ndarray:
        """Symbols of a text, without runs of spaces and those at the ends."""
        if not text:
            return np.zeros(0, np.int32)
        s = self.code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        space = s == 1
        keep = ~space
        keep[1:] |= ~space[:-1]
        s = s[keep]
        return s[1 if len(s) and s[0] == 1 else 0 : len(s) - 1 if len(s) and s[-1] == 1 else None]

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """[text, language] -> phrases, and each text's number of symbols."""
        coded = [self.symbols(t) for t in texts]
        size = np.array([len(s) for s in coded], np.int64)
        chunks = -(-size // CHUNK)
        owner = np.repeat(np.arange(len(texts)), chunks)
        out = np.zeros((len(texts), len(self.model.langs)), np.int64)
        if not len(owner):
            return out, size
        first = np.cumsum(chunks) - chunks
        lanes = np.zeros((len(owner), CHUNK), np.int32)
        for k, s in enumerate(coded):
            if n := len(s):
                lanes[first[k] : first[k] + chunks[k]].ravel()[:n] = s
        for a in range(0, len(owner), 16384):
            part = np.ascontiguousarray(lanes[a : a + 16384].T)
            longest = int(np.flatnonzero(part.any(axis=1))[-1]) + 1
            for k, table in enumerate(self.model.tables):
                np.add.at(out[:, k], owner[a : a + 16384], table.parse(part[:longest]))
        return out, size


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc: str = "doc_id", chars: int = 12_000, sample: int = 40, most: int = 1000) -> Model:
    """Learn from labelled rows that are not held out.

    Bound: about ``sample`` documents a language, drawn by a hash of the id, and ``chars`` normalised characters a
    language in all, shared among them: of each drawn text a piece from a hashed place. Labels are a small set: more than
    ``most`` of them are an error.
    """
    rows = docs.where(~held_out(doc)).select(F.col(lang).alias("l"), F.col(text).alias("t"), F.xxhash64(id_text(doc), F.lit("langid")).alias("h"))
    rows = rows.where(F.col("l").isNotNull() & F.col("t").isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy("l").count().limit(most + 1).collect()}
    if len(counts) > most:
        raise ValueError(f"more than {most} languages; is {lang} a label?")
    if not counts:
        return Model({})
    part = F.lit(False)
    for name, n in counts.items():
        share = min(1.0, 2 * sample / n)
        part = part | ((F.col("l") == name) & (F.pmod("h", F.lit(1_000_000)) < int(share * 1_000_000) + 1))
    # Of a longer text, ``chars`` characters from a hashed place are sent.
    start = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length("t") - chars + 1)) + 1
    drawn = rows.where(part).select("l", F.substring("t", start.cast("int"), F.lit(chars)).alias("t"), "h").collect()
    samples: dict[str, str] = {}
    for name in counts:
        own = [(r["h"], letters(r["t"])) for r in sorted((r for r in drawn if r["l"] == name), key=lambda r: (r["h"], r["t"]))]
        own = [(h, t) for h, t in own if t][:sample]
        if own:
            each = max(200, chars // len(own))
            cut = lambda h, t: t[(k := h % max(1, len(t) - each + 1)) : k + each]
            samples[name] = " ".join(cut(h, t).strip() for h, t in own)[: chars + each]
    return Model(samples)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score.

    score: phrases of the second-best language over those of the best two, 0.5 when they tie and nearer to 1 the clearer
    the winner; 1 when there is one language. Null texts, texts without a letter, and all texts when nothing could be
    learned get ``und`` and 0. Repeated rows get equal results, an empty table gives an empty one, and input columns with
    the names of results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit's parameters

    def start() -> Callable:
        parser = Parser(shared.value)
        langs = shared.value.langs

        def work(texts: list) -> list:
            pred, score = [], []
            for a in range(0, len(texts), 1000):
                part = texts[a : a + 1000]
                if not langs:
                    pred += [UNDECIDED] * len(part)
                    score += [0.0] * len(part)
                    continue
                n, size = parser.phrases(part)
                best = n.argmin(axis=1)
                low = np.sort(n, axis=1)[:, :2].astype(float)
                s = low[:, 1] / np.maximum(low.sum(axis=1), 1) if len(langs) > 1 else np.ones(len(part))
                pred += [langs[b] if z else UNDECIDED for b, z in zip(best, size, strict=True)]
                score += [float(x) if z else 0.0 for x, z in zip(s, size, strict=True)]
            return [pred, score]

        return work

    return append(docs, text, [("lang_pred", "string"), ("score", "double")], start)


def op3(docs: DataFrame) -> DataFrame:
    model = fit(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
