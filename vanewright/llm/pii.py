"""Personal data: base patterns, and a character BiLSTM-CRF trained on their spans.

The base patterns give labelled spans on a bounded sample of texts. Copies of these spans are rewritten into forms the
patterns miss (``(at)`` for @, phones without +), so that the tagger learns them too. In inference every text is gone
through whole in overlapping windows, every one of which is tagged: emissions are averaged where windows overlap, more
weight on their middles, and each text has one global best path. Where no stretch of other tags could score more than
"outside" throughout, every best path is outside, so the path is only computed between such places. Spans the tagger adds
keep off base spans and must pass their kind's check (Luhn, octets, digits).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.llm.bilstm_crf import Tagger, viterbi
from vanewright.llm.common import append, held_out, id_text

KINDS = ("email", "ip", "card", "phone")
#: Length of training windows; length and step of windows in inference; windows tagged together; windows held at once.
WIDTH, LONG, STEP, TOGETHER, HELD = 96, 768, 720, 512, 1024
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can't start inside a run of digits: it would have started at the run's first.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_WRITTEN = re.compile(r"[A-Za-z0-9._%+-]+\x20?(?:@|[(\[]\x20?at\x20?[)\]])\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[A-Za-z0-9-]+)+")
_BARE = re.compile(r"\(?[0-9]{2,4}\)?(?:[\x20.-]?\(?[0-9]{2,4}\)?){2,4}")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _ip_ok(s: str) -> bool:
    parts = [p.lstrip("0") for p in s.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _card_ok(s: str) -> bool:
    d = re.sub("[^0-9]", "", s)
    return 13 <= len(d) <= 19 and luhn(d)


def _phone_ok(s: str) -> bool:
    return 9 <= sum(map(str.isdigit, s)) <= 15


def _emails(text: str) -> list[Span]:
    """Linear: around each @, the longest local part after the last match and the domain behind it."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        m = _AT.match(text, at)
        start = at
        while m and start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            out.append((0, start, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return out


def base(text: str | None) -> list[Span]:
    """(kind number, start, end) of the contract's patterns, by kind, then start."""
    if not text or not _ANY.search(text):
        return []
    out = _emails(text)
    for kind, pattern, ok in ((1, _IP, _ip_ok), (2, _CARD, _card_ok), (3, _PHONE, _phone_ok)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if ok(m.group())]
    return out


def _codes() -> np.ndarray:
    """Printable ASCII has a symbol each; newlines, other letters and everything else share one each; 0 pads."""
    table = np.full(0x110000, 3, np.uint8)
    table[0xC0:0x3000] = 2
    table[10] = 1
    table[32:127] = np.arange(4, 99)
    return table


SYMBOLS = 99


class Model:
    def __init__(self, tagger: Tagger | None):
        self.tagger = tagger

    def start(self) -> Model:
        self.table = _codes()
        self.weight = (1.0 - np.abs(np.linspace(-1, 1, LONG)) * 0.9).astype(np.float32)[:, None]
        if self.tagger is not None:
            self.tagger.ready()
            self.margin, self.bounds = self.tagger.margin(), self.tagger.bounds()
        return self

    def found(self, texts: list[str | None], known: list[list[Span]]) -> list[list[Span]]:
        """Spans that the tagger adds to each text's ``known`` ones."""
        if self.tagger is None:
            return [[] for _ in texts]
        return [self._checked(t or "", x, y) for t, x, y in zip(texts, self.tagged(texts), known, strict=True)]

    def tagged(self, texts: list[str | None]) -> list[list[Span]]:
        """Spans of each text's best path. Texts of all lengths are gone through alike, ``HELD`` windows at a time."""
        out: list[list[Span]] = [[] for _ in texts]
        runs: list[tuple[int, int, np.ndarray]] = []
        size = 0
        for run in self._runs((k, self.table[np.frombuffer(t.encode("utf-32-le"), np.uint32)]) for k, t in enumerate(texts) if t):
            runs.append(run)
            size += len(run[2])
            if size > 1_000_000:
                self._decode(runs, out)
                runs, size = [], 0
        self._decode(runs, out)
        return [sorted(spans, key=lambda s: s[1]) for spans in out]

    def _decode(self, runs: list[tuple[int, int, np.ndarray]], out: list[list[Span]]) -> None:
        """Add the spans of the best path through each run (text, first position, emissions)."""
        runs.sort(key=lambda r: (len(r[2]), r[0], r[1]))
        a = 0
        while a < len(runs):
            b = a + 1
            while b < len(runs) and (b + 1 - a) * len(runs[b][2]) <= 200_000:
                b += 1
            e = np.zeros((len(runs[b - 1][2]), b - a, self.tagger.p["bias"].size), np.float32)
            mask = np.zeros(e.shape[:2], np.float32)
            for i, (_, _, own) in enumerate(runs[a:b]):
                e[: len(own), i], mask[: len(own), i] = own, 1
            best = viterbi(e, mask, self.tagger.p["trans"])
            for i, (k, start, own) in enumerate(runs[a:b]):
                out[k] += [(kind, start + s, start + e) for kind, s, e in _spans(best[: len(own), i])]
            a = b

    def _emissions(self, windows: list[np.ndarray]) -> list[np.ndarray]:
        """Of each window; windows of like lengths go together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(windows)
        order = sorted(range(len(windows)), key=lambda k: len(windows[k]))
        for a in range(0, len(order), TOGETHER):
            own = order[a : a + TOGETHER]
            codes = np.zeros((len(windows[own[-1]]), len(own)), np.uint8)
            for i, k in enumerate(own):
                codes[: len(windows[k]), i] = windows[k]
            e = self.tagger.fast(codes).transpose(1, 0, 2)
            for i, k in enumerate(own):
                out[k] = e[i, : len(windows[k])]
        return out

    def _runs(self, texts: Iterable[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs (text, first position, emissions) of places that are not certainly outside, with the certain ones beside them."""
        tags = self.tagger.p["bias"].size
        certain = np.full((1, tags), -1e9, np.float32)
        certain[0, 0] = 0
        both = LONG - STEP  # places that a window shares with the next
        rise = self.weight[:both] / (self.weight[:both] + self.weight[STEP:])
        over = np.zeros((0, tags), np.float32)  # the last places of the window before
        at, open_at, gain = [], [], []  # open places of the text so far, their emissions, and all places' gains
        windows = ((k, codes, a) for k, codes in texts for a in _starts(len(codes)))
        while held := list(islice(windows, HELD)):
            made = self._emissions([codes[a : a + LONG] for _, codes, a in held])
            first = 0
            for last, (k, codes, a) in enumerate(held):
                ends = a + LONG >= len(codes)
                if not ends and last + 1 < len(held):
                    continue
                begin, end = held[first][2], min(len(codes), a + LONG)
                mean = np.empty((end - begin, tags), np.float32)
                for (_, _, s), e in zip(held[first : last + 1], made[first : last + 1], strict=True):
                    own = mean[s - begin : s - begin + len(e)]
                    own[:] = e
                    if s:
                        own[:both] = over + (own[:both] - over) * rise
                    over = e[STEP:]
                mean = mean[: (len(codes) if ends else a + STEP) - begin]
                lead = _lead(mean)
                places = np.flatnonzero(lead <= self.margin)
                gain.append(-lead)
                at.append(begin + places)
                open_at.append(mean[places])
                first = last + 1
                if ends:
                    places, e = np.concatenate(at), np.concatenate(open_at)
                    worth = _worth(np.concatenate(gain), *self.bounds)[places]
                    places, e = places[worth], e[worth]
                    at, open_at, gain = [], [], []
                    cuts = np.flatnonzero(np.diff(places) != 1) + 1
                    for lo, hi in zip([0, *cuts], [*cuts, len(places)], strict=True):
                        if lo < hi:
                            before, after = int(places[lo] > 0), int(places[hi - 1] + 1 < len(codes))
                            yield k, int(places[lo] - before), np.concatenate([*[certain] * before, e[lo:hi], *[certain] * after])

    @staticmethod
    def _checked(text: str, extra: list[Span], known: list[Span]) -> list[Span]:
        out = []
        for kind, a, b in sorted(extra, key=lambda s: (s[1], s[2])):
            piece = text[a:b]
            a += len(piece) - len(piece.lstrip())
            piece = piece.strip()
            b = a + len(piece)
            ok = (lambda s: bool(_WRITTEN.fullmatch(s)), _ip_ok_text, _card_ok, lambda s: bool(_BARE.fullmatch(s)) and 10 <= sum(map(str.isdigit, s)) <= 15 and not s.isdigit())[kind](piece)
            clear = not (a and text[a - 1].isalnum() and text[a].isalnum()) and not (b < len(text) and text[b].isalnum() and text[b - 1].isalnum()) if piece else False
            if ok and clear and all(b <= s or a >= e for _, s, e in [*known, *out]):
                out.append((kind, a, b))
        return out


def _lead(e: np.ndarray) -> np.ndarray:
    """By how much tag 0 leads the best other tag."""
    top = e[:, 1].copy()
    for k in range(2, e.shape[1]):
        np.maximum(top, e[:, k], out=top)
    return e[:, 0] - top


def _worth(gain: np.ndarray, enter: float, stay: float, leave: float) -> np.ndarray:
    """Whether a place lies in a stretch whose gains over "outside" may be positive: ``gain`` of each place, ``stay`` for
    each further one, ``enter`` and ``leave`` at its ends but for those of the text. The best sum of a stretch around a
    place is the highest running sum from it on less the lowest before it."""
    x = gain.astype(np.float64) + stay
    x[0] += max(0.0, -enter)
    x[-1] += max(0.0, -leave)
    sums = np.concatenate([[0.0], np.cumsum(x)])
    best = np.maximum.accumulate(sums[:0:-1])[::-1] - np.minimum.accumulate(sums[:-1])
    return best >= stay - enter - leave - 1e-3


def _starts(size: int) -> list[int]:
    """Starts of the windows of a text: every STEP, until one reaches the end."""
    return list(range(0, max(1, size - (LONG - STEP)), STEP))


def _ip_ok_text(s: str) -> bool:
    return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", s)) and _ip_ok(s)


def _spans(tags: np.ndarray) -> list[Span]:
    """Tag 0 is outside; kind k begins with 2k + 1 and goes on with 2k + 2."""
    out: list[list[int]] = []
    for t in np.flatnonzero(tags):
        kind, begins = (int(tags[t]) - 1) // 2, int(tags[t]) % 2 == 1
        if out and out[-1][2] == t and out[-1][0] == kind and not begins:
            out[-1][2] = int(t) + 1
        else:
            out.append([kind, int(t), int(t) + 1])
    return [tuple(s) for s in out]


def rewritten(kind: int, piece: str, rng: np.random.Generator) -> str:
    """A form of a labelled span that the base patterns miss."""
    if kind == 0:
        at, dot = [("(at)", "."), ("[at]", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] ")][rng.integers(4)]
        name, _, domain = piece.partition("@")
        return name + at + domain.replace(".", dot)
    if kind == 3:
        return re.sub(r"^\+[0-9]{1,2}[\x20.-]*", "", piece)
    return piece


def varied(piece: str, rng: np.random.Generator) -> str:
    """The same form with other letters and digits."""
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    change = lambda c: lower[rng.integers(26)] if c in lower else digits[rng.integers(10)] if c in digits and rng.random() < 0.9 else c
    if "@" in piece:
        name, _, domain = piece.partition("@")
        return "".join(map(change, name)) + "@" + (domain if rng.random() < 0.5 else "".join(map(change, domain)))
    return "".join(change(c) if c in digits else c for c in piece)


def examples(texts: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training windows (codes, mask, tags) of pieces of text.

    Each piece with spans comes as it is, then with other letters, digits and following marks, and with the spans
    rewritten into forms that the base patterns miss. Small samples are gone through several times.
    """
    rng, table = np.random.default_rng(seed), _codes()
    rows: list[tuple[str, np.ndarray]] = []
    for text in texts * max(1, min(8, 2000 // max(1, len(texts)))):
        spans = sorted(base(text), key=lambda x: x[1])
        first = min((s for _, s, _ in spans), default=int(rng.integers(0, max(1, len(text) - WIDTH))))
        a = max(0, first - int(rng.integers(8, WIDTH // 2)))
        for change in (0, 1, 2) if spans else (0,):
            piece, tags, at = [], [], a
            for k, s, e in spans:
                if s < at:
                    continue
                piece.append(text[at:s])
                tags += [0] * (s - at)
                form = varied(text[s:e], rng) if change else text[s:e]
                form = rewritten(k, form, rng) if change == 2 else form
                mark = ("", "", ".", ",", "!!", ")", ";", '"')[rng.integers(8)] if change else ""
                piece.append(form + mark)
                tags += [2 * k + 1] + [2 * k + 2] * (len(form) - 1) + [0] * len(mark)
                at = e
            piece.append(text[at : at + WIDTH])
            tags += [0] * len(piece[-1])
            rows.append(("".join(piece)[:WIDTH], np.array(tags[:WIDTH], np.int64)))
    codes, tags = np.zeros((WIDTH, len(rows)), np.uint8), np.zeros((WIDTH, len(rows)), np.int64)
    for k, (p, t) in enumerate(rows):
        codes[: len(p), k] = table[np.frombuffer(p.encode("utf-32-le"), np.uint32)]
        tags[: len(t), k] = t
    return codes, (codes > 0).astype(np.float32), tags


def fit(docs: DataFrame, text: str = "text", doc: str = "doc_id", sample: int = 1500, pieces: int = 8, steps: int = 480) -> Model:
    """Train on about ``sample`` texts with a digit or @, drawn by a hash of the id from rows not held out. Of each text at
    most ``pieces`` pieces around these, drawn by a hash from all over the text, and one from anywhere are used. Without a
    labelled span there is no tagger, and the base patterns stand alone."""
    rows = docs.where(~held_out(doc)).select(F.col(text).alias("t"), F.xxhash64(id_text(doc), F.lit("pii")).alias("h")).where(F.col("t").rlike("[0-9@]"))
    total = rows.count()
    share = min(1.0, sample / max(1, total))
    around = F.regexp_extract_all("t", F.lit(r"(?s)(?:^|\s).{0,60}[0-9@].{0,120}(?:\s|$)"), F.lit(0))
    drawn = F.transform(F.slice(F.array_sort(F.transform(around, lambda w: F.struct(F.xxhash64(w, "h").alias("o"), w.alias("w")))), 1, pieces), lambda x: x["w"])
    anywhere = F.substring("t", (F.pmod("h", F.length("t")) + 1).cast("int"), F.lit(2 * WIDTH))
    rows = rows.where(F.pmod("h", F.lit(1_000_000)) < int(share * 1_000_000)).select("h", F.concat(drawn, F.array(anywhere)).alias("p")).collect()
    codes, mask, tags = examples([t for _, p in sorted((r["h"], r["p"]) for r in rows) for t in p if t])
    if not tags.any():
        return Model(None)
    tagger = Tagger(SYMBOLS, 1 + 2 * len(KINDS), hidden=12)
    tagger.fit(codes, mask, tags, steps=steps)
    return Model(tagger)


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add base and extra: arrays of (kind, start, end), by kind, then start; code points, end exclusive.

    Null and empty texts hold nothing; repeated rows get equal results; an empty table gives an empty one; columns with the
    names of results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters
    kind = "array<struct<kind:string,start:int,end:int>>"

    def start() -> Callable:
        ready = shared.value.start()
        rows = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans)]

        def work(texts: list) -> list:
            known = [base(t) for t in texts]
            extra = ready.found(texts, known)
            return [list(map(rows, known)), list(map(rows, extra))]

        return work

    return append(docs, text, [("base", kind), ("extra", kind)], start)


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    out = find(docs, fit(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    order = F.array(*map(F.lit, KINDS))
    every = F.array_sort(F.transform(F.concat("base", "extra"), lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return out.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(every).alias("spans"))
