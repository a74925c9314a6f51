"""Token counts with a whole-token shortcut.

Offline, on the driver, every vocabulary string that starts with the word mark is encoded alone; those that come back
as one token form the shortcut table. A text is cut before each space that follows another character. No vocabulary
string joins a character to a following word mark (this is checked when the table is built), so no merge crosses a cut
and the counts of the pieces add up to the count of the text. Pre-tokens in the table count one; only the rest is
merged by the library, and remembered while the task lasts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import append

MARK = "▁"
#: Entries remembered by a task; past it the memory starts anew, which changes no result.
REMEMBERED = 300_000
_SPLIT = re.compile(r" *[^ ]+| +")


def prove_whole_tokens(model: bytes) -> frozenset[str]:
    """The words that a SentencePiece model encodes as one token when they follow a space or start a text.

    Raises ValueError when a vocabulary string or a normalisation rule could join text across a cut.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        raise ValueError("a vocabulary string holds a word mark after another character")
    if sp.encode("a  b ", out_type=str) == sp.encode("a b", out_type=str):
        raise ValueError("the model squeezes white space")
    for a in range(0, 0x110000, 4096):  # a rule that changes no single character has nothing to join
        every = "".join(chr(c) for c in range(a, a + 4096) if c not in (0, 32) and not 0xD800 <= c < 0xE000)
        if every and sp.normalize(every).lstrip(MARK) != every.lstrip(MARK):
            raise ValueError(f"the model's normaliser changes characters from U+{a:04X}")
    if MARK not in pieces:
        raise ValueError("the word mark is no vocabulary string")
    words = [p[1:] for p in pieces if p[:1] == MARK and len(p) > 1 and MARK not in p[1:]]
    return frozenset(w for w, ids in zip(words, sp.encode(words), strict=True) if len(ids) == 1)


class _Counts(dict):
    """Counts of pre-tokens; a missing one is merged by the library."""

    def __init__(self, sp, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.sp, self.whole = sp, whole

    def __missing__(self, word: str) -> int:
        n = len(self.sp.encode(word))
        if len(word) <= 64:
            if len(self) > REMEMBERED + len(self.whole):
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[word] = n
        return n


def count_text(text: str, counts: _Counts) -> int:
    """Tokens of one text. Runs of spaces and texts that hold the word mark itself go to the library by piece or whole."""
    if not text:
        return 0
    if MARK in text:
        return len(counts.sp.encode(text))
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return sum(map(counts.__getitem__, text.split(" ")))
    # The library puts one mark before the text; a pre-token's own first space then stands for it.
    total = 0
    for piece in _SPLIT.findall(" " + text):
        rest = piece[1:]
        if not rest:  # a lone mark is a vocabulary string
            total += 1
        else:
            total += counts[rest] if rest[0] != " " else len(counts.sp.encode(rest))
    return total


def token_counts(docs: DataFrame, model: bytes, text: str = "text", limit: int = 4096) -> DataFrame:
    """Add n_bytes, n_tokens, over_limit. Null texts count as empty; repeated rows are counted each; an empty table stays
    empty; input columns with the names of results are replaced."""
    whole = prove_whole_tokens(model)
    shared = docs.sparkSession.sparkContext.broadcast((model, whole))  # one fixed vocabulary, under 1 MB

    def start() -> Callable:
        import sentencepiece

        proto, known = shared.value
        counts = _Counts(sentencepiece.SentencePieceProcessor(model_proto=proto), known)

        def work(texts: list) -> list:
            n = [count_text(t or "", counts) for t in texts]
            return [[len((t or "").encode()) for t in texts], n, [x > limit for x in n]]

        return work

    return append(docs, text, [("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean")], start)


def op7(docs: DataFrame, path: str) -> DataFrame:
    with open(path, "rb") as f:
        model = f.read()
    return token_counts(docs.select("doc_id", "text"), model).select("doc_id", "n_bytes", "n_tokens", F.col("over_limit"))
