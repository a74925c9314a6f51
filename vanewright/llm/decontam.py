"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Items and documents are normalised alike: A-Z become lower case, words are runs of ASCII letters, digits and characters
above U+007F. The automaton holds every window of ``n`` consecutive item words between single spaces, so a match starts
and ends at word borders. Each document is scanned once; matches are mapped to word numbers and to code-point offsets of
the original text.

A benchmark beyond ``block_chars`` characters is dealt to several automata; each scans the documents in a pass of its own
and their hit ranges are united, so the memory of a task is bounded by one automaton whatever the size of the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import append, materialise

WINDOW = 13
_ORIGINAL = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
#: For bytes of UTF-8: lower case, and a space for whatever is no part of a word.
_NORMAL = bytes(ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
FIELDS = [("n_words", "long"), ("n_hit", "long"), ("items", "array<string>"), ("hits", "array<struct<first:int,last:int,start:int,end:int>>")]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


def windows(text: str | None, n: int = WINDOW) -> set[bytes]:
    """An item's windows; one of fewer words, but not none, is a single window."""
    w = words(text)
    return {b" " + b" ".join(w[i : i + n]) + b" " for i in range(max(1, len(w) - n + 1))} if w else set()


def automaton(items: list[tuple[str, str | None]], n: int = WINDOW):
    """Windows of all items; the value of each is its number of words and the ids of its items."""
    import ahocorasick

    of: dict[bytes, list[str]] = {}
    for item, text in items:
        for w in windows(text, n):
            of.setdefault(w, []).append(item)
    a = ahocorasick.Automaton()
    for w, ids in of.items():
        a.add_word(w.decode("latin-1"), (w.count(b" ") - 1, tuple(sorted(set(ids)))))
    a.make_automaton()
    return a if of else None


def scan(text: str | None, automata: list) -> tuple[int, int, list[str], list[tuple[int, int, int, int]]]:
    """Number of words, of hit words, items, and hit ranges: first and last word, start and end in the original."""
    w = words(text)
    if not w:
        return 0, 0, [], []
    line = (b" " + b" ".join(w) + b" ").decode("latin-1")
    found = [(end, k, ids) for a in automata for end, (k, ids) in a.iter(line)]
    if not found:
        return len(w), 0, [], []
    borders = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(borders, [end for end, _, _ in found]) - 1
    ranges: list[list[int]] = []
    for a, b in sorted((int(e) - k + 1, int(e)) for e, (_, k, _) in zip(last, found, strict=True)):
        if ranges and a <= ranges[-1][1] + 1:
            ranges[-1][1] = max(ranges[-1][1], b)
        else:
            ranges.append([a, b])
    spots = [m.span() for m in _ORIGINAL.finditer(text)]
    hits = [(a, b, spots[a][0], spots[b][1]) for a, b in ranges]
    return len(w), sum(b - a + 1 for a, b in ranges), sorted({i for _, _, ids in found for i in ids}), hits


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = WINDOW, block_chars: int = 4_000_000) -> DataFrame:
    """Add n_words, n_hit, items (ids as sorted strings), hits (ranges in words and code points), contaminated.

    Null texts have no words; null item ids count as the empty string, null items have no windows; repeated items and
    rows count once and each; an empty benchmark hits nothing; an empty table of documents gives an empty one. Documents are contaminated when at least a twentieth of
    their words is hit.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t")).where("t is not null")
    size = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_chars))
    if blocks == 1:
        # The size was measured above: at most block_chars.
        shared = spark.sparkContext.broadcast([tuple(r) for r in items.collect()])

        def start() -> Callable:
            a = automaton(shared.value, n)

            def work(texts: list) -> list:
                rows = [scan(t, [a] if a else []) for t in texts]
                return [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [[dict(zip(("first", "last", "start", "end"), h, strict=True)) for h in r[3]] for r in rows]]

            return work

        out = append(docs, text, FIELDS, start)
    else:
        out = _in_blocks(docs, items, text, n, blocks, block_chars)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _in_blocks(docs: DataFrame, items: DataFrame, text: str, n: int, blocks: int, block_chars: int) -> DataFrame:
    """A pass for each block of items; hit ranges of a document that meet or touch become one."""
    raw = docs.select(*[F.col(f"`{c}`") for c in docs.columns]).withColumn("_row", F.monotonically_increasing_id())
    kept = materialise(raw, "decontam-docs")  # row numbers must not change between the passes
    parts = None
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        one = decontaminate(kept.select("_row", text), block.select(F.col("i").alias("item_id"), F.col("t").alias("text")), text, n=n, block_chars=1 << 62)
        one = one.select("_row", "n_words", "items", "hits")
        parts = one if parts is None else parts.unionByName(one)
    flat = parts.groupBy("_row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("all"))
    merged = F.aggregate(
        "all",
        F.array().cast(FIELDS[3][1]),
        lambda acc, h: F.when(
            (F.size(acc) > 0) & (h["first"] <= F.element_at(acc, -1)["last"] + 1),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], h["last"]).alias("last"), F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], h["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(h))),
    )
    flat = flat.withColumn("hits", merged).withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["last"] - h["first"] + 1)).drop("all")
    names = {"n_words", "n_hit", "items", "hits"}
    base = kept.select(*[c for c in kept.columns if c not in names])
    return base.join(flat, "_row").drop("_row")


def op10(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    out = decontaminate(docs.select("doc_id", "text"), benchmark)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS i,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT i, least(13, len(w)) AS k, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT i, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS p FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT r, p, k, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)),
m AS (SELECT dw.r, dw.p, dw.k, bw.i FROM dw JOIN bw ON dw.s = bw.s AND dw.k = bw.k),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + k - 1)) AS q FROM (SELECT DISTINCT r, p, k FROM m)) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, i FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN n ON d.r = n.r
"""
