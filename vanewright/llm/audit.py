"""Filter interaction audit: what five quality filters remove in every order of application, by part of the corpus.

A document's outcome is five bits, so the corpus is a table of counts by (part, outcome): 32 cells a part, summed by Spark.
Each part's cells are one 2 x 2 x 2 x 2 x 2 tensor, and every figure of every order and step is a contraction of it: along
each axis it selects what passes, what fails, or all. One ``einsum`` gives a figure for all orders, steps and parts of an
Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewright.llm.common import WORD, materialise, shuffled

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Parts whose figures are held at once.
PARTS = 128


def failures(text: Column) -> list[Column]:
    """Whether a whole text fails filters A to D; null is the empty text.

    A: under 50 words; B: under 65 % of the words are distinct; C: more than 5 % of the code points are A-Z; D: holds one of
    ``#$%&*|``. The empty text fails A only.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]


def outcomes(docs: DataFrame, labels: DataFrame, text: str = "text", doc: str = "doc_id", part: str = "source") -> DataFrame:
    """(part, cell, n, good, toxic): documents by outcome; bit k of cell says that filter k fails.

    Filter E fails where a smaller id has the identical text. Texts are compared by their SHA-256 and only digests are
    shuffled. Rows are counted by (id, digest, part) first, then by (digest, part, labels), where the smallest id stands for
    the first of its copies; so a text that a third of the corpus repeats arrives as a few counts, and no row is joined back.
    Rows with a null id are nobody's copy and make none; of repeated rows of the first id, none is a copy.
    """
    bits = sum((F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(failures(F.col(text)))), F.lit(0))
    rows = docs.select(
        F.col(doc).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"), bits.cast("int").alias("bits")
    )
    counted = materialise(rows.groupBy("doc", "digest", "part", "bits").agg(F.count("*").alias("n")), "audit-documents")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("doc")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = counted.join(shuffled(marks), "doc", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    kinds = marked.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("nameless"), F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "n"))).alias("lead")
    )
    first = F.min("lead.doc").over(Window.partitionBy("digest"))
    unique = F.col("nameless") + F.when(F.col("lead.doc") == first, F.col("lead.n")).otherwise(0)
    # Of each kind, those that are nobody's copy pass E and the others fail it.
    both = kinds.select("part", "bits", "good", "toxic", "n", unique.alias("unique"))
    split = both.select("part", "good", "toxic", F.inline(F.array(F.struct(F.col("bits").alias("cell"), F.col("unique").alias("n")), F.struct((F.col("bits") + 16).alias("cell"), (F.col("n") - F.col("unique")).alias("n")))))
    count = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return split.where("n > 0").groupBy("part", "cell").agg(F.sum("n").alias("n"), count("good"), count("toxic"))


def _selectors() -> dict[str, np.ndarray]:
    """For each figure, an array (order and step, axis, 2) of what is selected along each axis: pass, fail or all."""
    good, bad, every = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
    steps = [(order[:k], order[k]) for order in ORDERS for k in range(len(FILTERS))]
    pick = lambda own, before, others: np.stack([np.stack([own if f == now else before if f in earlier else others for f in FILTERS]) for earlier, now in steps])
    return {"kept": pick(good, good, every), "removed": pick(bad, good, every), "failing": pick(bad, every, every), "unique_fails": pick(bad, good, good)}


SELECT = _selectors()
#: The filter of each order and step, by number.
OWN = np.array([FILTERS.index(f) for order in ORDERS for f in order])


def contract(tensor: np.ndarray, figure: str) -> np.ndarray:
    """tensor: (parts, 2, 2, 2, 2, 2), axis by filter, 1 fails. Gives (parts, 600): one number an order and step."""
    s = SELECT[figure]
    return np.einsum("zabcde,sa,sb,sc,sd,se->zs", tensor, *[s[:, k] for k in range(5)], optimize=True)


def figures(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """All figures of tensors of counts, each (parts, 600) integers."""
    out = {"kept": contract(n, "kept"), "removed": contract(n, "removed"), "unique_fails": contract(n, "unique_fails"), "good_lost": contract(good, "removed"), "toxic_lost": contract(toxic, "removed")}
    out["redundant"] = contract(n, "failing") - out["removed"]
    by_filter = np.stack([out["removed"][:, k == OWN].sum(axis=1) for k in range(len(FILTERS))], axis=1)
    return out | {"shapley": by_filter[:, OWN]}


def audit(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, figures) from (part, cell, n, good, toxic): 600 rows a part.

    A part's cells, 32 at most, become three arrays; parts are contracted in Arrow batches, ``PARTS`` at a time.
    """
    names = ("n", "good", "toxic")
    cells = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("cell", F.struct(*names)))).alias("m"))
    at = F.sequence(F.lit(0), F.lit(31))
    flat = lambda c: F.transform(at, lambda k: F.coalesce(F.try_element_at("m", k)[c], F.lit(0)).cast("long")).alias(c)
    wide = cells.select("part", *map(flat, names))
    orders = pa.array([order for order in ORDERS for _ in FILTERS])
    steps = np.tile(np.arange(1, 6, dtype=np.int32), len(ORDERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, PARTS):
                b = batch.slice(a, PARTS)
                # A flat cell's lowest bit is filter A, so axes come out reversed.
                t = [b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1) for c in names]
                found = figures(*t)
                every = np.repeat(np.arange(b.num_rows), len(steps))
                yield pa.RecordBatch.from_pydict(
                    {"part": b.column("part").take(pa.array(every)), "filter_order": orders.take(pa.array(np.tile(np.arange(len(steps)), b.num_rows))), "step": np.tile(steps, b.num_rows)} | {f: found[f].ravel() for f in FIGURES}
                )

    return wide.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIGURES))


def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step.

    Null texts and texts without words are the empty text's outcome; very long texts are read whole; a null source is the
    part of the empty string; a document with several label rows is good or toxic if one says so, without any neither;
    repeated rows count each; an empty table gives no part and so no row; extra columns are not read.
    """
    return audit(outcomes(docs, labels))


SQL = r"""WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM words GROUP BY text),
marks AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INTEGER)) AS good, max(CAST(coalesce(toxic = 1, false) AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
fails AS (SELECT part, CAST(len(w) < 50 AS INTEGER) AS a, CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INTEGER) AS b, CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INTEGER) AS c,
  CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER) AS d, CAST(coalesce(w.doc_id > first, false) AS INTEGER) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM words w JOIN firsts f USING (text) LEFT JOIN marks m ON w.doc_id = m.doc_id),
cells AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM f p, f q, f r, f s, f t WHERE p.x <> q.x AND r.x NOT IN (p.x, q.x) AND s.x NOT IN (p.x, q.x, r.x) AND t.x NOT IN (p.x, q.x, r.x, s.x)),
steps AS (SELECT filter_order, step, filter_order[step:step] AS own, filter_order[1:step - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
bits AS (SELECT c.*, own, filter_order, step, CASE own WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fail, a + b + c + d + e AS fails,
  (contains(before, 'A') AND a = 1) OR (contains(before, 'B') AND b = 1) OR (contains(before, 'C') AND c = 1) OR (contains(before, 'D') AND d = 1) OR (contains(before, 'E') AND e = 1) AS gone FROM cells c, steps),
sums AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND fail = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fail = 1 THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND fail = 1 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN fail = 1 AND fails = 1 THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN NOT gone AND fail = 1 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fail = 1 THEN toxic ELSE 0 END) AS toxic_lost FROM bits GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM sums"""
