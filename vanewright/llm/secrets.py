"""Secret scanning with a trigram inverted index, in DataFrame functions only.

1. ``trigram_query`` derives from each rule's regular expression the trigrams that every match must hold, as an OR of
   ANDs, or None when there are none.
2. ``postings`` is the inverted index over the trigrams that the rules name: one row (trigram, document key) where the
   lower-cased text holds the trigram.
3. ``candidates`` intersects the postings of each AND and unites the ORs of a rule.
4. Rules without mandatory trigrams scan every text; the others only their candidates. Matches are verified with the
   whole expression and get code-point offsets.
"""

from __future__ import annotations

import itertools
import re
import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``least``: code points that the whole match, or its group ``of``, must have at least."""

    kind: str
    pattern: str
    least: int = 1
    of: int = 0
    base: bool = False


def _either(words: str) -> str:
    """The expression with ASCII letters in either case. A flag would fold other letters too in some engines (\u017f to s)."""
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


#: The three base rules of the contract, then the rules that the scan adds.
RULES = (
    Rule("assign", "(" + _either("password|passwd|secret|token|api_?key") + ")" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, True),
    Rule("hex", r"[0-9a-f]+", 16, 0, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)

_MOST_STRINGS = 64


def _trigrams(strings: set[str]) -> set[frozenset[str]]:
    """OR over the strings of the AND of their trigrams; a string shorter than three makes it always true."""
    return {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}


def _and(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
    both = {x | y for x, y in itertools.product(a, b)}
    return {x for x in both if not any(y < x for y in both)}


def _walk(tree) -> tuple[set[str] | None, set[frozenset[str]]]:
    """The strings a parsed expression can match, lower-cased, or None when they are many; and its trigram query."""
    now: set[str] = {""}
    query: set[frozenset[str]] = {frozenset()}
    exact = True
    for op, arg in tree:
        strings: set[str] | None = None
        own: set[frozenset[str]] = {frozenset()}
        if op is rc.LITERAL:
            strings = {chr(arg).lower()}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg) and len(arg) <= 8:
            strings = {chr(c).lower() for _, c in arg}
        elif op is rc.SUBPATTERN:
            strings, own = _walk(arg[3])
        elif op is rc.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            strings = set().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
            own = set().union(*(q for _, q in parts))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, what = arg
            inner, inner_query = _walk(what)
            if high == 1 and inner is not None:
                strings = inner | {""}
            elif low == high and inner is not None and len(inner) ** low <= _MOST_STRINGS:
                strings = {"".join(x) for x in itertools.product(inner, repeat=low)}
            else:
                own = inner_query if low else own
        if strings is not None and len(now) * len(strings) <= _MOST_STRINGS:
            now = {a + b for a, b in itertools.product(now, strings)}
            continue
        exact = False
        query = _and(query, _trigrams(now))
        now = {""}
        query = _and(query, _trigrams(strings) if strings is not None else own)
    return (now if exact else None), _and(query, _trigrams(now))


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams that each match holds in lower case; None when some match need hold none."""
    _, query = _walk(rp.parse(pattern))
    return None if frozenset() in query else sorted(query, key=sorted)


#: Keys that equal texts are dealt over, so that a text that repeats most often is no one key.
DEALT = 64


def _key(docs: DataFrame, text: str) -> Column:
    """Equal texts with equal other columns, modulo DEALT, share their postings; equal keys of other texts only add
    candidates, which are verified anyway."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return F.xxhash64(F.col(text), F.pmod(F.xxhash64(*others), F.lit(DEALT)) if others else F.lit(0))


def postings(docs: DataFrame, text: str, trigrams: list[str]) -> DataFrame:
    """The inverted index over ``trigrams``: (trigram, key)."""
    low = F.lower(F.col(text))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return docs.select(_key(docs, text).alias("key"), low.alias("_low")).select("key", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kinds): the rules whose trigram query a text answers. The rules are a small fixed list, so is their table."""
    spark = docs.sparkSession
    clauses = [(r.kind, n, t, len(c)) for r in rules for n, c in enumerate(trigram_query(r.pattern) or []) for t in sorted(c)]
    names = spark.createDataFrame(clauses, "kind string, clause int, trigram string, need int")
    index = postings(docs, text, sorted({c[2] for c in clauses})).distinct()
    met = index.join(F.broadcast(names), "trigram").groupBy("key", "kind", "clause", "need").agg(F.count("*").alias("n")).where("n = need")
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule, number: int) -> Column:
    """The rule's matches, leftmost and not overlapping, as an array of (start, number, end), code points, end exclusive.

    Each piece is what lies between two matches and the match; \\G ties a piece to the end of the one before it.
    """
    whole = F.lit(r"\G(?s)(.*?)(" + rule.pattern + ")")
    sizes = lambda group: F.transform(F.regexp_extract_all(text, whole, F.lit(group)), F.char_length)
    parts = {"end": running(sizes(0)), "size": sizes(2)} | ({"part": sizes(2 + rule.of)} if rule.of else {})
    lasting = F.filter(F.arrays_zip(*[c.alias(k) for k, c in parts.items()]), lambda m: m["part" if rule.of else "size"] >= rule.least)
    found = F.transform(lasting, lambda m: F.struct((m["end"] - m["size"]).alias("start"), F.lit(number).alias("number"), m["end"].alias("end")))
    return F.when(text.rlike(_quick(rule)), found).otherwise(F.array().cast("array<struct<start:int,number:int,end:int>>"))


def running(numbers: Column) -> Column:
    """Running sums of an array. Each round adds what stands 1, 2, 4, ... places before, so n numbers cost n log n steps;
    a fold that appends to an array would copy it for each of them."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)).cast("double"))).cast("int"))
    shifted = lambda acc, k: F.transform(acc, lambda x, i: x + F.coalesce(F.get(acc, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))
    return F.aggregate(rounds, numbers, shifted)


def _quick(rule: Rule) -> str:
    """A test that every text with a lasting match passes."""
    return rule.pattern[:-1] + "{%d,}" % rule.least if rule.pattern.endswith("]+") and "(" not in rule.pattern and rule.kind == "hex" else rule.pattern


def _free(name: str, taken: list[str]) -> str:
    """The name, with underscores added until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``secrets``: array of (start, kind number in ``rules``, end), sorted.

    Null texts count as empty and hold nothing. Texts of any length are scanned whole, in time near their length and number
    of matches. Repeated rows get equal results, an empty table gives an empty one. An input column ``secrets`` is replaced;
    other columns stay, whatever their names.
    """
    sure = {r.kind for r in rules if trigram_query(r.pattern) is None}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "secrets"])
    own = [c for c in docs.columns]
    key, kinds = _free("_secret_key", own), _free("_secret_kinds", own)
    keyed = docs.withColumn(key, _key(docs, text))
    found = candidates(docs, text, rules).withColumnsRenamed({"key": key, "kinds": kinds})
    body = F.coalesce(F.col(text), F.lit(""))
    parts = []
    for n, rule in enumerate(rules):
        one = spans(body, rule, n)
        parts.append(one if rule.kind in sure else F.when(F.array_contains(kinds, rule.kind), one).otherwise(F.array().cast("array<struct<start:int,number:int,end:int>>")))
    out = keyed.join(found, key, "left")
    return out.select(*[F.col(f"`{c}`") for c in own], F.array_sort(F.concat(*parts)).alias("secrets"))


def written(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["number"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1(docs: DataFrame) -> DataFrame:
    out = scan(docs.select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["number"] < sum(r.base for r in RULES))
    count = lambda n: F.size(F.filter("secrets", lambda s: s["number"] == n)).cast("long")
    return out.select(
        "doc_id", *[count(n).alias(f"n_{r.kind}") for n, r in enumerate(RULES) if r.base],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("secrets")).alias("spans"),
    )


def _sql() -> str:
    def quoted(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    each = " UNION ALL ".join(
        f"SELECT r, {n} AS n, '{x.kind}' AS kind, generate_subscripts(f, 1) AS k, unnest(f) AS f, unnest(g) AS g, unnest(p) AS p, {x.least} AS least FROM (SELECT r, "
        + ", ".join(f"regexp_extract_all(t, {quoted('(?s)(.*?)(' + x.pattern + ')')}, {i}) AS {c}" for c, i in (("f", 0), ("g", 1), ("p", 2 + x.of)))
        + " FROM d)"
        for n, x in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({each}),
o AS (SELECT r, n, kind, least, p, coalesce(sum(length(f)) OVER (PARTITION BY r, n ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(g) AS s,
  sum(length(f)) OVER (PARTITION BY r, n ORDER BY k) AS e FROM m),
s AS (SELECT r, n, s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS w FROM o WHERE length(p) >= least),
g AS (SELECT r, count(*) FILTER (WHERE n = 0) AS a, count(*) FILTER (WHERE n = 1) AS b, count(*) FILTER (WHERE n = 2) AS c,
  string_agg(w, ',' ORDER BY s, n) FILTER (WHERE n < 3) AS base, string_agg(w, ',' ORDER BY s, n) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.r = g.r
"""


SQL = _sql()
