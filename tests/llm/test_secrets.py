import random
import re
import time

from vanewright.llm import secrets

PLAIN = [re.compile(r.pattern) for r in secrets.RULES]


def brute(text):
    out = []
    for n, (rule, p) in enumerate(zip(secrets.RULES, PLAIN, strict=True)):
        out += [(m.start(), n, m.end()) for m in p.finditer(text or "") if len(m.group(rule.of)) >= rule.least]
    return sorted(out)


def test_queries_hold_in_every_match():
    for rule, wanted in (("assign", "token"), ("access", "AKIA0"), ("github", "ghp_")):
        pattern = next(r.pattern for r in secrets.RULES if r.kind == rule)
        clauses = secrets.trigram_query(pattern)
        assert any(all(t in wanted.lower() + " secret password" for t in c) for c in clauses)
    assert secrets.trigram_query("[0-9a-f]+") is None
    assert secrets.trigram_query("abc|de") is None
    assert secrets.trigram_query("(abc|bcd)x?e") == sorted([frozenset(["abc"]) | s for s in (frozenset(["bcx", "cxe"]), frozenset(["bce"]))] + [frozenset(["bcd"]) | s for s in (frozenset(["cdx", "dxe"]), frozenset(["cde"]))], key=sorted)


def test_against_plain_search(spark):
    random.seed(1)
    bits = ["password", "PassWd", "secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0123456789", "deadbeef01234567", "abc123def456", "ghp_" + "a1" * 18, "xoxb-1234567890ab", "😀é", "\n", "-----BEGIN RSA PRIVATE KEY-----", "x", "eyJabcdefgh.eyJabcdefgh.abcdefgh1"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    rows = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [tuple(s) for s in r["secrets"]] == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_many_matches_in_one_text(spark):
    text = "0123456789abcdef " * 200_000 + "token=" + "q" * 12
    start = time.time()
    (row,) = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    took = time.time() - start
    assert [tuple(s) for s in row["secrets"]] == brute(text) and took < 60


def test_only_ascii_letters_have_two_cases(spark, documents):
    import duckdb

    texts = ["\u017fecret=abcdefghijklmnop", "to\u212aen=abcdefghijklmnop", "SeCrEt=abcdefghijklmnop", "tOkEn: 'abcdefghijklmnop"]
    docs = documents([(k, t, "en", "a") for k, t in enumerate(texts)])
    got = sorted(tuple(r) for r in secrets.op1(docs).collect())
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    assert [r[1] for r in got] == [0, 0, 1, 1] and got == sorted(con.sql(secrets.SQL).fetchall())
    assert [brute(t) != [] for t in texts] == [False, False, True, True]


def test_odd_rows(odd, nothing):
    rows = secrets.op1(odd).collect()
    assert len(rows) == 11 and all(r["spans"] == "" and r["n_hex"] == 0 for r in rows)
    assert secrets.scan(odd).columns.count("secrets") == 1
    assert secrets.op1(nothing).count() == 0
