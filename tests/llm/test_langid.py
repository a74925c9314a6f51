import random

import pytest

from vanewright.llm import langid


def phrases(text, sample):
    """Greedy longest phrases by plain substring search, a chunk at a time."""
    n = 0
    for a in range(0, len(text), langid.CHUNK):
        part, i = text[a : a + langid.CHUNK], 0
        while i < len(part):
            k = 1
            while i + k < len(part) and part[i : i + k + 1] in sample:
                k += 1
            n, i = n + 1, i + k
    return n


@pytest.mark.parametrize("dense", [langid.Table.DENSE, 0])
def test_parse_counts_are_the_plain_ones(dense, monkeypatch):
    monkeypatch.setattr(langid.Table, "DENSE", dense)
    random.seed(4)
    word = lambda a: "".join(random.choice(a) for _ in range(random.randint(1, 6)))
    samples = {n: " ".join(word(a) for _ in range(150)) for n, a in (("p", "abcde"), ("q", "cdefé"))}
    parser = langid.Parser(langid.Model(samples))
    texts = [" ".join(word("abcdefé") for _ in range(random.randint(1, 300))) for _ in range(60)] + ["", "a", "zz"]
    got, size = parser.phrases(texts)
    for k, t in enumerate(texts):
        assert size[k] == len(t)
        # An unknown letter is a phrase of its own.
        assert [phrases(t, samples[n]) for n in ("p", "q")] == got[k].tolist(), t


def test_large_alphabets():
    """Two languages that share thousands of letters in common words of their own."""
    random.seed(8)
    shared = [chr(0x4E00 + k) for k in range(3000)]
    kana = [chr(0x3042 + k) for k in range(40)]
    zh_words = ["".join(random.choices(shared, k=2)) for _ in range(1500)]
    ja_words = ["".join(random.choices(shared, k=1)) + "".join(random.choices(kana, k=2)) for _ in range(1500)]
    zh2_words = ["".join(random.choices(shared, k=2)) for _ in range(1500)]
    say = lambda words, n: "".join(random.choices(words, k=n))
    vocab = {"ja": ja_words, "zh": zh_words, "zh2": zh2_words}
    parser = langid.Parser(langid.Model({k: say(v, 5000) for k, v in vocab.items()}))
    for name, words in vocab.items():
        n, _ = parser.phrases([say(words, 60) for _ in range(30)])
        assert [parser.model.langs[k] for k in n.argmin(axis=1)] == [name] * 30


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = langid.op3(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.97 * len(out) and all(0 <= r["score"] <= 1 for r in out)


def test_odd_rows(odd, nothing, documents):
    rows = {(r["doc_id"], r["lang_pred"] == "und") for r in langid.op3(odd).collect()}
    assert {d for d, u in rows if u} == {1, 2, 3, 5}
    assert langid.op3(nothing).count() == 0
    unlabelled = documents([(1, "some text", None, "a")])
    assert langid.op3(unlabelled).first()["lang_pred"] == "und"
