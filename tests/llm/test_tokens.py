import random

import public_tokenizers
import pytest
import sentencepiece

from vanewright.llm import tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_are_the_library_s(spark, sf, odd, nothing):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    random.seed(1)
    bits = ["a", "b ", " ", "  ", "\n", "the", "é", "▁", "\t", "中", "<s>", "</s>", " the", "\x00", "ﬁ", "😀", "1234567"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 30))) for _ in range(5000)]
    texts += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(300).collect()]
    rows = tokens.op7(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n := len(sp.encode(t)), len(t.encode()), n > 4096), t
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.op7(odd, PATH).collect()}
    assert got[1] == got[2] == 0 and got[7] == len(sp.encode("x" * 50_000))
    assert tokens.op7(nothing, PATH).count() == 0


def test_shortcut_is_proved():
    with open(PATH, "rb") as f:
        whole = tokens.prove_whole_tokens(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert len(whole) > 10_000 and all(len(sp.encode(w)) == 1 for w in whole)
    with pytest.raises(RuntimeError):
        tokens.prove_whole_tokens(b"no model")
