import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vanewright.llm import chat

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def marked(role, text):
    """A turn by the docstring's words."""

    def escape(t):
        out = ""
        for k, c in enumerate(t):
            out += c + ("\\" if c == "\\" or any(t.startswith(x, k) for x in chat.CONTROLS) else "")
        return out

    own = {"user": "[INST] {} [/INST]", "assistant": " {} </s>", "system": "<<SYS>>{}<</SYS>>"}.get(role, "<<ROLE>>" + escape(role).replace("{", "{{").replace("}", "}}") + "<</ROLE>>{}</s>")
    return own.format(escape(text))


def slow(rows):
    by = defaultdict(list)
    for conv, turn, role, text in [*rows, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, all_turns in by.items():
        all_turns.sort()
        learnt = "".join(t for _, r, t in all_turns if r == "assistant")
        out.append(str((conv, len(all_turns), sha("".join(f"{r}\n{t}\n" for _, r, t in all_turns)), len(learnt), sha(learnt), sum(len(marked(r, t)) for _, r, t in all_turns))))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "conv_id long, turn long, role string, text string, block string, conv string")


def check(spark, rows):
    assert sorted(str(tuple(r)) for r in chat.op12(table(spark, rows)).collect()) == slow(rows)


ROWS = [
    (1, 0, "system", "be <<SYS>> kind <</SYS>>"), (1, 1, "user", "[INST] hi [/INST]"), (1, 2, "assistant", "a\\b </s><s> \\</s>"), (2, 5, "user", None), (2, 4, None, "no role"), (2, 4, "assistant", ""), (3, None, "assistant", "first"), (3, 0, "user", "second"),
    (4, 0, "tool\n[INST]", "<</ROLE>>x"), (4, 1, "Assistant", "[/INST][/INST]<<ROLE>>\\"), (5, 0, "assistant", "ünï 😀 中文 [" + "x" * 40_000), (6, 0, "assistant", "twice"), (6, 0, "assistant", "twice"), (None, 0, "user", "no id"), (None, 1, "assistant", "neither"), (7, 0, "user", "[[INST]<</s>"), (7, 1, "assistant", " ends with a space "),
]


def test_equals_a_plain_formatter(spark):
    check(spark, ROWS)


def test_nothing(spark):
    check(spark, [])


def test_long_conversations_are_many_rows(spark):
    rows = [(9, k, ("user", "assistant")[k % 2], f"say [INST] {k} ü") for k in range(-300, 1500)] + [(10, 7, "assistant", "same") for _ in range(1000)]
    check(spark, rows)
    assert chat.formatted(table(spark, rows)).where("conv_id = 9").count() >= 1800 // chat.BLOCK


def test_blocks_of_bytes_are_pieces(spark, monkeypatch):
    """Rows of a block that don't fit one buffer become pieces in order."""
    assert list(chat._cuts(np.array([5, chat.BYTES, 3, 4]))) == [(0, 1), (1, 2), (2, 4)]
    assert list(chat._cuts(np.array([], int))) == []


def test_mask_covers_assistants_only(spark):
    for r in chat.formatted(table(spark, ROWS)).collect():
        masked = [chat.unescaped(r["formatted"][s["start"] : s["start"] + s["length"]]) for s in r["loss"]]
        assert masked == [t for role, t in chat.turns(r["formatted"]) if role == "assistant"]


piece = st.text(alphabet=st.sampled_from(list("\\<>[]/ISNTYROLEs ü😀\n")), max_size=30)
texts = st.one_of(piece, st.lists(st.sampled_from([*chat.CONTROLS, "\\", " ", "x", "ü", "<", "["]), max_size=12).map("".join))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), texts), texts), min_size=1, max_size=6))
def test_any_text_comes_back(rows):
    roles, said = (pa.array(c, pa.string()) for c in zip(*rows, strict=True))
    out, loss = chat.assemble(roles, said, np.array([0]))
    text = out[0].as_py()
    assert text == "".join(marked(*r) for r in rows)
    assert list(chat.turns(text)) == rows
    assert [chat.unescaped(text[s["start"] : s["start"] + s["length"]]) for s in loss[0]] == [t for r, t in rows if r == "assistant"]


@pytest.mark.parametrize("control", chat.CONTROLS)
def test_no_control_string_is_left_in_a_text(control):
    out, _ = chat.assemble(pa.array(["user"]), pa.array([control * 3]), np.array([0]))
    inner = out[0].as_py()[len("[INST] ") : -len(" [/INST]")]
    assert not any(c in inner for c in chat.CONTROLS)


def test_windows_of_scattering(monkeypatch):
    monkeypatch.setattr(chat, "WINDOW", 7)
    rows = [("assistant", "a[INST]b\\c" * 9), ("user", ""), ("tool", "ü</s>" * 5)]
    out, _ = chat.assemble(pa.array([r for r, _ in rows]), pa.array([t for _, t in rows]), np.array([0, 2]))
    assert "".join(out.to_pylist()) == "".join(marked(*r) for r in rows)


def test_foreign_text_is_an_error():
    with pytest.raises(ValueError):
        list(chat.turns("no template"))
