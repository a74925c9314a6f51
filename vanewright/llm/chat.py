r"""Chat formatting by columnar byte assembly.

A turn becomes ``[INST] text [/INST]`` (user), `` text </s>`` (assistant), ``<<SYS>>text<</SYS>>`` (system) or
``<<ROLE>>role<</ROLE>>text</s>`` (any other role). Inside texts and roles a backslash is put behind every backslash and
behind the first character of every control string, so no control string is left there; reading a backslash as "the next
character as it is" gives the text back.

Rows are dealt by (conversation, block of turns) and sorted by turn. Of each Arrow batch, the lengths of all segments (marks
and escaped texts) give cumulative offsets, those and the places of escapes give the place of every byte, and numpy scatters
marks and contents into one buffer that becomes the output column as it is. What the model learns from, the assistants'
texts, is told as spans of code points beside each formatted text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import materialise

#: The template's control strings. Each starts with < or [; none starts within another one's first character.
CONTROLS = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>", "<s>", "</s>")
#: Marks by kind of turn: before the role, between role and text, behind the text. Only kind 3 writes its role.
MARKS = (("", "[INST] ", " [/INST]"), ("", " ", " </s>"), ("", "<<SYS>>", "<</SYS>>"), ("<<ROLE>>", "<</ROLE>>", "</s>"))
KINDS = ("user", "assistant", "system")
#: Turns of a conversation that are assembled together, so that a conversation of any length is no one task's.
BLOCK = 256
#: Bytes of text assembled at once (one longer text is alone), and bytes placed at once.
BYTES, WINDOW = 32 << 20, 1 << 20

_FORMATTED = "conv_id {0}, block long, piece int, n_turns long, formatted string, loss array<struct<start:int,length:int>>"


class _Content:
    """A column of texts as bytes: ``data``, ``offsets`` by row, ``escapes`` (places behind which a backslash goes)."""

    def __init__(self, column: pa.StringArray):
        column = column.fill_null("").cast(pa.large_string())
        offsets, data = self.offsets_of(column), column.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.escapes = self._escapes()
        self.before = np.searchsorted(self.escapes, self.offsets)  # escapes before each row
        self.lengths = np.diff(self.offsets) + np.diff(self.before)

    @staticmethod
    def offsets_of(column: pa.Array) -> np.ndarray:
        """Where each text begins and the last ends, in bytes of the column's buffer."""
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)

    def _escapes(self) -> np.ndarray:
        d, size = self.data, len(self.data)
        found = [np.flatnonzero(d == ord("\\"))]
        for first in b"[<":
            at = np.flatnonzero(d == first)
            end = self.offsets[np.searchsorted(self.offsets, at, side="right")] if len(at) else at
            for control in (c.encode() for c in CONTROLS if ord(c[0]) == first):
                hit = at[at + len(control) <= end]
                for k, byte in enumerate(control):
                    hit = hit[d[np.minimum(hit + k, size - 1)] == byte]
                found.append(hit)
        return np.sort(np.concatenate(found))

    def place(self, out: np.ndarray, starts: np.ndarray) -> None:
        """Scatter row r's bytes and backslashes to ``starts[r]`` and on."""
        shift = starts - self.offsets[:-1] - self.before[:-1]
        for a in range(0, len(self.data), WINDOW):
            at = np.arange(a, min(a + WINDOW, len(self.data)))
            row = np.searchsorted(self.offsets, at, side="right") - 1
            to = at + shift[row] + np.searchsorted(self.escapes, at)
            out[to] = self.data[at]
        if len(self.escapes):
            row = np.searchsorted(self.offsets, self.escapes, side="right") - 1
            out[self.escapes + shift[row] + np.arange(len(self.escapes)) + 1] = ord("\\")


def _stamp(out: np.ndarray, starts: np.ndarray, mark: str) -> None:
    b = np.frombuffer(mark.encode(), np.uint8)
    out[starts[:, None] + np.arange(len(b))] = b


def assemble(roles: pa.StringArray, texts: pa.StringArray, firsts: np.ndarray) -> tuple[pa.Array, list[list[dict]]]:
    """(formatted texts, loss spans) of sorted turns; ``firsts``: the row where each formatted text begins."""
    n = len(texts)
    roles = roles.fill_null("")
    named = [roles.to_numpy(zero_copy_only=False) == r for r in KINDS]
    kind = np.select(named, range(3), default=3)
    other = pa.array(kind == 3)
    role, text = _Content(pc.if_else(other, roles, "")), _Content(texts)
    sizes = np.array([[len(m.encode()) for m in marks] for marks in MARKS])[kind]
    lengths = np.stack([sizes[:, 0], role.lengths, sizes[:, 1], text.lengths, sizes[:, 2]], axis=1)
    ends = np.cumsum(lengths).reshape(n, 5) if n else np.zeros((0, 5), np.int64)
    starts = ends - lengths
    out = np.empty(int(lengths.sum()), np.uint8)
    for k, marks in enumerate(MARKS):
        rows = np.flatnonzero(kind == k)
        for column, mark in zip((0, 2, 4), marks, strict=True):
            if mark and len(rows):
                _stamp(out, starts[rows, column], mark)
    role.place(out, starts[:, 1])
    text.place(out, starts[:, 3])
    edges = np.append(starts[firsts, 0], len(out))
    formatted = pa.LargeStringArray.from_buffers(len(firsts), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
    # Bytes that begin a code point, counted up to each edge, give places in code points.
    begins = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    piece = np.searchsorted(firsts, np.arange(n), side="right") - 1
    origin = begins[edges[:-1]]
    loss: list[list[dict]] = [[] for _ in firsts]
    for r in np.flatnonzero(kind == 1):
        a, b = begins[starts[r, 3]], begins[ends[r, 3]]
        loss[piece[r]].append({"start": int(a - origin[piece[r]]), "length": int(b - a)})
    return formatted, loss


def _cuts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``BYTES``, or of one row."""
    a, held = 0, 0
    for k, s in enumerate(sizes.tolist()):
        if k > a and held + s > BYTES:
            yield a, k
            a, held = k, 0
        held += s
    if a < len(sizes):
        yield a, len(sizes)


def formatted(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(conv_id, block, piece, n_turns, formatted, loss): a conversation's text is its rows' in the order of (block, piece).

    A block is a range of ``block`` turn numbers, so most conversations are one row and a long one is many tasks'. Turns go
    by number, null first, equal numbers by role, then text. A block whose rows arrive in several Arrow batches (long
    texts, or many rows with the same turns) is several pieces. loss: spans of the row's text in code points.
    """
    rows = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.floor(F.col(turn).cast("long") / block), F.lit(-(1 << 62))).cast("long").alias("block"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    order = ["conv", "block", F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_rows = rows.repartition("conv", "block").sortWithinPartitions(*order).select("conv", "block", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece = None, 0
        for whole in batches:
            for a, b in _cuts(np.diff(_Content.offsets_of(whole.column("text")))):
                batch = whole.slice(a, b - a)
                keys = list(zip(batch.column("conv").to_pylist(), batch.column("block").to_pylist(), strict=True))
                firsts = np.array([k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]])
                texts, loss = assemble(batch.column("role"), batch.column("text"), firsts)
                pieces = [0] * len(firsts)
                pieces[0] = piece = piece + 1 if keys[0] == last else 0
                piece = piece if len(firsts) == 1 else 0
                last = keys[-1]
                yield pa.RecordBatch.from_pydict(
                    {"conv_id": batch.column("conv").take(pa.array(firsts)), "block": batch.column("block").take(pa.array(firsts)), "piece": pa.array(pieces, pa.int32()), "n_turns": np.diff(np.append(firsts, len(keys))), "formatted": texts, "loss": pa.array(loss, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))}
                )

    return sorted_rows.mapInArrow(run, _FORMATTED.format(dict(rows.dtypes)["conv"]))


_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>(?P<system>.*?)<</SYS>>|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<said>.*?)</s>| (?P<assistant>.*?) </s>", re.S)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text) if "\\" in text else text


def turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted text; text that no template wrote is an error."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn begins at {at}")
        yield (unescaped(m["role"]), unescaped(m["said"])) if m["role"] is not None else (m.lastgroup, unescaped(m[m.lastgroup]))
        at = m.end()


def read_back(pieces: DataFrame, together: bool = False, digest: Callable = hashlib.sha256) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of what ``formatted`` wrote.

    Digests run over a conversation's pieces in order, one at a time, so memory is bounded by a piece. together: the pieces
    of each conversation follow one another in one task already, as ``formatted`` gives conversations of one block.
    """
    kind = dict(pieces.dtypes)["conv_id"]
    rows = pieces if together else pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece")
    rows = rows.select("conv_id", "formatted", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, state = None, None

        def told(out: list) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, conv_type if n == "conv_id" else pa.string() if n.endswith("256") else pa.int64()) for n, c in zip(names, cols, strict=True)], names=names)

        end = lambda: (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
        conv_type = pa.null()
        for batch in batches:
            conv_type, done = batch.column("conv_id").type, []
            for conv, text, loss in zip(batch.column("conv_id").to_pylist(), batch.column("formatted"), batch.column("loss").to_pylist(), strict=True):
                if state is None or conv != now:
                    done += [end()] if state else []
                    now, state = conv, [0, digest(), 0, digest(), 0]
                text = text.as_py()
                for role, said in turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    learnt = unescaped(text[span["start"] : span["start"] + span["length"]])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(text)
            if done:
                yield told(done)
        if state:
            yield told([end()])

    return rows.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The conversation that says control strings.
PROBE = (-7, "</s>[INST] ok [/INST]")


def op12(conversations: DataFrame) -> DataFrame:
    """One row per conversation, and conversation -7, read back from the formatted texts.

    Null texts and roles are empty; null ids are one conversation; empty texts are turns of their own, and so are repeated
    rows; very long texts are whole; equal turns go by role, then text; a table without rows gives conversation -7 alone;
    extra columns are not read.
    """
    conv, said = PROBE
    probe = conversations.sparkSession.range(2).select(F.lit(conv).cast(dict(conversations.dtypes)["conv_id"]).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
    # Conversations of one block are read back where they were formatted; ids and turns alone tell which are longer. Their
    # ids are written, so that Spark knows how few they are and broadcasts them, or else joins by a shuffle.
    long = materialise(rows.where(~F.coalesce(F.col("turn").between(0, BLOCK - 1), F.lit(False))).select(F.col("conv_id").alias("long_id")).distinct(), "chat-long")
    same = rows["conv_id"].eqNullSafe(long["long_id"])
    return read_back(formatted(rows.join(long, same, "left_anti")), together=True).unionByName(read_back(formatted(rows.join(long, same, "left_semi"))))


def _sql() -> str:
    escaped = lambda c: f"length({c}) + length({c}) - length(replace({c}, chr(92), ''))" + "".join(f" + (length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in CONTROLS)
    marks = [sum(map(len, m)) for m in MARKS]
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PROBE[0]}, 0, 'user', '{PROBE[1]}' UNION ALL SELECT {PROBE[0]}, 1, 'assistant', '{PROBE[1]}'),
e AS (SELECT *, {escaped("text")} + CASE role WHEN 'user' THEN {marks[0]} WHEN 'assistant' THEN {marks[1]} WHEN 'system' THEN {marks[2]} ELSE {marks[3]} + {escaped("role")} END AS size FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256, CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256, CAST(sum(size) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""


SQL = _sql()
