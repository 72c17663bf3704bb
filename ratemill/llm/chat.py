"""Chat formatting by columnar byte assembly (operator 1).

A conversation becomes a row of turns, each between the marks of its role. Text that looks like
a mark is escaped with a backslash after its first character, and what looks escaped gets one
more, so that reading takes exactly one away.

Turns are dealt to tasks by ranges of conversation and turn, so that a conversation of any size
is spread over tasks; each task writes pieces of bounded size. In a batch the lengths of heads,
texts and tails give the offsets of all segments, and an index array copies them into one buffer.
The loss mask is a list of spans of the piece, in characters.

Null text and null role are empty. Rows are ordered by turn, then role, then text, nulls first;
repeated rows stay. Rows with a null conversation id are one conversation. A text of any length is
one segment of its piece. Extra columns are left out, whatever their names. An empty table gives
no rows. The digests of a conversation are sequential, so one task reads its pieces in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.llm.segments import gather, text_bytes

# The template. Head and tail of the known roles, and of any other.
TEMPLATE = {
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("", "</s>"),
    "system": ("[SYS] ", " [/SYS]"),
}
OTHER_HEAD = ("[ROLE] ", " [/ROLE]")
OTHER_TAIL = "[/TURN]"
TRAINED = "assistant"
MARKS = r"</s>|<s>|\[/?(?:INST|SYS|ROLE|TURN)\]"
# In the syntax of both regular expression libraries used here.
LOOKS_LIKE_MARK = r"([<\[])(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]|TURN\]))"
PIECE_TURNS = 256


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, LOOKS_LIKE_MARK, r"\1\\\2\3")


def unescape(text: str) -> str:
    return re.sub(r"([<\[])\\(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]|TURN\]))", r"\1\2\3", text)


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns; byte end of each turn; characters before each text; characters of it."""
    n = len(role)
    text = escape(text.cast(pa.large_string()).fill_null(""))
    known = pc.dictionary_encode(role.cast(pa.large_string()).fill_null(""))
    heads, tails = [], []
    for name in known.dictionary.to_pylist():
        if name in TEMPLATE:
            head, tail = TEMPLATE[name]
        else:
            head = OTHER_HEAD[0] + escape(pa.array([name]))[0].as_py() + OTHER_HEAD[1]
            tail = OTHER_TAIL
        heads.append(head)
        tails.append(tail)
    of = known.indices.to_numpy(zero_copy_only=False)
    marks = [x.encode() for x in heads + tails]
    mark_len = np.array([len(x) for x in marks], np.int64)
    mark_at = np.cumsum(mark_len) - mark_len
    texts, at = text_bytes(text)
    pool = np.concatenate([np.frombuffer(b"".join(marks), np.uint8), texts])
    base = int(mark_len.sum())
    start, length = np.empty((n, 3), np.int64), np.empty((n, 3), np.int64)
    for column, row in ((0, of), (2, of + len(heads))):
        start[:, column], length[:, column] = mark_at[row], mark_len[row]
    start[:, 1], length[:, 1] = base + at[:-1], np.diff(at)
    ends = np.cumsum(length.sum(1))
    buffer = np.empty(int(ends[-1]) if n else 0, np.uint8)
    gather(pool, start.ravel(), length.ravel(), buffer)
    head_chars = np.array([len(x) for x in heads], np.int64)[of]
    text_chars = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    return buffer, ends, head_chars, text_chars


def format_conversations(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Pieces of formatted conversations: conversation, place of the piece, text, n_turns and the
    spans of the text under the loss mask (start and end in characters)."""
    id_type = turns.schema[id_col].dataType.simpleString()
    turn_type = turns.schema[turn_col].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            role, text = batch.column("role"), batch.column("text")
            buffer, ends, head, chars = assemble(role, text)
            # A piece ends with the conversation or after so many turns.
            same = _same_as_before(batch.column("conv"))
            run = np.arange(n) - np.maximum.accumulate(np.where(same, 0, np.arange(n)))
            first = np.flatnonzero(run % PIECE_TURNS == 0)
            last = np.append(first[1:], n)
            byte_at = np.concatenate([[0], ends])
            offsets = byte_at[np.append(first, n)]
            formatted = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buffer)])
            total = _turn_chars(formatted, buffer, byte_at)
            char_at = np.concatenate([[0], np.cumsum(total)])
            trained = pc.fill_null(pc.equal(role.cast(pa.string()), TRAINED), False).to_numpy(zero_copy_only=False)
            spans = []
            for a, b in zip(first.tolist(), last.tolist()):
                rows = np.flatnonzero(trained[a:b]) + a
                begin = char_at[rows] - char_at[a] + head[rows]
                spans.append([{"start": s, "end": e} for s, e in zip(begin.tolist(), (begin + chars[rows]).tolist())])
            number_of = np.arange(number, number + len(first))
            number += len(first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv").take(pa.array(first)),
                    batch.column("turn").take(pa.array(first)),
                    pa.array(number_of, pa.int64()),
                    pa.array(last - first, pa.int64()),
                    formatted.cast(pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                ["conv", "turn", "number", "n_turns", "formatted", "loss"],
            )

    rows = turns.select(
        turns[id_col].alias("conv"), turns[turn_col].alias("turn"), turns[role_col].alias("role"), turns[text_col].alias("text")
    )
    order = ["conv", "turn", "role", "text"]
    dealt = rows.repartitionByRange(F.col("conv"), F.col("turn"), F.col("role"), F.left("text", F.lit(32))).sortWithinPartitions(*order)
    schema = f"conv {id_type}, turn {turn_type}, number long, n_turns long, formatted string, loss array<struct<start: long, end: long>>"
    out = dealt.mapInArrow(pieces, schema)
    place = F.struct(F.spark_partition_id().alias("part"), F.col("number"))
    return out.select(F.col("conv").alias(id_col), place.alias("place"), "n_turns", "formatted", "loss")


def _same_as_before(conv: pa.Array) -> np.ndarray:
    same = np.zeros(len(conv), bool)
    if len(conv) > 1:
        a, b = conv.slice(0, len(conv) - 1), conv.slice(1)
        equal = pc.fill_null(pc.equal(a, b), False)
        both_null = pc.and_(pc.is_null(a), pc.is_null(b))
        same[1:] = pc.or_(equal, both_null).to_numpy(zero_copy_only=False)
    return same


def _turn_chars(formatted: pa.Array, buffer: np.ndarray, byte_at: np.ndarray) -> np.ndarray:
    """Characters of each turn: the bytes that begin one."""
    begins = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
    return np.diff(begins[byte_at])


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of the turns of a piece."""
    role_of_head = {head.strip(): (role, tail) for role, (head, tail) in TEMPLATE.items() if head}
    at = 0
    marks = re.compile(MARKS)
    while at < len(formatted):
        mark = marks.match(formatted, at)
        if mark is None or mark.group() == TEMPLATE[TRAINED][1]:
            tail = formatted.index(TEMPLATE[TRAINED][1], at)
            yield TRAINED, unescape(formatted[at:tail])
            at = tail + len(TEMPLATE[TRAINED][1])
        elif mark.group() in role_of_head:
            role, end = role_of_head[mark.group()]
            start = at + len(TEMPLATE[role][0])
            tail = formatted.index(end.strip(), start) - 1
            yield role, unescape(formatted[start:tail])
            at = tail + len(end)
        else:
            start = at + len(OTHER_HEAD[0])
            stop = formatted.index(OTHER_HEAD[1].strip(), start) - 1
            body = stop + len(OTHER_HEAD[1])
            tail = formatted.index(OTHER_TAIL, body)
            yield unescape(formatted[start:stop]), unescape(formatted[body:tail])
            at = tail + len(OTHER_TAIL)


def digests(pieces: DataFrame, id_col: str) -> DataFrame:
    """Reads formatted pieces back: turns, digest of the turns, and what the loss mask covers.

    A digest runs over a conversation from its first turn to its last, so the pieces of one
    conversation meet in one task, which reads them in order and keeps only the running digests.
    """
    id_type = pieces.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key, begun = None, None, False
        done: list[tuple] = []

        def row() -> tuple:
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        def out() -> pa.RecordBatch:
            names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [key_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

        for batch in batches:
            key_kind = batch.schema.field(0).type
            for conv, formatted, loss in zip(batch.column(0).to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                if not begun or conv != key:
                    if begun:
                        done.append(row())
                    key, begun, state = conv, True, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"] : span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(formatted)
            if done:
                yield out()
                done.clear()
        if begun:
            done.append(row())
            yield out()

    schema = f"key {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = pieces.select(pieces[id_col].alias("key"), "place", "formatted", "loss")
    dealt = rows.repartition("key").sortWithinPartitions("key", "place")
    return dealt.mapInArrow(run, schema).withColumnRenamed("key", id_col)
