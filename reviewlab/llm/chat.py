r"""Chat formatting by columnar byte assembly.

A conversation becomes one text: every turn is ``### role: text </turn>`` and a line break.
Inside roles and texts a backslash stands in front of every backslash, ``#`` and ``<`` (in roles
of ``:`` too), so a text can hold no control string, and dropping those backslashes gives the
text back.

The rows of a conversation are brought together by one shuffle on its id and sorted inside the
partitions; no row is collected into a group. Of the turns of a batch numpy computes the segment
lengths, their cumulative offsets and the scatter indices, and copies headers and contents into
one preallocated Arrow buffer. A conversation that goes over batches is finished with the batch
that ends it.

Defined results: a null role or text is empty; turns are ordered by turn, then role and text, a
null turn first; rows repeated in full are turns of their own; rows without a conversation id
make one conversation without an id; an empty table gives an empty table. Columns other than the
four named ones are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.arrays import flat_text, one_array, ranges
from reviewlab.llm.frames import shipped

# Fixed values of the template.
HEAD, MIDDLE, TAIL = b"### ", b": ", b" </turn>\n"
ASSISTANT = "assistant"
ROLE_ESCAPES, TEXT_ESCAPES = b"\\#<:", b"\\#<"
SCHEMA = "formatted string, loss array<struct<start:int,end:int>>"
ARROW_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.)*+)</turn>\n", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(data: np.ndarray, offsets: np.ndarray, chars: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Put a backslash in front of some ASCII bytes of flat texts."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    marked = table[data]
    shift = np.append(0, np.cumsum(marked))
    out = np.full(len(data) + int(shift[-1]), ord("\\"), np.uint8)
    out[np.arange(len(data)) + shift[1:]] = data
    return out, offsets + shift[offsets]


def assemble(first: np.ndarray, role: pa.Array, text: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(formatted, loss spans) of whole conversations; ``first`` are the rows that begin one."""
    role_raw, role_at = escape(*flat_text(role), ROLE_ESCAPES)
    text_raw, text_at = escape(*flat_text(text), TEXT_ESCAPES)
    rows = len(role)
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    size = np.zeros((rows, 5), np.int64)
    size[:, 0], size[:, 2], size[:, 4] = len(HEAD), len(MIDDLE), len(TAIL)
    size[:, 1], size[:, 3] = role_len, text_len
    ends = np.cumsum(size.ravel())
    begins = (ends - size.ravel()).reshape(rows, 5)
    buffer = np.empty(int(ends[-1]) if rows else 0, np.uint8)
    for column, constant in ((0, HEAD), (2, MIDDLE), (4, TAIL)):
        where = begins[:, column, None] + np.arange(len(constant))
        buffer[where] = np.frombuffer(constant, np.uint8)
    buffer[ranges(begins[:, 1], role_len)] = role_raw
    buffer[ranges(begins[:, 3], text_len)] = text_raw
    offsets = np.append(begins[first, 0], len(buffer)).astype(np.int64)
    formatted = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(offsets), pa.py_buffer(buffer)
    )
    # code points before every byte
    points = np.append(0, np.cumsum((buffer & 0xC0) != 0x80))
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, rows)))
    start = points[begins[:, 3]] - points[offsets[of]]
    end = points[begins[:, 3] + text_len] - points[offsets[of]]
    learnt = np.asarray(pc.equal(one_array(role).fill_null(""), ASSISTANT))
    counts = np.append(0, np.cumsum(np.bincount(of[learnt], minlength=len(first))))
    spans = pa.StructArray.from_arrays(
        [pa.array(start[learnt], pa.int32()), pa.array(end[learnt], pa.int32())], ["start", "end"]
    )
    return formatted, pa.ListArray.from_arrays(pa.array(counts, pa.int32()), spans)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[pa.Table] = []
    last = None

    def out(table: pa.Table) -> pa.RecordBatch:
        key, role, text = (one_array(table[c]) for c in ("key", "role", "text"))
        first = np.flatnonzero(np.append(True, _changes(key)))
        formatted, loss = assemble(first, role, text)
        return pa.RecordBatch.from_arrays(
            [key.take(pa.array(first)), formatted.cast(pa.string()), loss.cast(ARROW_LOSS)],
            ["key", "formatted", "loss"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        key = one_array(table["key"])
        cuts = np.flatnonzero(_changes(key)) + 1
        goes_on = bool(kept) and key[0].as_py() == last
        if kept and not goes_on:
            yield out(pa.concat_tables(kept))
            kept = []
        if len(cuts):
            yield out(pa.concat_tables([*kept, table.slice(0, int(cuts[-1]))]))
            kept = [table.slice(int(cuts[-1]))]
        else:
            kept.append(table)
        last = key[-1].as_py()
    if kept:
        yield out(pa.concat_tables(kept))


def _changes(key: pa.Array) -> np.ndarray:
    """Whether row i + 1 has another key than row i; two nulls are equal."""
    a, b = key.slice(0, len(key) - 1), key.slice(1)
    differ = pc.not_equal(a, b).fill_null(False)
    return np.asarray(pc.or_(differ, pc.xor(a.is_null(), b.is_null())))


def format_conversations(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, formatted, loss): one text per conversation and, in code points, what is learnt."""
    rows = shipped(df).select(
        df[key].alias("key"), df[turn].alias("turn"), df[role].alias("role"), df[text].alias("text")
    )
    kind = rows.schema["key"].dataType.simpleString()
    rows = rows.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    done = rows.mapInArrow(_batches, f"key {kind}, {SCHEMA}")
    return done.withColumnRenamed("key", key)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[dict[str, str]]:
    """The turns of a formatted conversation; raises where the text isn't one."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None or not m[2].endswith(" "):
            raise ValueError(f"no turn at character {at}")
        turns.append({"role": unescape(m[1]), "text": unescape(m[2][:-1])})
        at = m.end()
    return turns


def read_back(df: DataFrame, formatted: str = "formatted", loss: str = "loss") -> DataFrame:
    """Add ``turns`` (role, text) and ``learnt``, all text under the loss mask, unescaped."""

    @F.arrow_udf("array<struct<role:string,text:string>>")
    def turns(column: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        return pa.array([parse(x.as_py() or "") for x in column], kind)

    @F.arrow_udf("string")
    def learnt(column: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for x, at in zip(column, spans):
            whole = x.as_py() or ""
            out.append(unescape("".join(whole[s["start"] : s["end"]] for s in at.as_py() or ())))
        return pa.array(out, pa.string())

    return shipped(df).withColumns(
        {"turns": turns(df[formatted]), "learnt": learnt(df[formatted], df[loss])}
    )
