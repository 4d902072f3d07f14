"""Conversations in one marked text with a loss mask, assembled in columns of bytes.

A turn is written as ``### role:`` and a line feed, the text, ``</turn>`` and a line feed.
Inside roles and texts a backslash goes before every backslash, ``###`` and ``</turn>``, and
in roles before every colon, so that nothing in a text can pass for a mark and every text
can be had back as it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices, utf8_view

FORMATTED = "conv_id long, part long, n_turns int, formatted string, loss_starts array<int>, loss_ends array<int>"
LEARNED = "assistant"
_IN_TEXT, _IN_ROLE = r"(\\|###|</turn>)", r"(\\|###|</turn>|:)"
_MARKS = re.compile(r"\\(?:\\|###|</turn>|:)|</turn>\n")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_HEADER = re.compile(r"### ((?:[^\\:]|\\.)*+):\n", re.S)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def assembled(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns laid end to end, turn offsets, and where each turn's text starts and ends.

    Headers, contents and closing marks are three columns of segments. Their lengths give
    the place of every segment in one buffer, and each column is scattered there at once.
    """
    shown = pc.replace_substring_regex(roles, pattern=_IN_ROLE, replacement=r"\\\1")
    headers = pc.binary_join_element_wise("### ", shown, ":\n", "")
    contents = pc.replace_substring_regex(texts, pattern=_IN_TEXT, replacement=r"\\\1")
    closing = np.frombuffer(b"</turn>\n", np.uint8)
    (head, head_at), (body, body_at) = utf8_view(headers), utf8_view(contents)
    rows = len(texts)
    tail, tail_at = np.tile(closing, rows), np.arange(rows + 1, dtype=np.int64) * len(closing)
    lengths = np.stack([np.diff(head_at), np.diff(body_at), np.diff(tail_at)], axis=1)
    ends = np.cumsum(lengths.reshape(-1)).reshape(rows, 3)
    starts = ends - lengths
    buffer = np.empty(int(ends[-1, -1]) if rows else 0, dtype=np.uint8)
    for column, (data, at) in enumerate(((head, head_at), (body, body_at), (tail, tail_at))):
        moved = np.repeat(starts[:, column] - at[:-1], lengths[:, column])
        buffer[np.arange(len(data)) + moved] = data
    turns = np.concatenate([[0], ends[:, 2]]) if rows else np.zeros(1, np.int64)
    return buffer, turns, starts[:, 1], ends[:, 1]


def formatted(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation, or per part of a long one: the marked text and its loss mask.

    Turns are ordered by ``turn``, ties by role and text. ``loss_starts`` and ``loss_ends``
    are byte offsets of the assistant's texts in ``formatted``. Rows are dealt out by
    ranges of conversation and turn, so that a very long conversation spreads over tasks;
    its parts follow each other in the order of ``part``. Null roles and texts count as
    empty, null turns come first, and null ids are one conversation. Repeated rows are
    turns of their own. Other columns are left out; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text"):
            roles = batch.column("role")
            buffer, at, opens, closes = assembled(roles, batch.column("text"))
            ids = batch.column("conv_id")
            plain = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            empty = np.asarray(ids.is_null())
            new = np.ones(len(plain), dtype=bool)
            new[1:] = (plain[1:] != plain[:-1]) | (empty[1:] != empty[:-1])
            first = np.flatnonzero(new)
            bounds = np.append(first, len(plain))
            learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
            base = np.repeat(at[first], np.diff(bounds))
            counted = np.concatenate([[0], np.cumsum(learned)])[bounds].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(first)),
                    pa.array(part + np.arange(len(first), dtype=np.int64)),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    pa.StringArray.from_buffers(
                        len(first), pa.py_buffer(at[bounds].astype(np.int32)), pa.py_buffer(buffer)
                    ),
                    pa.ListArray.from_arrays(pa.array(counted), pa.array((opens - base)[learned].astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(counted), pa.array((closes - base)[learned].astype(np.int32))),
                ],
                names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"],
            )
            part += len(first)

    empty = F.lit("")
    rows = turns.select(
        F.col(key).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text).cast("string"), empty).alias("text"),
    )
    ordered = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of a marked text, as they were before."""
    begin = 0
    for mark in _MARKS.finditer(text):
        if mark[0][0] == "<":
            header = _HEADER.match(text, begin)
            yield unescaped(header[1]), unescaped(text[header.end() : mark.start()])
            begin = mark.end()


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of each conversation, taken from its marked text and loss mask alone.

    Returns ``conv_id``, ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed per
    turn), ``loss_chars`` and ``loss_sha256`` (all text under the mask, unescaped) and
    ``formatted_chars``. The parts of a conversation stream through one task in order,
    which holds one part at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, key = False, None
        state: list = []

        def ended() -> list[pa.Array]:
            turns, whole, learned, chars, loss = state
            values = [key, turns, whole.hexdigest(), chars, loss.hexdigest(), learned]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)]

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            done = []
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "formatted", "loss_starts", "loss_ends")]
            for one, text, starts, ends in zip(*columns, strict=True):
                if not begun or one != key:
                    if begun:
                        done.append(ended())
                    begun, key, state = True, one, [0, hashlib.sha256(), 0, 0, hashlib.sha256()]
                for role, said in turns_of(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                raw = text.encode()
                for low, high in zip(starts, ends, strict=True):
                    learned = unescaped(raw[low:high].decode())
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[2] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*done, strict=True)], names=names)
        if begun:
            yield pa.RecordBatch.from_arrays(ended(), names=names)

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
