"""Chat formatting by columnar byte assembly.

A turn becomes ``### role: text</turn>`` and a line end. In roles and texts every
backslash, # and < gets a backslash before it, in roles : and line ends too, so that no
control string can arise and the form can be read back exactly. A batch of turns is
assembled at once: the lengths of all segments give cumulative offsets, and headers,
texts and escapes are scattered into one preallocated Arrow buffer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

END = b"</turn>\n"
_ESCAPE = ord("\\")
_SPECIAL = np.zeros(256, bool)
_SPECIAL[list(b"\\#<")] = True
_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*): (.*)</turn>\n", re.S)
_ESCAPED = re.compile(rb"\\(.)", re.S)


def header(role: str | None) -> bytes:
    """The opening of a turn; a null role counts as empty."""
    return b"### " + re.sub(rb"([\\#<:\n])", rb"\\\1", (role or "").encode()) + b": "


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... of each segment, end to end."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def assemble(roles: list[str | None], texts: pa.Array, speaker: str = "assistant") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted turns, and the start and end of the bytes under the loss mask in each.

    ``texts`` is a binary array; null counts as empty. The mask covers the texts of ``speaker``.
    """
    n = len(roles)
    texts = texts.fill_null(b"").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]] if n else np.zeros(0, np.uint8)
    sizes = np.diff(bounds)
    special = _SPECIAL[data]
    owner = np.repeat(np.arange(n), sizes)
    wide = sizes + np.bincount(owner[special], minlength=n)
    kinds = {r: i for i, r in enumerate(dict.fromkeys(roles))}
    heads = [header(r) for r in kinds]
    kind = np.array([kinds[r] for r in roles], np.int64)
    head_sizes = np.array([len(h) for h in heads], np.int64)[kind] if n else np.zeros(0, np.int64)
    total = head_sizes + wide + len(END)
    offsets = np.concatenate([[0], np.cumsum(total)])
    out = np.empty(int(offsets[-1]), np.uint8)
    text_at = offsets[:-1] + head_sizes
    # Headers come from one pool of the distinct ones.
    pool = np.frombuffer(b"".join(heads), np.uint8)
    pool_at = np.concatenate([[0], np.cumsum([len(h) for h in heads])[:-1]]).astype(np.int64)
    step = _ramp(head_sizes)
    out[np.repeat(offsets[:-1], head_sizes) + step] = pool[np.repeat(pool_at[kind], head_sizes) + step]
    # A text byte moves by the escapes before it in its text, its own included.
    escapes = np.cumsum(special)
    before = np.concatenate([[0], escapes])[bounds[:-1] - bounds[0]] if n else escapes
    to = np.repeat(text_at, sizes) + _ramp(sizes) + escapes - np.repeat(before, sizes)
    out[to] = data
    out[to[special] - 1] = _ESCAPE
    out[(offsets[1:, None] - len(END) + np.arange(len(END))).ravel()] = np.tile(np.frombuffer(END, np.uint8), n)
    array = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    spoken = np.array([r == speaker for r in roles], bool)
    return array, np.where(spoken, text_at - offsets[:-1], 0), np.where(spoken, text_at - offsets[:-1] + wide, 0)


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, formatted (bytes), loss_start and loss_end (bytes of ``formatted``) of every row.

    A conversation's form is that of its turns end to end. Repeated rows are repeated turns.
    """
    small_batches(conversations.sparkSession, 2048)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, start, end = assemble(batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), formatted.cast(pa.binary()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                ["conv_id", "turn", "formatted", "loss_start", "loss_end"],
            )

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, formatted binary, loss_start long, loss_end long")


def parse_turn(turn: bytes) -> tuple[bytes, bytes]:
    """Role and text of a formatted turn."""
    role, text = _TURN.fullmatch(turn).groups()
    return _ESCAPED.sub(rb"\1", role), _ESCAPED.sub(rb"\1", text)


def characters(text: bytes) -> int:
    return len(text) - sum(text.count(bytes([b])) for b in set(text) if 0x80 <= b < 0xC0)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, read from its formatted turns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns follow ``turn``, nulls first, then their bytes. Rows of a conversation stream
    through one task in order and are not held: only the digests' states are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row():
            return pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": lost, "loss_sha256": loss.hexdigest(), "formatted_chars": size}],
                schema=pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]),
            )

        done, open_conv = [], False
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            for key, turn, start, end in zip(*columns, strict=True):
                if not open_conv or key != conv:
                    if open_conv:
                        done.append(row())
                    conv, open_conv, n, lost, size = key, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                role, text = parse_turn(turn)
                turns.update(role + b"\n" + text + b"\n")
                spoken = _ESCAPED.sub(rb"\1", turn[start:end])
                loss.update(spoken)
                n, lost, size = n + 1, lost + characters(spoken), size + characters(turn)
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done = []
        if open_conv:
            yield row()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "formatted")
    ordered = ordered.select("conv_id", "turn", "formatted", "loss_start", "loss_end")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
