"""Fill-in-middle by secondary sort.

A document is cut into units, its lines, and two unit borders drawn from a hash of its id
part it into prefix, middle and suffix. Chunks of units become pieces keyed by document
and position in the output. One exchange by document, sorted within partitions by document
and position (what ``repartitionAndSortWithinPartitions`` does on an RDD), brings the
pieces in output order; they stream through an incremental digest, so a document of any
length is assembled in the memory of a piece. Restoration reads that output, takes every
piece's part from the marks before it, sorts the pieces again within the same partitions
by their place in the original and streams them through a second digest.

Texts are handled as UTF-8 bytes. A text that is empty or holds one of the marks is left
plain, so the marks of the others are found without doubt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes

# The marks before each part.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
# Place of each part in the original.
PLACES = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

# The document of a piece: rows that share an id, or are equal, stay apart.
ROW = ["doc_id", "text_id", "task", "copy"]
HEAD = ["n", "form", "prefix_chars", "middle_chars"]
_ROW_TYPES = "doc_id long, text_id long, task int, copy long"
_HEAD_TYPES = "n long, form string, prefix_chars long, middle_chars long"
_BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Settings:
    seed: int = 7
    percent: int = 100  # of the documents that may be transformed
    spm_percent: int = 50  # of these, with the suffix first
    piece_bytes: int = 1 << 16  # a piece holds whole units up to here, or part of a longer one


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers of a document; one without an id has those of an empty id."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def chars(text: bytes) -> int:
    """Code points of UTF-8: the bytes that do not continue one."""
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


@dataclass(frozen=True)
class Plan:
    """How a text is cut: its form, its units' ends, and the byte borders of the middle."""

    form: str
    ends: np.ndarray
    first: int
    last: int


def plan(doc_id: int | None, text: bytes, settings: Settings) -> Plan:
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if text and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    h1, h2, h3, h4 = draws(doc_id, settings.seed)
    if not text or h3 % 100 >= settings.percent or any(m in text for m in MARKS):
        return Plan("plain", ends, 0, 0)
    a, b = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    at = lambda k: int(ends[k - 1]) if k else 0
    return Plan("spm" if h4 % 100 < settings.spm_percent else "psm", ends, at(a), at(b))


def chunks(text: bytes, ends: np.ndarray, low: int, high: int, limit: int) -> Iterator[bytes]:
    """``text[low:high]`` in pieces of whole units up to ``limit`` bytes, longer units cut."""
    while low < high:
        cut = min(high, low + limit)
        if cut < high:
            unit = int(np.searchsorted(ends, cut, "right")) - 1
            if unit >= 0 and ends[unit] > low:
                cut = int(ends[unit])
        yield text[low:cut]
        low = cut


def output(text: bytes, cut: Plan, limit: int) -> Iterator[bytes]:
    """The pieces of the output in order; a mark is a piece of its own, and there is one piece at least."""
    if cut.form == "plain":
        yield from chunks(text, cut.ends, 0, len(text), limit) if text else [b""]
        return
    span = {PREFIX: (0, cut.first), MIDDLE: (cut.first, cut.last), SUFFIX: (cut.last, len(text))}
    for part in ORDERS[cut.form]:
        yield part
        yield from chunks(text, cut.ends, *span[part], limit)


def restore(out: bytes, form: str) -> bytes:
    """The original of one whole output."""
    if form == "plain":
        return out
    parts, at = {}, [(out.index(m), m) for m in ORDERS[form]]
    for (start, mark), end in zip(at, [*[p for p, _ in at[1:]], len(out)], strict=True):
        parts[mark] = out[start + len(mark) : end]
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]


class _Rows:
    """Rows gathered to Arrow batches of a few megabytes."""

    def __init__(self, schema: pa.Schema, sized: int | None = None):
        self.schema, self.sized = schema, sized
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, *row) -> bool:
        self.rows.append(row)
        self.bytes += 64 + (len(row[self.sized] or b"") if self.sized is not None else 0)
        return self.bytes >= _BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.bytes = [], 0
        return batch


_LONG, _INT, _TEXT, _BYTES = pa.int64(), pa.int32(), pa.string(), pa.binary()
_ROW_ARROW = [("doc_id", _LONG), ("text_id", _LONG), ("task", _INT), ("copy", _LONG)]
_HEAD_ARROW = [("n", _LONG), ("form", _TEXT), ("prefix_chars", _LONG), ("middle_chars", _LONG)]


def pieces(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The output's pieces: the document's key, ``pos`` in the output, ``chunk``; the first one carries the head."""
    schema = pa.schema([*_ROW_ARROW, ("pos", _LONG), ("chunk", _BYTES), *_HEAD_ARROW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy, out = 0, _Rows(schema, 5)
        for batch in slices(batches):
            for doc_id, text, text_id, task in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cut, copy = plan(doc_id, text, settings), copy + 1
                head = (len(cut.ends), cut.form, None, None)
                if cut.form != "plain":
                    head = (len(cut.ends), cut.form, chars(text[: cut.first]), chars(text[cut.first : cut.last]))
                for pos, chunk in enumerate(output(text, cut, settings.piece_bytes)):
                    if out.add(doc_id, text_id, task, copy, pos, chunk, *(head if pos == 0 else (None,) * 4)):
                        yield out.take()
        yield out.take()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    # A row's partition depends on itself and its task alone, so a task that runs again sends it to the same place.
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_id"), F.spark_partition_id().alias("task"))
    return rows.mapInArrow(run, f"{_ROW_TYPES}, pos long, chunk binary, {_HEAD_TYPES}")


def in_output_order(found: DataFrame) -> DataFrame:
    """``pieces`` exchanged by document and sorted by document and position."""
    return found.repartition("doc_id", "text_id", "task").sortWithinPartitions(*ROW, "pos")


def _documents(batches: Iterator[pa.RecordBatch], columns: list[str], begin: Callable, more: Callable, end: Callable) -> Iterator[pa.RecordBatch]:
    """Walk sorted pieces: ``begin`` a document at its first piece, feed it ``more``, ``end`` it after its last.

    Each may return a batch to give out. Nothing of a document is held here.
    """
    last = None
    for batch in batches:
        for row, values in zip(zip(*(batch.column(c).to_pylist() for c in ROW)), zip(*(batch.column(c).to_pylist() for c in columns)), strict=True):
            if row != last:
                if last is not None and (made := end()):
                    yield made
                last = row
                begin(row, values)
            if made := more(values):
                yield made
    if last is not None and (made := end()):
        yield made


def assembled(found: DataFrame) -> DataFrame:
    """Every document's output digest, and its pieces with their place in the original.

    ``place`` -1 is the row of the digest and the head; the places of the others come from
    the marks read in the output.
    """
    schema = pa.schema([*_ROW_ARROW, ("place", _LONG), ("chunk", _BYTES), *_HEAD_ARROW, ("output_sha256", _TEXT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = _Rows(schema, 5), {}

        def begin(row, values):
            now.update(row=row, head=values[1:], digest=sha256(), part=0, count=0)

        def more(values):
            chunk = values[0]
            now["digest"].update(chunk)
            if now["head"][1] != "plain" and chunk in PLACES:
                now["part"] = PLACES[chunk]
                return None
            now["count"] += 1
            full = out.add(*now["row"], (now["part"] << 56) + now["count"], chunk, None, None, None, None, None)
            return out.take() if full else None

        def end():
            full = out.add(*now["row"], -1, None, *now["head"], now["digest"].hexdigest())
            return out.take() if full else None

        yield from _documents(batches, ["chunk", *HEAD], begin, more, end)
        yield out.take()

    return in_output_order(found).mapInArrow(run, f"{_ROW_TYPES}, place long, chunk binary, {_HEAD_TYPES}, output_sha256 string")


def digests(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored text, one row per row.

    A null text counts as empty and is plain, with no units. Rows that share a doc_id, equal
    or not, each have a row of their own; rows without an id draw from an empty id. Other
    columns are not read.
    """
    schema = pa.schema([("doc_id", _LONG), *_HEAD_ARROW, ("output_sha256", _TEXT), ("restored_sha256", _TEXT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = _Rows(schema), {}

        def begin(row, values):
            now.update(doc_id=row[0], head=values[1:], digest=sha256())

        def more(values):
            now["digest"].update(values[0] or b"")

        def end():
            return out.take() if out.add(now["doc_id"], *now["head"], now["digest"].hexdigest()) else None

        yield from _documents(batches, ["chunk", *HEAD, "output_sha256"], begin, more, end)
        yield out.take()

    # The pieces of a document lie in one partition already: restoring sorts again and exchanges nothing.
    again = assembled(pieces(documents, settings)).sortWithinPartitions(*ROW, "place")
    return again.mapInArrow(run, f"doc_id long, {_HEAD_TYPES}, output_sha256 string, restored_sha256 string")


def transform(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output ``text`` of every row."""
    schema = pa.schema([("doc_id", _LONG), *_HEAD_ARROW, ("text", _BYTES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = _Rows(schema, 5), {}

        def begin(row, values):
            now.update(doc_id=row[0], head=values[1:], chunks=[])

        def more(values):
            now["chunks"].append(values[0])

        def end():
            return out.take() if out.add(now["doc_id"], *now["head"], b"".join(now["chunks"])) else None

        yield from _documents(batches, ["chunk", *HEAD], begin, more, end)
        yield out.take()

    rows = in_output_order(pieces(documents, settings)).mapInArrow(run, f"doc_id long, {_HEAD_TYPES}, text binary")
    return rows.withColumn("text", F.col("text").cast("string"))
