"""Packing token sequences into fixed windows by non-negative least squares.

Whole windows are cut off long documents first. For the rest, short combinations of
lengths that fill a window exactly are enumerated, non-negative least squares solves how
often each should be used to match the histogram of lengths, and the counts are rounded
to what is there. Documents left over are laid end to end, longest first, and cut where a
window ends. The last, unfilled window is cut into powers of two, which need no padding.

A block of documents is packed where it lies: each task streams its rows, holds one block
of bounded size and moves nothing between tasks.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

_CHUNK = re.compile(r"[^ \t\n\r]+")
_ODD = re.compile(r"[^ \t\n\rA-Za-z0-9.,;:!?()\[\]{}\"#$%&*+/@\\^_|~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff-]")
_RUN = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[^ \t\n\ra-z\u00df-\u00f6\u00f8-\u00ff]+")


@dataclass(frozen=True)
class Settings:
    window: int = 2048
    end_id: int = 1
    block_docs: int = 20_000
    block_tokens: int = 8_000_000
    frequent: int = 48  # lengths that combinations of three or more are made of
    steps: int = 150
    words_held: int = 400_000


class WordTokenizer:
    """Token ids of texts by a vocabulary file that lower-cases and drops white space.

    A text of Latin letters, digits and common signs is cut, lower-cased, into runs of
    letters and of other characters, which such a tokenizer never joins; any other text is
    cut at white space only. Runs are encoded once and remembered; the memory is emptied
    when it holds too many.
    """

    def __init__(self, path: str, words_held: int = Settings.words_held):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer, self.held, self.words_held = Tokenizer.from_file(path), {}, words_held
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")

    def _learn(self, runs: set[str]) -> None:
        """Encode new runs; those of letters, one word each, all in one call."""
        words = [r for r in runs if r.isalpha() and not _ODD.search(r)]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        raw, start = ids.tobytes(), 0
        if len(cuts) == len(words):
            for word, cut in zip(words, (cuts * 4).tolist(), strict=True):
                self.held[word], start = raw[start:cut], cut
        rest = [r for r in runs if r not in self.held]
        for run, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.held[run] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.held) > self.words_held:
            self.held.clear()
        out = []
        for text in texts:
            text = text or ""
            runs = _CHUNK.findall(text) if _ODD.search(text) else _RUN.findall(text.lower())
            found = list(map(self.held.get, runs))
            if None in found:
                self._learn({r for r, x in zip(runs, found, strict=True) if x is None})
                found = map(self.held.__getitem__, runs)
            out.append(np.frombuffer(b"".join(found), "<u4"))
        return out


def combinations(lengths: Counter, settings: Settings) -> list[tuple[int, ...]]:
    """Multisets of the lengths present that sum to the window: pairs, then some of three and four,
    and runs of one frequent length with one other that completes them."""
    window, have = settings.window, set(lengths)
    out = {(a, window - a) for a in have if 2 * a >= window and window - a in have}
    top = [n for n, _ in sorted(lengths.items(), key=lambda x: (-x[1], x[0]))[: settings.frequent]]
    for i, a in enumerate(top):
        for b in top[i:]:
            rest = window - a - b
            if rest in have:
                out.add(tuple(sorted((a, b, rest), reverse=True)))
            if rest > 0 and rest % 2 == 0 and rest // 2 in have:
                out.add(tuple(sorted((a, b, rest // 2, rest // 2), reverse=True)))
        for n in range(4, window // a + 1):
            if n * a == window or window - n * a in have:
                out.add(tuple(sorted((a,) * n + ((window - n * a,) if n * a < window else ()), reverse=True)))
    return sorted(out, reverse=True)


def solve_counts(combos: list[tuple[int, ...]], lengths: Counter, settings: Settings) -> np.ndarray:
    """Non-negative x for which the combinations use each length about as often as it occurs.

    Least squares by accelerated projected gradient on the sparse incidence.
    """
    number = {n: i for i, n in enumerate(sorted(lengths))}
    target = np.array([lengths[n] for n in sorted(lengths)], float)
    cells = [(number[n], j, k) for j, c in enumerate(combos) for n, k in Counter(c).items()]
    row, col, times = (np.array(x) for x in zip(*cells, strict=True))
    row_sum, col_sum = np.bincount(row, times, len(target)), np.bincount(col, times, len(combos))
    bound = row_sum.max() * col_sum.max()  # at least the squared norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(settings.steps):
        miss = np.bincount(row, times * y[col], len(target)) - target
        step = np.maximum(0, y - np.bincount(col, times * miss[row], len(combos)) / bound)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = step + (t - 1) / after * (step - x), step, after
    return np.maximum(x, 0)


class Packer:
    """Packs the blocks of one task; pieces come out as (doc, start, ids, sequence, offset)."""

    def __init__(self, settings: Settings, first_sequence: int):
        self.settings, self.sequence = settings, first_sequence
        self.docs: list[tuple[object, int, np.ndarray]] = []
        self.held = 0
        self.open: list[tuple[object, int, np.ndarray]] = []  # pieces of the window being filled
        self.filled = 0

    def _close(self, pieces) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids in pieces:
            yield doc, start, ids, self.sequence, offset
            offset += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        window = self.settings.window
        whole = len(ids) - len(ids) % window
        for start in range(0, whole, window):
            yield from self._close([(doc, start, ids[start : start + window])])
        if whole < len(ids):
            self.docs.append((doc, whole, ids[whole:].copy()))
            self.held += len(ids) - whole
        if len(self.docs) >= self.settings.block_docs or self.held >= self.settings.block_tokens:
            yield from self._block()

    def _block(self) -> Iterator[tuple]:
        by_length: dict[int, list] = {}
        for piece in self.docs:
            by_length.setdefault(len(piece[2]), []).append(piece)
        self.docs, self.held = [], 0
        lengths = Counter({n: len(p) for n, p in by_length.items()})
        combos = combinations(lengths, self.settings) if lengths else []
        if combos:
            wanted = np.floor(solve_counts(combos, lengths, self.settings) + 0.5).astype(int)
            for j in np.argsort(-wanted, kind="stable"):
                need = Counter(combos[j])
                for _ in range(min(int(wanted[j]), *(len(by_length[n]) // k for n, k in need.items()))):
                    yield from self._close([by_length[n].pop() for n in combos[j]])
        for n in sorted(by_length, reverse=True):
            for doc, start, ids in by_length[n]:
                while len(ids):
                    part = ids[: self.settings.window - self.filled]
                    self.open.append((doc, start, part))
                    self.filled += len(part)
                    ids, start = ids[len(part) :], start + len(part)
                    if self.filled == self.settings.window:
                        yield from self._close(self.open)
                        self.open, self.filled = [], 0

    def finish(self) -> Iterator[tuple]:
        """The last block, and the open window as sequences of powers of two."""
        yield from self._block()
        left = self.filled
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                doc, start, ids = self.open[0]
                pieces.append((doc, start, ids[:room]))
                if len(ids) > room:
                    self.open[0] = (doc, start + room, ids[room:])
                else:
                    self.open.pop(0)
                room -= len(pieces[-1][2])
            yield from self._close(pieces)
        self.open, self.filled = [], 0


def pack(documents: DataFrame, make_tokenizer: Callable[[], WordTokenizer], settings: Settings = Settings()) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset.

    A document is its token ids and ``end_id``; null and empty texts are ``end_id`` alone.
    Every sequence is full or a power of two long. Repeated rows are packed as often as
    they occur, rows without an id keep a null id.
    """
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = make_tokenizer()
        packer = Packer(settings, TaskContext.get().partitionId() << 32)
        end = np.array([settings.end_id], "<u4")

        def out(pieces):
            docs, starts, ids, sequences, offsets = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([d[0] for d in docs], pa.int64()), pa.array(starts, pa.int64()), pa.array(map(len, ids), pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([d[1] for d in docs], pa.int64()),
                    pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64()),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        held = []
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(batch.column(1).to_pylist()), strict=True):
                for piece in packer.add((doc, len(ids) + 1), np.concatenate([ids, end])):
                    held.append(piece)
                    if len(held) >= 1000:
                        yield out(held)
                        held = []
        for piece in packer.finish():
            held.append(piece)
            if len(held) >= 1000:
                yield out(held)
                held = []
        if held:
            yield out(held)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
