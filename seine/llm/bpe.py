"""Byte-level BPE encoding and decoding.

Texts are cut into pre-tokens without regular expressions. Code points are mapped to
classes; each class is a transition function of a small automaton over the texts laid end
to end. Functions compose associatively, so a blocked scan gives the state at every code
point: functions are composed within columns, the columns' results are scanned in the
same way, and states are then carried down. Boundaries follow from a state, its class and
the class after it. Pre-tokens are looked up in a memory of merged ones; new ones are
merged pair by pair, least rank first.

The pre-tokens are those of the pattern
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
"""

from __future__ import annotations

import base64
import hashlib
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

WORDS_HELD = 300_000
BLOCK = 64
_WIDE = 64  # bytes of the pre-tokens that are merged many at a time
_NONE = 1 << 40

# Classes of code points.
SPACE, WHITE, SHORT, R, V, E, ELL, LETTER, NUMBER, QUOTE, OTHER, EDGE = range(12)
# States after a code point: the run it belongs to; a lone space; white space; an
# apostrophe that begins a pre-token, alone or with r, v or l; a whole contraction.
BEGIN, IN_L, IN_N, IN_O, LONE, BLANK, APO, APO_R, APO_V, APO_L, DONE = range(11)


def _transitions() -> np.ndarray:
    t = np.empty((12, 11), np.uint8)
    t[SPACE], t[WHITE], t[NUMBER], t[OTHER], t[EDGE] = LONE, BLANK, IN_N, IN_O, BEGIN
    t[[SHORT, R, V, E, ELL, LETTER]] = IN_L
    t[QUOTE] = APO
    t[QUOTE, [LONE, IN_O, APO]] = IN_O
    t[SHORT, APO], t[R, APO], t[V, APO], t[ELL, APO] = DONE, APO_R, APO_V, APO_L
    t[E, APO_R] = t[E, APO_V] = t[ELL, APO_L] = DONE
    return t


TRANSITIONS = _transitions()


def code_classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    # White_Space of Unicode, a fixed set; str.isspace also takes the separators 1C to 1F.
    out[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
    out[ord(" ")], out[ord("'")] = SPACE, QUOTE
    out[[ord(c) for c in "stmd"]] = SHORT
    out[ord("r")], out[ord("v")], out[ord("e")], out[ord("l")] = R, V, E, ELL
    return out


def states(classes: np.ndarray, entry: int = BEGIN) -> np.ndarray:
    """The automaton's state after each code point."""
    return _scan(TRANSITIONS[classes], entry) if len(classes) <= BLOCK else _blocks(classes, entry)


def _scan(functions: np.ndarray, entry: int) -> np.ndarray:
    """States after each of some functions (position, state), in blocks when there are many."""
    n, q = functions.shape
    if n <= BLOCK:
        out = np.empty(n, np.uint8)
        for i in range(n):
            entry = out[i] = functions[i, entry]
        return out
    rows = -(-n // BLOCK)
    padded = np.empty((rows * BLOCK, q), np.uint8)
    padded[:n], padded[n:] = functions, np.arange(q, dtype=np.uint8)
    padded = padded.reshape(rows, BLOCK, q)
    whole = padded[:, 0].copy()
    for k in range(1, BLOCK):
        whole = np.take_along_axis(padded[:, k], whole, 1)
    state = np.concatenate([[entry], _scan(whole, entry)[:-1]]).astype(np.uint8)
    out = np.empty((rows, BLOCK), np.uint8)
    for k in range(BLOCK):
        state = out[:, k] = padded[np.arange(rows), k, state]
    return out.ravel()[:n]


def _blocks(classes: np.ndarray, entry: int) -> np.ndarray:
    """As ``_scan`` of the classes' functions, which are looked up rather than laid out."""
    rows = -(-len(classes) // BLOCK)
    padded = np.full(rows * BLOCK, EDGE, np.uint8)
    padded[: len(classes)] = classes
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T).astype(np.intp)
    q = TRANSITIONS.shape[1]
    flat, base = TRANSITIONS.ravel(), columns * q
    whole = np.ascontiguousarray(TRANSITIONS[columns[0]].T)
    for k in range(1, BLOCK):
        whole = flat[base[k] + whole]
    state = np.concatenate([[entry], _scan(np.ascontiguousarray(whole.T), entry)[:-1]]).astype(np.uint8)
    out = np.empty((BLOCK, rows), np.uint8)
    for k in range(BLOCK):
        state = out[k] = flat[base[k] + state]
    return out.T.ravel()[: len(classes)]


def starts(classes: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, as a mask; EDGE positions, which stand between texts, begin one too."""
    after = states(classes)
    before = np.concatenate([[BEGIN], after[:-1]]).astype(np.uint8)
    following = np.concatenate([classes[1:], [EDGE]]).astype(np.uint8)
    white = classes <= WHITE
    was_white = (before == LONE) | (before == BLANK)
    # White space begins a pre-token where its run begins, and once more at its last one if a text goes on.
    ends_run = (following > WHITE) & (following != EDGE)
    out = np.where(white, ~was_white | ends_run, False)
    # Other characters begin one where the run changes, but not behind the space that they take in.
    goes_on = (after == before) & ((after == IN_L) | (after == IN_N) | (after == IN_O))
    taken = (before == LONE) | ((before == APO) & (after == IN_O)) | goes_on
    letters = (after == IN_L) & ((before == APO_R) | (before == APO_V) | (before == APO_L))
    out |= ~white & ~taken & ~letters & (after != DONE)
    # r, v and l behind an apostrophe begin one unless a contraction completes.
    later = np.concatenate([after[1:], [BEGIN]]).astype(np.uint8)
    waiting = (after >= APO_R) & (after <= APO_L)
    out[waiting] = later[waiting] != DONE
    out[classes == EDGE] = True
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Codec:
    """Encodes texts to ids and decodes ids to bytes by a rank file."""

    def __init__(self, path: str):
        self.ranks, self.classes = read_ranks(path), code_classes()
        by_id = {i: token for token, i in self.ranks.items()}
        size = max(by_id) + 1
        tokens = [by_id.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(t) for t in tokens])
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)
        pairs = sorted(
            (self.ranks[t[:k]] << 32 | self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks
        )
        self.pairs, self.joined = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(1, np.int64) - 1,) * 2
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)])
        self.held: dict[bytes, tuple[bytes, bytes]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the adjacent pair of least rank is joined, leftmost first, until none is known."""
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        parts = [word[i : i + 1] for i in range(len(word))]
        costs = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            known = [c for c in costs if c is not None]
            if not known:
                return [ranks[p] for p in parts]
            i = costs.index(min(known))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = ranks.get(parts[i] + parts[i + 1])
            if i:
                costs[i - 1] = ranks.get(parts[i - 1] + parts[i])

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of pairs joined; a large number where a pair has none or an end is missing."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.joined[at], _NONE)

    def merge_many(self, words: list[bytes]) -> list[np.ndarray]:
        """``merge`` of many pre-tokens of similar length at once, one join a round in each."""
        width = max(map(len, words))
        sizes = np.array([len(w) for w in words])
        ids = self.bytes[np.frombuffer(b"".join(w.ljust(width) for w in words), np.uint8).reshape(len(words), width)]
        ids[np.arange(width) >= sizes[:, None]] = -1
        ids = np.hstack([ids, np.full((len(words), 1), -1)])
        costs = np.hstack([self._joins(ids[:, :-1], ids[:, 1:]), np.full((len(words), 1), _NONE)])
        going, place = np.arange(len(words)), np.arange(width + 1)
        while len(going):
            c = costs[going]
            i = c.argmin(1)
            best = c[np.arange(len(going)), i]
            going, i, best = going[best < _NONE], i[best < _NONE], best[best < _NONE]
            if not len(going):
                break
            shift = np.minimum(place + (place > i[:, None]), width)
            moved = np.take_along_axis(ids[going], shift, 1)
            rows = np.arange(len(going))
            moved[rows, i] = best
            ids[going] = moved
            c = np.take_along_axis(costs[going], shift, 1)
            c[rows, i] = self._joins(best, moved[rows, np.minimum(i + 1, width)])
            some = i > 0
            c[rows[some], i[some] - 1] = self._joins(moved[rows[some], i[some] - 1], best[some])
            costs[going] = c
        return [row[:n] for row, n in zip(ids, (ids >= 0).sum(1), strict=True)]

    def _learn(self, words: set[bytes]) -> None:
        by_size: dict[int, list[bytes]] = {}
        for word in words:
            if word in self.ranks:
                self._hold(word, [self.ranks[word]])
            elif len(word) > _WIDE:
                self._hold(word, self.merge(word) if len(word) < 500 else self.merge_long(word))
            else:
                by_size.setdefault((len(word) + 3) // 4, []).append(word)
        for group in by_size.values():
            for word, ids in zip(group, self.merge_many(group), strict=True):
                self._hold(word, ids.tolist())

    def _hold(self, word: bytes, ids: list[int]) -> None:
        self.held[word] = (",".join(map(str, ids)).encode(), struct.pack(f"<{len(ids)}I", *ids))

    def merge_long(self, word: bytes) -> list[int]:
        """``merge`` with a heap over linked parts, for pre-tokens of thousands of bytes."""
        from heapq import heapify, heappop, heappush

        n, ranks = len(word), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            gone = end[i]
            alive[gone], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if word[i : end[stop]] in ranks:
                    heappush(heap, (ranks[word[i : end[stop]]], i, end[stop]))
            if before[i] >= 0 and word[before[i] : stop] in ranks:
                heappush(heap, (ranks[word[before[i] : stop]], before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = end[i]
        return out

    def slices(self, texts: list[str]) -> Iterator[list[bytes]]:
        """The pre-tokens of each text."""
        raw = "\0".join(texts) + "\0"
        points = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), "<u4")
        classes = self.classes[points]
        sizes = np.array([len(t) + 1 for t in texts])
        edges = np.cumsum(sizes) - 1
        classes[edges] = EDGE
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        place = np.concatenate([[0], np.cumsum(width)])
        begins = np.flatnonzero(starts(classes))
        at = place[begins]
        data, cuts = raw.encode("utf-8", "surrogatepass"), at.tolist()
        last, first = np.searchsorted(begins, edges).tolist(), 0
        for stop in last:
            yield [data[a:b] for a, b in zip(cuts[first:stop], cuts[first + 1 : stop + 1], strict=True)]
            first = stop + 1

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, np.ndarray]]:
        """Of each text its ids, as decimals joined by commas and as numbers. Null counts as empty."""
        if len(self.held) > WORDS_HELD:
            self.held.clear()
        cut = list(self.slices([t or "" for t in texts]))
        new = set().union(*cut) - self.held.keys()
        if new:
            self._learn(new)
        for words in cut:
            said, packed = zip(*map(self.held.__getitem__, words), strict=True) if words else ((), ())
            yield b",".join(said), np.frombuffer(b"".join(packed), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, gathered from the vocabulary laid end to end at its offsets."""
        sizes = self.lengths[ids]
        shift = np.repeat(self.offsets[ids] - (np.cumsum(sizes) - sizes), sizes)
        return self.letters[shift + np.arange(len(shift))].tobytes()


def encode(documents: DataFrame, make_codec: Callable[[], Codec]) -> DataFrame:
    """doc_id and ids of every row; null and empty texts have no ids."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make_codec()
        for batch in batches:
            ids = [x.astype(np.int32) for _, x in codec.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, make_codec: Callable[[], Codec]) -> DataFrame:
    """doc_id and text (bytes) of rows of ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make_codec()
        for batch in batches:
            texts = [codec.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def round_trip(documents: DataFrame, make_codec: Callable[[], Codec]) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the comma-joined ids and of the bytes decoded from them."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make_codec()
        for batch in batches:
            counts, said, back = [], [], []
            for joined, ids in codec.encode(batch.column(1).to_pylist()):
                counts.append(len(ids))
                said.append(hashlib.sha256(joined).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(said, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
