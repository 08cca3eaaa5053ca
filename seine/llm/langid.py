"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads windows of a text's UTF-8 bytes in both directions, gives every byte
position a probability for each language, and a document the mean over its positions.
Gates and candidate use the rational sigmoid x / (1 + |x|), which numpy evaluates much
faster than tanh. Training is backpropagation through time with Adam, in numpy, on a
bounded sample; prediction runs where the documents lie and moves nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import keep_rows, marked, small_batches

UNKNOWN = "und"
# Letters are found among these, which hold numbers such as one half as well.
_MAYBE = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Settings:
    hidden: int = 8
    window: int = 128  # bytes of a text read in one go when predicting
    docs_per_lang: int = 160  # the bound of the training sample
    max_docs: int = 10_240  # the bound over all languages; each has one document at least
    train_window: int = 64
    windows_per_doc: int = 6
    batch: int = 128
    steps: int = 260
    rate: float = 0.02
    seed: int = 7
    lanes: int = 2048  # windows stepped together when predicting; fewer from 64 languages
    steps_per_lang: int = 20  # training takes at least so many steps


def soft(x):
    return x / (1 + np.abs(x))


def has_letter(text: bytes) -> bool:
    return any(unicodedata.category(m[0])[0] == "L" for m in _MAYBE.finditer(text.decode("utf-8", "ignore")))


class Direction:
    """One reading direction: a table of input terms by byte, and the recurrent weights."""

    def __init__(self, hidden: int, rng):
        self.x = rng.normal(0, 0.5, (3 * hidden, 256)).astype("f4")
        self.u = rng.normal(0, 0.5 / np.sqrt(hidden), (3 * hidden, hidden)).astype("f4")

    def step(self, codes, h):
        """The next state, and what the backward pass needs."""
        k = len(h)
        a = np.take(self.x, codes, axis=1)
        g = self.u @ h
        gates = a[: 2 * k]
        gates += g[: 2 * k]
        gates = gates / (1 + np.abs(gates))
        gates *= 0.5
        gates += 0.5
        r, z = gates[:k], gates[k:]
        n = a[2 * k :]
        n += r * g[2 * k :]
        n = n / (1 + np.abs(n))
        return n + z * (h - n), (h, r, z, n, g[2 * k :])

    def advance(self, codes, h, a, g):
        """``step`` in place, in the work space ``a`` and ``g``, keeping nothing."""
        k = len(h)
        np.take(self.x, codes, axis=1, out=a, mode="clip")
        np.matmul(self.u, h, out=g)
        gates, free = a[: 2 * k], g[: 2 * k]
        gates += free
        np.abs(gates, out=free)
        free += 1
        gates /= free
        gates *= 0.5
        gates += 0.5
        n, inner = a[2 * k :], g[2 * k :]
        inner *= gates[:k]
        n += inner
        np.abs(n, out=inner)
        inner += 1
        n /= inner
        h -= n
        h *= gates[k:]
        h += n


class Network:
    def __init__(self, langs: list[str], settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.langs, self.settings = list(langs), settings
        self.ways = [Direction(settings.hidden, rng), Direction(settings.hidden, rng)]
        self.out = [rng.normal(0, 0.3, (len(langs), settings.hidden)).astype("f4") for _ in self.ways]
        self.bias = np.zeros((len(langs), 1), "f4")

    def parameters(self) -> list[np.ndarray]:
        return [p for way in self.ways for p in (way.x, way.u)] + self.out + [self.bias]

    def gradients(self, codes: np.ndarray, target: np.ndarray):
        """Mean loss per position of windows (time, lane), and its gradients."""
        steps, lanes = codes.shape
        k = self.settings.hidden
        states, logits = [], np.zeros((steps, len(self.langs), lanes), "f4") + self.bias
        for d, way in enumerate(self.ways):
            h, saved = np.zeros((k, lanes), "f4"), [None] * steps
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                h, kept = way.step(codes[t], h)
                saved[t] = (h, *kept)
                logits[t] += self.out[d] @ h
            states.append(saved)
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        lane = np.arange(lanes)
        loss = -np.log(p[:, target, lane] + 1e-9).mean()
        p[:, target, lane] -= 1
        p /= steps * lanes
        found = []
        for d, way in enumerate(self.ways):
            du, dout, da = np.zeros_like(way.u), np.zeros_like(self.out[d]), np.empty((steps, 3 * k, lanes), "f4")
            carry = np.zeros((k, lanes), "f4")
            for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
                h, before, r, z, n, gn = states[d][t]
                dout += p[t] @ h.T
                dh = carry + self.out[d].T @ p[t]
                dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
                dz = dh * (before - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                dr = dn * gn * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                da[t] = np.concatenate([dr, dz, dn])
                dg = np.concatenate([dr, dz, dn * r])
                du += dg @ before.T
                carry = dh * z + way.u.T @ dg
            rows = da.transpose(1, 0, 2).reshape(3 * k, -1)
            dx = np.stack([np.bincount(codes.ravel(), weights=row, minlength=256) for row in rows]).astype("f4")
            found.append((dx, du, dout))
        grads = [g for dx, du, _ in found for g in (dx, du)] + [x[2] for x in found] + [p.sum((0, 2))[:, None]]
        return loss, grads

    def fit(self, windows: np.ndarray, target: np.ndarray) -> Network:
        """Adam over random batches of windows (lane, time)."""
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        first, second = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        steps = max(s.steps, s.steps_per_lang * len(self.langs))
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(windows), s.batch)
            _, grads = self.gradients(windows[pick].T.astype(np.intp), target[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            rate = s.rate * min(1.0, 2 * (1 - (step - 1) / steps))
            for p, g, m, v in zip(self.parameters(), grads, first, second, strict=True):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def position_sums(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums over the positions of windows (lane, time) of their language probabilities."""
        steps = int(lengths.max())
        codes = np.ascontiguousarray(codes[:, :steps].T).astype(np.intp)
        lanes, ragged = codes.shape[1], bool((lengths < steps).any())
        k = self.settings.hidden
        ahead = np.empty((steps, len(self.langs), lanes), "f4")
        h, a, g = np.zeros((k, lanes), "f4"), np.empty((3 * k, lanes), "f4"), np.empty((3 * k, lanes), "f4")
        for t in range(steps):
            self.ways[0].advance(codes[t], h, a, g)
            np.matmul(self.out[0], h, out=ahead[t])
        ahead += self.bias
        total, h = np.zeros((len(self.langs), lanes)), np.zeros((k, lanes), "f4")
        for t in range(steps - 1, -1, -1):
            self.ways[1].advance(codes[t], h, a, g)
            if ragged:
                h *= lengths > t
            p = ahead[t]
            p += self.out[1] @ h
            p -= p.max(0)
            np.exp(p, out=p)
            p /= p.sum(0)
            if ragged:
                p *= lengths > t
            total += p
        return total.T

    def label(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """Language and mean probability of each text.

        Null, empty and letterless texts are ``und`` with score 0.
        """
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        width = self.settings.window
        # The work space holds a number for each lane, language and position.
        lanes = max(1, min(self.settings.lanes, self.settings.lanes * 64 // len(self.langs)))
        known = [i for i, x in enumerate(texts) if x and has_letter(x)]
        sums, doc, codes, lengths = np.zeros((len(texts), len(self.langs))), [], [], []
        held = 0

        def flush():
            nonlocal held
            if doc:
                # Windows of one length together, so that full ones need no mask.
                d, c, n = np.concatenate(doc), np.concatenate(codes), np.concatenate(lengths)
                order = np.argsort(-n, kind="stable")
                for i in range(0, len(order), lanes):
                    pick = order[i : i + lanes]
                    np.add.at(sums, d[pick], self.position_sums(c[pick], n[pick]))
            doc.clear(), codes.clear(), lengths.clear()
            held = 0

        for i in known:
            raw = np.frombuffer(texts[i], np.uint8)
            for start in range(0, len(raw), width * lanes * 4):
                part = raw[start : start + width * lanes * 4]
                rows = -(-len(part) // width)
                padded = np.zeros(rows * width, np.uint8)
                padded[: len(part)] = part
                size = np.full(rows, width)
                size[-1] = len(part) - (rows - 1) * width
                doc.append(np.full(rows, i)), codes.append(padded.reshape(rows, width)), lengths.append(size)
                held += rows
                if held >= lanes * 4:
                    flush()
        flush()
        out = [(UNKNOWN, 0.0)] * len(texts)
        for i in known:
            p = sums[i] / len(texts[i])
            out[i] = (self.langs[int(p.argmax())], float(min(1.0, p.max())))
        return out


def held_out(doc_id="doc_id"):
    """Whether a document is kept from training: its id's CRC-32 is divisible by 5. A null id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(documents: DataFrame, settings: Settings = Settings()) -> Network:
    """Fit a network on at most ``docs_per_lang`` training documents of each language.

    The sample takes the documents first in order of a hash of their id, of every language;
    above ``max_docs`` in all, each language has an equal share. Its texts alone come to the
    driver, cut to windows in the tasks. With no labelled document the network knows no language.
    """
    small_batches(documents.sparkSession)
    rows = documents.where(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
    ids = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    ranked = ids.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
    first = cut_lineage(ranked.where(F.col("n") <= settings.docs_per_lang).select("doc_id", "lang", "n"), "language_firsts")
    share = max(1, settings.max_docs // max(1, first.select("lang").distinct().count()))
    chosen = first.where(F.col("n") <= share).select("doc_id").distinct()
    width, most = settings.train_window, settings.windows_per_doc

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, pieces = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                starts = np.linspace(0, max(0, len(text) - width), most).astype(int) if len(text) > width else [0]
                for start in sorted(set(map(int, starts))):
                    langs.append(lang), pieces.append(text[start : start + width].ljust(width))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], ["lang", "piece"])

    chosen = cut_lineage(chosen, "language_sample")
    # The mark spares the other documents' texts the exchange of the join.
    sample = rows.where(marked(chosen, "doc_id")).join(chosen, "doc_id", "left_semi").select("lang", F.col("text").cast("binary").alias("text"))
    pieces = sample.mapInArrow(cut, "lang string, piece binary").toPandas().sort_values(["lang", "piece"])
    langs = sorted(pieces["lang"].unique())
    network = Network(langs, settings)
    if len(langs) > 1:
        windows = np.stack([np.frombuffer(bytes(x), np.uint8) for x in pieces["piece"]])
        network.fit(windows, np.searchsorted(langs, pieces["lang"].to_numpy(dtype=str)))
    return network


def predict(documents: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; repeated rows give repeated results."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = network.label(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(documents: DataFrame, network: Network, min_score: float = 0.3) -> DataFrame:
    """The documents with a language: those that are ``und`` or score below ``min_score`` go.

    Of more than four languages, whose mean probabilities are spread more thinly, the score
    needed is 1.2 times that of chance.
    """
    least = min(min_score, 1.2 / max(1, len(network.langs)))

    def keeps(texts):
        return [lang != UNKNOWN and score >= least for lang, score in network.label(texts)]

    return keep_rows(documents, keeps)
