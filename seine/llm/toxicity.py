"""Toxicity by classifier chains: one linear model per category, in order.

Each model is a logistic regression over the presence of indicative words and over the
probabilities of the categories before it. Beside whole words, their beginnings count, so
that an inflected or compound form is known by its stem. In training those probabilities are
out-of-fold predictions, so that a later model sees earlier ones as unsure as they will
be on new texts. Words are chosen by their chi-squared statistic against any category,
from a threshold that predicts best out of fold; their number has no bound but the sample's.

The categories are the binary columns of a label table, in the order given. Training
takes a bounded sample of labelled rows; scoring reads every whole text where it lies.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import keep_rows, marked, small_batches

# Combining marks do not end a word.
_MARKS = "".join(c for c in map(chr, range(0x300, 0x10000)) if unicodedata.category(c)[0] == "M")
_WORD = re.compile(rf"[^\W_](?:[^\W_]|[{re.escape(_MARKS)}])*")
_PLAIN = re.compile(r"[0-9a-z]+")
# Words that a worker counts before it hands them on.
COUNTED_WORDS = 20_000
# Han, kana, Thai, Lao, Burmese and Khmer, written without spaces.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]{2,}")


@dataclass(frozen=True)
class Settings:
    max_rows: int = 8000  # the bound of the labelled sample
    chi2: tuple[float, ...] = (25.0, 12.0)  # thresholds to choose from, the highest first
    folds: int = 4
    penalty: float = 0.05
    steps: int = 8  # of Newton
    inner: int = 20  # of conjugate gradients in each
    threshold: float = 0.5


def _whole_words(text: bytes) -> set[str]:
    """The distinct words of a text: runs of letters and digits by Unicode class, lower-cased.

    Of a run in a script without spaces, every two neighbouring characters are a word as well.
    """
    if text.isascii():
        return set(_PLAIN.findall(text.decode().lower()))
    words = set(_WORD.findall(text.decode("utf-8", "replace").lower()))
    words.update([run[i : i + 2] for w in words if not w.isascii() for run in _UNSPACED.findall(w) for i in range(len(run) - 1)])
    return words


def words_of(text: bytes) -> set[str]:
    """The distinct words of a text and their beginnings of 4 and 5 characters, marked by a star."""
    words = _whole_words(text)
    words.update([w[:n] + "*" for w in words for n in (4, 5) if len(w) > n])
    return words


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Features:
    """Rows of present words (word numbers, one after the other) and dense columns beside them."""

    row: np.ndarray  # of each present word, ascending
    word: np.ndarray
    words: int
    dense: np.ndarray  # (row, column)

    @classmethod
    def of(cls, found: list[list[int]], words: int) -> Features:
        row = np.repeat(np.arange(len(found)), [len(f) for f in found]).astype(np.int64)
        word = np.array([w for f in found for w in f], np.int64)
        return cls(row, word, words, np.ones((len(found), 1)))

    def beside(self, column: np.ndarray) -> Features:
        """With one more dense column, before the intercept."""
        return Features(self.row, self.word, self.words, np.hstack([self.dense[:, :-1], column.reshape(-1, 1), self.dense[:, -1:]]))

    def pick(self, mask: np.ndarray) -> Features:
        number, inside = np.cumsum(mask) - 1, mask[self.row]
        return Features(number[self.row[inside]], self.word[inside], self.words, self.dense[mask])

    def only(self, words: np.ndarray) -> Features:
        """Without the words outside a mask."""
        inside = words[self.word]
        return Features(self.row[inside], self.word[inside], self.words, self.dense)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, np.take(w, self.word), len(self.dense)) + self.dense @ w[self.words :]

    def back(self, u: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.word, np.take(u, self.row), self.words), self.dense.T @ u])


def fit_linear(x: Features, y: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights of words and dense columns, the intercept last, of a ridge-penalised logistic regression.

    Newton's steps are solved by conjugate gradients, so no matrix over the words is held. A
    sample of one class only, or of none, gives its clipped log-odds and no weights.
    """
    w = np.zeros(x.words + x.dense.shape[1])
    rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 1e-3
    w[-1] = np.log(rate / (1 - rate))
    ridge = np.full(len(w), settings.penalty)
    ridge[-1] = 1e-4
    for _ in range(settings.steps if len(y) and 0 < y.sum() < len(y) else 0):
        p = sigmoid(x.times(w))
        curve, slope = p * (1 - p) + 1e-6, x.back(p - y) + ridge * w
        scale = ridge + np.concatenate([np.bincount(x.word, curve[x.row], x.words), (x.dense**2).T @ curve])
        move, rest = np.zeros(len(w)), slope.copy()
        ahead = rest / scale
        size = rest @ ahead
        for _ in range(settings.inner):
            if size <= 1e-4 * (slope @ (slope / scale)) + 1e-30:
                break
            bent = x.back(curve * x.times(ahead)) + ridge * ahead
            step = size / (ahead @ bent)
            move, rest = move + step * ahead, rest - step * bent
            size, before = rest @ (rest / scale), size
            ahead = rest / scale + size / before * ahead
        w -= move * min(1.0, 4.0 / (np.abs(move).max() + 1e-9))
        if np.abs(move).max() < 1e-2:
            break
    return w


def chi2(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The greatest chi-squared statistic of each word against a category.

    ``counts`` (word, 1 + categories) are rows with the word, in all and of each category; ``totals`` those of all rows.
    """
    n, total, best = counts[:, 0].astype(float), float(totals[0]), np.zeros(len(counts))
    for j in range(1, counts.shape[1]):
        p = float(totals[j])
        spread = n * (total - n) * p * (total - p)
        some = spread > 0
        best[some] = np.maximum(best[some], (total * (counts[some, j] * total - n[some] * p) ** 2 / spread[some]))
    return best


def unseen(x: Features, y: np.ndarray, fold: np.ndarray, words: list[np.ndarray], settings: Settings) -> np.ndarray:
    """Out-of-fold probabilities: of every row by a model, and by words chosen, that have not seen its fold."""
    out = np.zeros(len(y))
    for k in range(settings.folds):
        held = fold == k
        if held.any():
            out[held] = sigmoid(x.pick(held).times(fit_linear(x.pick(~held).only(words[k]), y[~held], settings)))
    return out


def log_loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()) if len(y) else 0.0


@dataclass
class Chain:
    categories: list[str]
    words: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)
    stems: dict[int, set[str]] = field(default_factory=dict)

    def fit(self, x: Features, y: np.ndarray, fold: np.ndarray, words: list[np.ndarray], settings: Settings) -> Chain:
        for j in range(len(self.categories)):
            self.weights.append(fit_linear(x, y[:, j], settings))
            if j + 1 < len(self.categories):
                x = x.beside(unseen(x, y[:, j], fold, words, settings))
        return self

    def present(self, text: bytes) -> list[int]:
        """Numbers of the chain's words and beginnings that a text has."""
        words, known = _whole_words(text), self.words
        found = [known[w] for w in known.keys() & words]
        for n in (4, 5):
            found += [known[stem + "*"] for stem in self._stems(n) & {w[:n] for w in words if len(w) > n}]
        return sorted(found)

    def _stems(self, n: int) -> set[str]:
        if n not in self.stems:
            self.stems[n] = {w[:-1] for w in self.words if w.endswith("*") and len(w) == n + 1}
        return self.stems[n]

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """Probabilities (text, category); a null or empty text has no words."""
        out, n = np.zeros((len(texts), len(self.categories))), len(self.words)
        for i, text in enumerate(texts):
            found = self.present(text or b"")
            for j, w in enumerate(self.weights):
                out[i, j] = w[-1] + w[found].sum() + out[i, :j] @ w[n : n + j]
                out[i, j] = 1 / (1 + np.exp(-min(max(out[i, j], -40.0), 40.0)))
        return out


def train(documents: DataFrame, labels: DataFrame, categories: dict[str, Column], settings: Settings = Settings()) -> Chain:
    """Fit a chain on at most ``max_rows`` labelled documents, first in order of a hash of their id.

    ``categories`` names the categories in order, each with the 0/1 column of ``labels``
    that says it. Repeated label rows of a document count as the worst of them; a null
    label is 0. Without labels every probability is that of an empty sample, 0.001.
    """
    small_batches(documents.sparkSession)
    names = list(categories)
    rows = labels.where(F.col("doc_id").isNotNull()).select("doc_id", *[F.coalesce(c.cast("int"), F.lit(0)).alias(f"y{j}") for j, c in enumerate(categories.values())])
    ys = [f"y{j}" for j in range(len(names))]
    sample = rows.groupBy("doc_id").agg(*[F.max(y).alias(y) for y in ys]).withColumn("h", F.xxhash64("doc_id"))
    sample = sample.orderBy("h", "doc_id").limit(settings.max_rows)
    sample = cut_lineage(sample, "label_sample")
    # The mark spares the other documents' texts the exchange of the join.
    texts = documents.where("text IS NOT NULL").where(marked(sample, "doc_id")).select("doc_id", F.col("text").cast("binary").alias("text"))
    texts = cut_lineage(texts.join(sample, "doc_id").select("h", "text", F.array(*ys).alias("y")), "labelled_texts")

    parts, wide = settings.folds, len(names) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c.tolist() for c in counts.values()], pa.list_(pa.int64()))], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for h, text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = np.zeros(parts * wide, np.int64)
                one[(h % parts) * wide : (h % parts + 1) * wide] = [1, *y]
                for word in words_of(text):
                    if word in counts:
                        counts[word] += one
                    else:
                        counts[word] = one.copy()
                if len(counts) > COUNTED_WORDS:  # Spark adds up the parts of a task before the exchange
                    yield out()
        yield out()

    totals = np.zeros((parts, wide), np.int64)
    for r in texts.groupBy(F.expr(f"pmod(h, {parts})").alias("fold")).agg(F.count("*"), *[F.sum(F.col("y")[j]) for j in range(len(names))]).collect():
        totals[r[0]] = r[1:]
    total, whole = int(totals[:, 0].sum()), totals.sum(0)
    chain = Chain(names)
    chosen: list = []
    if total:
        counted = texts.mapInArrow(count, "word string, n array<long>").groupBy("word").agg(*[F.sum(F.col("n")[j]).alias(f"n{j}") for j in range(parts * wide)])
        sums = [sum((F.col(f"n{k * wide + j}") for k in range(parts)), F.lit(0)).cast("double") for j in range(wide)]
        best = [F.lit(0.0)]
        for j in range(1, wide):
            p, spread = float(whole[j]), sums[0] * (total - sums[0]) * float(whole[j]) * float(total - whole[j])
            best.append(F.when(spread > 0, total * F.pow(sums[j] * total - sums[0] * p, 2) / spread).otherwise(0.0))
        chosen = counted.where(F.greatest(*best) >= min(settings.chi2)).collect()
        chosen.sort(key=lambda r: r["word"])
        chain.words = {r["word"]: i for i, r in enumerate(chosen)}
    counts = np.array([r[1:] for r in chosen], np.int64).reshape(len(chosen), parts, wide)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chain.present(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)], ["h", "f", "y"])

    seen = texts.mapInArrow(features, "h long, f array<int>, y array<int>").collect() if total else []
    seen.sort(key=lambda r: (r["h"], r["f"]))
    x = Features.of([r["f"] for r in seen], len(chain.words))
    y = np.array([r["y"] for r in seen], float).reshape(len(seen), len(names))
    fold = np.array([r["h"] % settings.folds for r in seen], int)
    if seen:
        # A threshold is tried on words chosen without the fold they are tried on.
        without = [chi2(counts.sum(1) - counts[:, k], whole - totals[k]) for k in range(parts)]
        tried = {least: [c >= least for c in without] for least in settings.chi2}
        loss = {least: log_loss(unseen(x, y[:, -1], fold, words, settings), y[:, -1]) for least, words in tried.items()}
        least = min(loss, key=lambda t: (loss[t], -t))
        stay = chi2(counts.sum(1), whole) >= least
        number = np.cumsum(stay) - 1
        chain.words = {w: int(number[i]) for w, i in chain.words.items() if stay[i]}
        x = x.only(stay)
        x = Features(x.row, number[x.word], int(stay.sum()), x.dense)
        words = [w[stay] for w in tried[least]]
    else:
        words = [np.zeros(0, bool)] * parts
    chain.stems.clear()
    return chain.fit(x, y, fold, words, settings)


def score(documents: DataFrame, chain: Chain, threshold: float = Settings.threshold) -> DataFrame:
    """doc_id, ``p_<category>`` of each category, and ``flagged``: the last category's probability reaches the threshold."""
    small_batches(documents.sparkSession)
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.score(batch.column(1).to_pylist())
            columns = [pa.array(p[:, j], pa.float64()) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(p[:, -1] >= threshold, pa.bool_())], ["doc_id", *names, "flagged"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", flagged boolean")


def keep_clean(documents: DataFrame, chain: Chain, threshold: float = Settings.threshold) -> DataFrame:
    """The documents whose last category's probability stays below the threshold."""
    return keep_rows(documents, lambda texts: (chain.score(texts)[:, -1] < threshold).tolist())
