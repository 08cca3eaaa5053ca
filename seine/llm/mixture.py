"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents, in the order of a hash, laid end to end are one stream of words,
which is cut into blocks. A source's target in words becomes an exact quota of blocks: whole
passes over the source, then blocks in the order of a keyed permutation, the last one in
part. The quotas are dealt to output shards by a tree: a node over a range of shards halves
it, and of each source the left half gets a number of blocks drawn from the multivariate
hypergeometric distribution, as if all blocks of the mix had been shuffled and cut. The
counts of each source add up exactly, so every shard takes a run of the permuted sequence
that no other takes. Within a shard, pieces of documents are sorted by a hash.

Every number drawn comes from a hash of the seed and what is drawn, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import Ordered, null_safe
from ..plans.ranked import rank_all
from ..session import cut_lineage
from .common import slices, text_bytes
from .minhash import mix

_SLOTS = 50_000


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (5, 2, 1)  # of the sources by name, repeating, the null source last
    share: float = 1.5  # words of the mix for each word there is
    most: float = 2.0  # times a source may be repeated
    block_words: int = 4096
    shards: int = 64
    levels: int = 4  # of the tree walked by one task
    part_rows: int = 1_000_000  # rows of a part when the streams are laid out
    seed: int = 12

    def __post_init__(self) -> None:
        if not 0 <= self.share <= self.most or not self.weights or min(self.weights) <= 0:
            raise ValueError("weights must be positive and the share at most the greatest repetition")


def sizes(documents: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, source, size in words, a hash of the text and the place in the order, of every row; null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # The white space of bytes.split is 0x20 and 0x09 to 0x0D.
            counts = [len(t.split()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), batch.column(3)], ["doc_id", "source", "size", "text_id"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text_bytes())
    rows = rows.withColumn("text_id", F.xxhash64("text")).mapInArrow(run, "doc_id long, source string, size long, text_id long")
    return rows.withColumn("h", F.xxhash64(F.lit(settings.seed), "doc_id", "text_id"))


def targets(sized: DataFrame, settings: Settings) -> DataFrame:
    """source, rank, source_size and target of every source.

    A target is its source's share by weight, at most ``most`` times its size; what is over
    is shared by weight among the others until none is above. Each round of sharing is one
    aggregate over the sources, of which the driver sees two sums.
    """
    sums = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source_sizes")
    ranked = rank_all(sums, [F.col("source").asc_nulls_last()])
    rank = (F.col("rank") - 1).cast("long")
    weight = F.get(F.array(*[F.lit(float(w)) for w in settings.weights]), F.pmod(rank, F.lit(len(settings.weights))).cast("int"))
    sources = cut_lineage(ranked.select("source", rank.alias("rank"), "source_size", weight.alias("w"), (F.col("source_size") * settings.most).alias("top")), "source_weights")
    total, level, full = (sources.agg(F.sum("source_size")).first()[0] or 0) * settings.share, 0.0, -1
    while True:
        above = F.col("w") * level > F.col("top") if full >= 0 else F.lit(False)
        held, free, count = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("top"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0.0)), F.count_if(above)
        ).first()
        if count == full:
            break
        level, full = (total - held) / free if free else float("inf"), count
    return sources.select("source", "rank", "source_size", F.least(F.col("w") * level, F.col("top")).alias("target"))


def quota(size: int, words: int, block_words: int) -> tuple[int, int, int, int, int, int]:
    """How ``words`` are taken of a stream of ``size``: passes, blocks of a pass, whole blocks, the rest's words, blocks of it, and its last words.

    A pass takes every block. The rest takes whole blocks and then some words of one more,
    which is the stream's shorter tail only when all whole ones are taken.
    """
    whole, tail = divmod(size, block_words)
    passes, rest = divmod(words, size) if size else (0, 0)
    more = min(rest // block_words, whole)
    return passes, whole + (tail > 0), whole, rest, more, rest - more * block_words


def blocks_of(size: str, words: str, block_words: int) -> str:
    """The number of blocks drawn, repetitions counted, as SQL over columns."""
    whole, rest = f"({size} div {block_words})", f"if({size} > 0, {words} % {size}, 0)"
    more = f"least({rest} div {block_words}, {whole})"
    return (
        f"if({size} > 0, {words} div {size}, 0) * ({whole} + if({size} % {block_words} > 0, 1, 0)) "
        f"+ {more} + if({rest} > {more} * {block_words}, 1, 0)"
    )


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 to n - 1 at ``index``: four Feistel rounds, walked until they fall below n."""
    if n < 2:
        return index.copy()
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in range(4):
            salt = np.uint64((key * 4 + turn) * 0x9E3779B97F4A7C15 % 2**64)  # fixed value: the golden ratio in 64 bits
            left, right = right, left ^ (mix(right + salt) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


class Node:
    """A node of the splitting tree over shards ``low`` to ``high``: it halves what comes, source by source."""

    def __init__(self, low: int, high: int, total: int, shards: int, levels: int, seed: int):
        self.low, self.high, self.seed = low, high, seed
        self.left = self.right = None
        if levels and high - low > 1:
            middle, edge = (low + high) // 2, lambda j: j * total // shards
            # Blocks still to come, and how many of them the left half has yet to get.
            self.coming, self.wanted = edge(high) - edge(low), edge(middle) - edge(low)
            self.left = Node(low, middle, total, shards, levels - 1, seed)
            self.right = Node(middle, high, total, shards, levels - 1, seed)

    def split(self, rank: int, start: int, count: int) -> Iterator[tuple[int, int, int, int]]:
        """(low, high, start, count) of a source's run of blocks below this node; sources must come one by one."""
        if not count:
            return
        if self.left is None:
            yield self.low, self.high, start, count
            return
        draw = np.random.default_rng([self.seed, self.low, self.high, rank])
        taken = int(draw.hypergeometric(count, self.coming - count, self.wanted))
        self.coming, self.wanted = self.coming - count, self.wanted - taken
        yield from self.left.split(rank, start, taken)
        yield from self.right.split(rank, start + taken, count - taken)


def deal(quotas: DataFrame, total: int, settings: Settings) -> DataFrame:
    """Every shard's run of each source's blocks: rank, source_size, words, low (the shard), start and count.

    A stage takes the nodes of some levels, each streaming its sources in order through the
    subtree below it; a task holds a subtree's counters and no list of sources. ``quotas``:
    (rank, source_size, words, count).
    """
    if total >= 10**9:
        raise ValueError("more blocks than can be drawn exactly; raise block_words")
    columns = ["rank", "source_size", "words", "low", "high", "start", "count"]
    schema = ", ".join(f"{c} long" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if node is None or (node.low, node.high) != (row["low"], row["high"]):
                    node = Node(row["low"], row["high"], total, settings.shards, settings.levels, settings.seed)
                for low, high, start, count in node.split(row["rank"], row["start"], row["count"]):
                    out.append({**row, "low": low, "high": high, "start": start, "count": count})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(c, pa.int64()) for c in columns]))

    rows = quotas.select("rank", "source_size", "words", F.lit(0).cast("long").alias("low"), F.lit(settings.shards).cast("long").alias("high"), F.lit(0).cast("long").alias("start"), "count")
    for _ in range(-(-max(settings.shards - 1, 1).bit_length() // settings.levels)):
        rows = rows.repartition("low").sortWithinPartitions("low", "rank").mapInArrow(run, schema)
    return rows


def drawn_blocks(runs: DataFrame, settings: Settings) -> DataFrame:
    """The blocks of every run: rank, block, shard, pass number, and the words taken of the block's beginning."""
    names = ["rank", "block", "shard", "pass", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size, b = row["source_size"], settings.block_words
                passes, per_pass, whole, _, more, last = quota(size, row["words"], b)
                for at in range(row["start"], row["start"] + row["count"], _SLOTS):
                    slots = np.arange(at, min(at + _SLOTS, row["start"] + row["count"]))
                    number, place = np.divmod(slots, per_pass)
                    block, words = np.empty(len(slots), np.int64), np.empty(len(slots), np.int64)
                    for k in np.unique(number).tolist():
                        pick, key = number == k, (settings.seed << 40) ^ (row["rank"] << 4) ^ k
                        if k < passes:
                            block[pick] = permuted(place[pick], per_pass, key)
                            words[pick] = np.where(block[pick] < whole, b, size - whole * b)
                        else:
                            inside = np.minimum(place[pick], max(whole - 1, 0))
                            block[pick] = np.where(place[pick] < whole, permuted(inside, whole, key), whole)
                            words[pick] = np.where(place[pick] < more, b, last)
                    n = len(slots)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, row["rank"])), pa.array(block), pa.array(np.full(n, row["low"])), pa.array(number), pa.array(words)], names
                    )

    return runs.mapInArrow(run, ", ".join(f"{c} long" for c in names))


@dataclass(frozen=True)
class Mix:
    """``rows``: every row's doc_id, text_id, size, source_size, target, rank and ``until``, where it ends in its source's stream.

    ``pieces``: what the shards take: shard, pass, rank, until, doc_id, text_id, the first
    word of the document's and the number of words. Rows of ``rows`` without words have none.
    """

    rows: DataFrame
    pieces: DataFrame


def mix_sources(documents: DataFrame, settings: Settings = Settings()) -> Mix:
    """Take words of ``documents`` (doc_id, text, source) up to each source's target.

    Rows that share a doc_id, or have none, or repeat, are documents of their own. A piece
    is part of a document where a block's border or the target's end cuts it.
    """
    spark = documents.sparkSession
    sized = cut_lineage(sizes(documents, settings), "document_sizes")
    sources = cut_lineage(targets(sized, settings), "source_targets")
    words = F.least(F.round("target").cast("long"), F.floor(F.col("source_size") * settings.most))
    count = F.expr(blocks_of("source_size", "words", settings.block_words)).cast("long")
    quotas = cut_lineage(sources.withColumn("words", words).withColumn("count", count), "quotas")
    drawn = drawn_blocks(deal(quotas, quotas.agg(F.sum("count")).first()[0] or 0, settings), settings)
    drawn = cut_lineage(drawn, "drawn_blocks")

    placed = null_safe(sized, sources, ["source"], "inner")
    n = placed.count()
    parts = max(-(-n // settings.part_rows), min(n, spark.sparkContext.defaultParallelism), 1)
    laid = Ordered(placed, ["rank"], ["h", "doc_id", "text_id", "size"], parts=parts).add(running_sum={"until": "size"}).rows()
    laid = cut_lineage(laid.select("doc_id", "text_id", "size", "source_size", "target", "rank", "until"), "streams")

    b = F.lit(settings.block_words).cast("long")
    begin = F.col("until") - F.col("size")
    spans = laid.where("size > 0").select("rank", "until", "doc_id", "text_id", begin.alias("begin"), F.explode(F.sequence(F.floor(begin / b), F.floor((F.col("until") - 1) / b))).alias("block"))
    met = spans.join(drawn, ["rank", "block"])
    low, high = F.greatest("begin", F.col("block") * b), F.least("until", F.col("block") * b + F.col("words"))
    pieces = met.where(low < high).select("shard", "pass", "rank", "until", "doc_id", "text_id", (low - F.col("begin")).alias("first_word"), (high - low).alias("n_words"))
    return Mix(laid, pieces)


def shuffled(mixed: Mix, settings: Settings = Settings()) -> DataFrame:
    """The pieces by shard, in each shard in the order of a hash: what a shard's files should hold."""
    key = F.xxhash64(F.lit(settings.seed), "rank", "until", "first_word", "pass")
    return mixed.pieces.withColumn("key", key).repartition("shard").sortWithinPartitions("shard", "key", "rank", "until", "first_word", "pass")


def texts(documents: DataFrame, mixed: Mix) -> DataFrame:
    """shard, doc_id, first_word, pass and ``text`` of every piece: its words and what stands between them.

    Of rows equal in doc_id and text any one serves, as their pieces are of the same words.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()).withColumn("text_id", F.xxhash64("text"))
    rows = rows.dropDuplicates(["doc_id", "text_id"])
    found = null_safe(mixed.pieces, rows, ["doc_id", "text_id"], "inner").select("shard", "doc_id", "first_word", "n_words", "pass", "text")
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, first, n in zip(batch.column(5).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                rest = text.split(None, first)[first] if first else text.lstrip()
                after = rest.split(None, n)
                out.append(rest[: len(rest) - len(after[n])].rstrip() if len(after) > n else rest.rstrip())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(4), pa.array(out, pa.binary())], ["shard", "doc_id", "first_word", "pass", "text"])

    return found.mapInArrow(cut, "shard long, doc_id long, first_word long, pass long, text binary").withColumn("text", F.col("text").cast("string"))


def taken(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repetitions counted) of every row."""
    sums = mixed.pieces.groupBy("rank", "until").agg(F.sum("n_words").alias("taken"))
    # Only rows with words have a stretch of their own in the stream.
    full = mixed.rows.where("size > 0").join(sums, ["rank", "until"], "left")
    empty = mixed.rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    rows = full.unionByName(empty)
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
