"""MinHash near-dedup with fast similarity sketches.

A sketch of t bins is filled in rounds: in each of the first t rounds every shingle is
hashed to one bin, and in round t + i all of them go to bin i, so that every bin is
filled after 2t rounds whatever the size of the set; a set stops as soon as its bins are
full. A bin keeps the least (round, hash). Two sets agree in a bin with probability equal
to their Jaccard similarity, and the number of agreements is concentrated like that of
independent hashes or better. Bands of ``rows`` bins give candidates; a pair of
similarity 0.8 shares one of the 42 bands of 6 but for a chance of 3 in a million.

Sets that are equal form a class, which has a number and its least doc_id. Classes that share a
band are not paired with each other: each member of a band's group is compared with one
pivot, on the full sets, and what is linked is joined. Groups that still hold several
components are then searched whole for links between components, block against block, so
none is lost, while a group of many near copies costs about one comparison per member.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..plans.ranked import rank_all
from ..session import cut_lineage
from .common import marked, small_batches, text_bytes
from .components import components

_MULTIPLY = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # fixed values: a common 64-bit finaliser
_STRIDE = 0x9E3779B97F4A7C15  # fixed value: the golden ratio in 64 bits
_FULL = np.uint64(2**64 - 1)
_WORDS_HELD = 300_000


@dataclass(frozen=True)
class Settings:
    shingle: int = 5  # words
    percent: int = 80  # least Jaccard similarity of a link, in per cent
    bands: int = 42
    rows: int = 6
    block_shingles: int = 2_000_000  # of a group's members compared in one task

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MULTIPLY[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MULTIPLY[1])
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_HELD:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


def shingle_set(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit shingles of a text; fewer words than ``width`` make one shingle."""
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII spaces
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        out = out * np.uint64(_STRIDE) + h[j : len(h) - n + 1 + j]
    return np.unique(mix(out))


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketches (set, bin) of non-empty sets."""
    out = np.full(len(sets) * bins, _FULL, np.uint64)
    owner = np.repeat(np.arange(len(sets)) * bins, [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for i in range(2 * bins):
        if not len(values):
            break
        y = mix(values + np.uint64(((i + 1) * _STRIDE) % 2**64))
        slot = owner + ((y >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else owner + (i - bins)
        np.minimum.at(out, slot, (y & np.uint64(2**54 - 1)) | np.uint64(i << 54))
        if i > 1:  # most sets are not full before
            open_sets = (out.reshape(-1, bins) == _FULL).any(1)
            going = open_sets[owner // bins]
            if not going.all():
                values, owner = values[going], owner[going]
    return out.reshape(-1, bins)


def band_keys(rows: np.ndarray, settings: Settings) -> np.ndarray:
    """One 64-bit key per band of sketches (set, bin)."""
    key = np.tile(np.arange(settings.bands, dtype=np.uint64), (len(rows), 1))
    parts = rows.reshape(len(rows), settings.bands, settings.rows)
    for j in range(settings.rows):
        key = mix(key * np.uint64(_STRIDE) + parts[:, :, j])
    return key.view(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def sign(documents: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, text_id (a hash), n_shingles, digest of the set and band keys of every row; an empty set has neither of the last two."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, settings.shingle, hashes) for t in batch.column(1).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(sketches([sets[i] for i in full], settings.bins), settings)
            bands: list = [None] * len(sets)
            for i, row in zip(full, keys, strict=True):
                bands[i] = row
            digest = [set_digest(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_id", "n_shingles", "digest", "bands"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes()).withColumn("text_id", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_id long, n_shingles long, digest binary, bands array<long>")


def sets_of(documents: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """rep (the number) and shingles (sorted, as bytes) of ``classes`` (rep, doc_id, digest).

    A map of hashed ids leaves few other texts to shingle, and a map of digests few sets to
    exchange; the join leaves exactly those asked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, settings.shingle, hashes) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(set_digest, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "shingles"]
            )

    rows = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    sets = rows.where(marked(classes, "doc_id")).mapInArrow(run, "digest binary, shingles binary").where(marked(classes, "digest"))
    return sets.join(classes.select("digest", "rep"), "digest").dropDuplicates(["rep"]).select("rep", "shingles")


def verify(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The ``pairs`` (a, b) that the full sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= settings.percent * (len(both) - common))
            yield batch.filter(pa.array(linked, pa.bool_())).select([0, 1])

    one = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
    both = one.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def bridges_within(reps: np.ndarray, component: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between members of different components, enough to join all that any link joins.

    ``side`` tells the two blocks of a group apart: with both present, only pairs across count.
    """
    order = np.argsort(component, kind="stable")
    reps, component, side, sets = reps[order], component[order].copy(), side[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum([0, *sizes[:-1]])
    # Shingles by number, so that the overlap with a set is a look-up in its marks.
    numbers, code = np.unique(np.concatenate(sets), return_inverse=True)
    across, out = len(np.unique(side)) > 1, []
    names, counts = np.unique(component, return_counts=True)
    marks = np.zeros(len(numbers), np.int32)
    for i in np.flatnonzero(component != names[counts.argmax()]):
        other = (component != component[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        if across:
            other &= side != side[i]
        if not other.any():
            continue
        own = code[starts[i] : starts[i] + sizes[i]]
        marks[own] = 1
        common = np.add.reduceat(marks[code], starts)
        marks[own] = 0
        for j in np.flatnonzero(other & (100 * common >= percent * (sizes + sizes[i] - common))):
            if component[j] != component[i]:
                out.append((int(reps[i]), int(reps[j])))
                component[component == component[j]] = component[i]
    return out


def bridge(members: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between components within the groups of ``members`` (key, rep, component, size).

    A group is cut by a hash of the id into blocks of some ``block_shingles`` shingles, and
    every two blocks meet in a task of their own, so that no task holds more than two.
    """
    parts = F.ceil(F.col("size") / F.lit(settings.block_shingles)).cast("int")
    blocks = members.select("key", "rep", "component", parts.alias("parts")).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    # The pair of a block with itself is one group, that of two blocks another.
    blocks = blocks.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        held = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        found = bridges_within(
            group.column("rep").to_numpy(), group.column("component").to_numpy(), held, group.column("block").to_numpy(), settings.percent
        )
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return blocks.join(sets, "rep").groupBy("key", "i", "j").applyInArrow(run, "a long, b long").distinct()


@dataclass(frozen=True)
class Linked:
    """``signed``: rows of ``sign``. ``classes``: digest, rep (a number) and doc_id (the least). ``labels``: id and
    component_id of the classes that link with any, both numbers."""

    signed: DataFrame
    classes: DataFrame
    labels: DataFrame


def link(documents: DataFrame, settings: Settings = Settings()) -> Linked:
    """Find the classes of equal sets and join those that link, whatever ids their rows have."""
    signed = cut_lineage(sign(documents, settings), "signed")
    real = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = cut_lineage(rank_all(real.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), [F.col("digest")], "rep"), "classes")
    # One row per class; copies of a class beyond its least id go no further.
    reps = real.join(classes, ["digest", "doc_id"])
    keyed = reps.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y").select("key")
    active = cut_lineage(keyed.join(shared, "key", "left_semi").distinct(), "active")
    asked = cut_lineage(classes.join(active.select("rep").distinct(), "rep", "left_semi"), "active_classes")
    sets = cut_lineage(sets_of(documents, asked, settings), "sets")

    # First every member of a band's group meets one pivot, which joins most near copies.
    order = F.xxhash64("rep")
    pivot = active.groupBy("key").agg(F.min_by("rep", order).alias("p"), F.min_by("n", order).alias("m"))
    met = active.join(pivot, "key").where("rep <> p").where(F.expr(f"100 * least(n, m) >= {settings.percent} * greatest(n, m)"))
    pairs = met.select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b")).distinct()
    links = cut_lineage(verify(pairs, sets, settings), "links")
    labels = cut_lineage(components(links), "components")
    # Then the groups that still hold several components are searched for links between them.
    known = labels.select(F.col("id").alias("rep"), F.col("component_id").alias("component"))
    current = active.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    split = current.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.sum("n").alias("size")).where("x <> y")
    bridges = cut_lineage(bridge(current.join(split.select("key", "size"), "key"), sets, settings), "bridges")
    if not bridges.isEmpty():
        labels = cut_lineage(components(links.union(bridges)), "components")
    return Linked(signed, classes, labels)


def _named(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """digest, rep, doc_id and component (a number) of every class."""
    found = classes.join(labels.select(F.col("id").alias("rep"), F.col("component_id").alias("component")), "rep", "left")
    return found.withColumn("component", F.coalesce("component", "rep"))


def near_duplicates(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``documents`` (doc_id, text).

    Texts without words link with nothing. Rows that share a doc_id count as one
    document: what one of them links with, all do. A row without an id is kept and has
    no component. Repeated rows give repeated results.
    """
    linked = link(documents, settings)
    signed, classes, labels = linked.signed, linked.classes, linked.labels
    # The classes of one document's rows belong together; few documents have several.
    several = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.xxhash64("digest")).alias("x"), F.max(F.xxhash64("digest")).alias("y")
    ).where("x <> y").select("doc_id")
    theirs = signed.join(several, "doc_id").join(classes.select("digest", "rep"), "digest")
    same = cut_lineage(theirs.withColumn("b", F.min("rep").over(Window.partitionBy("doc_id"))).select(F.col("rep").alias("a"), "b").distinct(), "same_document")
    if not same.isEmpty():
        labels = cut_lineage(components(same.union(labels.select("id", "component_id"))), "components")
    named = _named(classes, labels)
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    met = named.join(least, "component").select("digest", "component_id")
    out = cut_lineage(signed.select("doc_id", "n_shingles", "digest").join(met, "digest", "left"), "components_of_rows")
    # A row without words goes with its document's other rows.
    full, empty = out.where("digest IS NOT NULL"), out.where("digest IS NULL").drop("component_id")
    theirs = full.join(empty.select("doc_id").distinct(), "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = full.unionByName(empty.join(theirs, "doc_id", "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``documents`` that stay, every column untouched: one row of each group of texts that link.

    It is a row of the least doc_id of the group. Texts are judged, not ids: of rows that
    share an id each stays if its text's group has no lesser id. Rows without words, or
    without an id, all stay.
    """
    linked = link(documents, settings)
    named = _named(linked.classes, linked.labels)
    best = named.groupBy("component").agg(F.min(F.struct("doc_id", "rep")).alias("best")).select(F.col("best.rep").alias("rep"))
    winners = named.join(best, "rep").select("digest", "doc_id")
    rows = linked.signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text_id", "digest")
    texts = rows.groupBy("doc_id", "text_id", "digest").agg(F.count("*").alias("rows"))
    stay = texts.join(winners, ["digest", "doc_id"]).groupBy("digest", "doc_id").agg(F.min(F.struct("text_id", "rows")).alias("one"))
    stay = cut_lineage(stay.select("doc_id", "one.text_id", "one.rows"), "near_kept")
    gone = texts.join(stay.select("doc_id", "text_id"), ["doc_id", "text_id"], "left_anti")
    # Repeats of a row that stays need a second look as well.
    touched = cut_lineage(gone.select("doc_id", "text_id", F.lit(0).alias("left")).union(stay.where("rows > 1").select("doc_id", "text_id", F.lit(1))), "near_copies")
    names = documents.columns
    plain = documents.toDF(*[n if n in ("doc_id", "text") else f"c{i}" for i, n in enumerate(names)])
    keyed = plain.withColumns({"own_id": F.col("doc_id").cast("long"), "own_text": F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))})
    keys = touched.select(F.col("doc_id").alias("own_id"), F.col("text_id").alias("own_text"), "left")
    maybe = marked(keys, "own_id", "own_text")
    left = keyed.where(maybe).join(keys, ["own_id", "own_text"], "left").where("left IS NULL OR left = 1")
    once, others = left.where("left = 1").dropDuplicates(["own_id", "own_text"]), left.where("left IS NULL")
    whole = [r.select(*plain.columns) for r in (keyed.where(~maybe), others, once)]
    return whole[0].union(whole[1]).union(whole[2]).toDF(*names)
