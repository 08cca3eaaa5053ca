"""Embedding near-dedup by lattice hashing.

Each of several tables projects a unit vector at random to a few groups of eight
coordinates and decodes every group to the nearest point of the E8 lattice; the points
together are the vector's cell. A vector lies in its own cell and also visits the
neighbouring cells it is nearest to. Vectors that meet in a cell are compared by cosine
in double precision, block against block inside a task, so that pairs are counted and
never written out; a pair that meets in several cells counts in one of them only.

Equal vectors of a label form a class, which has a number and its least vec_id. With the default settings
a pair of cosine 0.98 meets with probability above 0.99, a closer one more surely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranked import rank_all
from ..session import cut_lineage
from .common import small_batches
from .components import components


@dataclass(frozen=True)
class Settings:
    least_cosine: float = 0.98
    tables: int = 6
    groups: int = 2  # of eight coordinates in a table
    width: float = 1.8  # scale of the lattice against unit vectors under a standard normal projection
    probes: int = 6  # neighbouring cells visited per table
    block: int = 1500  # members of a cell compared with as many others in one task
    seed: int = 11


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    half = [np.array(s) / 2 for s in product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(whole + half)


ROOTS = _roots()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest whole vectors of even sum."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    worst = np.abs(x[odd] - r[odd]).argmax(1)
    r[odd, worst] += np.where(x[odd, worst] >= r[odd, worst], 1, -1)
    return r


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row of eight."""
    a, b = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - b) ** 2).sum(1) < ((x - a) ** 2).sum(1)
    a[closer] = b[closer]
    return a


def _hash(points: np.ndarray, table: int) -> np.ndarray:
    """One 64-bit key of each row of lattice points."""
    key = np.full(len(points), 2 * table + 1, np.uint64)
    for column in (2 * points).astype(np.int64).view(np.uint64).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)  # fixed value: the golden ratio in 64 bits
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def cells(unit: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Own cell (vector, table) and visited cells (vector, table, probe) of unit vectors."""
    n, k = len(unit), 8 * settings.groups
    own, seen = np.empty((n, settings.tables), np.int64), np.empty((n, settings.tables, settings.probes), np.int64)
    for t in range(settings.tables):
        turn = np.random.default_rng([settings.seed, t, unit.shape[1]]).normal(size=(unit.shape[1], k))
        x = unit @ turn / settings.width
        points = np.hstack([nearest_point(x[:, i : i + 8]) for i in range(0, k, 8)])
        own[:, t] = _hash(points, t)
        # Moving one group to a neighbouring point costs |root|^2 / 2 less the share of the offset along it.
        gains = np.hstack([(x[:, i : i + 8] - points[:, i : i + 8]) @ ROOTS.T for i in range(0, k, 8)])
        best = np.argpartition(-gains, settings.probes, axis=1)[:, : settings.probes]
        for p in range(settings.probes):
            group, root = np.divmod(best[:, p], len(ROOTS))
            moved = points.reshape(n, settings.groups, 8).copy()
            moved[np.arange(n), group] += ROOTS[root]
            seen[:, t, p] = _hash(moved.reshape(n, k), t)
    return own, seen


def meet(own_a, seen_a, own_b, seen_b) -> np.ndarray:
    """Whether vectors meet, per (pair, table)."""
    near = own_a == own_b
    for p in range(seen_a.shape[2]):
        near |= (seen_a[:, :, p] == own_b) | (own_a == seen_b[:, :, p])
    return near


def prepare(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, digest of the vector, and its unit form as bytes of doubles.

    Digest and unit are null for vectors that link with nothing: those without a label,
    and null, empty or zero ones or such with null or non-finite components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, units = [], []
            for label, values in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x = np.array(values, float) if values and label is not None and None not in values else np.zeros(0)
                top = np.abs(x).max() if len(x) else 0.0
                good = 0 < top < np.inf
                unit = x / top / np.linalg.norm(x / top) if good else None
                digests.append(blake2b((x + 0.0).tobytes(), digest_size=16).digest() if good else None)
                units.append(unit.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(units, pa.binary())], ["vec_id", "label", "digest", "unit"]
            )

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, label string, digest binary, unit binary")


def place(vectors: DataFrame, settings: Settings) -> DataFrame:
    """``vectors`` (rep, label, copies, unit) with own and visited cells; cells of different labels or lengths differ."""
    schema = "rep long, copies long, unit binary, own array<long>, seen array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, labels = batch.column(3).to_pylist(), batch.column(1).to_pylist()
            n = len(raw)
            own, seen = np.empty((n, settings.tables), np.int64), np.empty((n, settings.tables, settings.probes), np.int64)
            for length in {len(x) for x in raw}:
                pick = [i for i in range(n) if len(raw[i]) == length]
                own[pick], seen[pick] = cells(np.stack([np.frombuffer(raw[i]) for i in pick]), settings)
            salt = np.array([int.from_bytes(blake2b(f"{len(x)} {y}".encode(), digest_size=8).digest(), "little", signed=True) for x, y in zip(raw, labels, strict=True)], np.int64)
            own ^= salt[:, None]
            seen ^= salt[:, None, None]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(list(own), pa.list_(pa.int64())), pa.array(list(seen.reshape(n, -1)), pa.list_(pa.int64()))],
                ["rep", "copies", "unit", "own", "seen"],
            )

    return vectors.select("rep", "label", "copies", "unit").mapInArrow(run, schema)


def compare(table: pa.Table, settings: Settings) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Partners' copies of each member of a group, and links enough to join what is linked.

    The group is one block or two (``side``); of two, only pairs across count. A pair
    counts where it belongs: in the first table in which it meets, in its common cell if
    it has one, else in the cell of the member of lesser id if the other visits that, else
    in the cell of the greater.
    """
    rep, copies, cell = (table.column(c).to_numpy() for c in ("rep", "copies", "cell"))
    number, side = table.column("table")[0].as_py(), table.column("side").to_numpy()
    unit = np.stack([np.frombuffer(x) for x in table.column("unit").to_pylist()])
    own = np.array(table.column("own").to_pylist(), np.int64)
    seen = np.array(table.column("seen").to_pylist(), np.int64).reshape(len(rep), settings.tables, settings.probes)
    cell, home = cell[0], own[:, number] == cell[0]
    across, counts, links = len(np.unique(side)) > 1, np.zeros(len(rep), np.int64), []
    root = np.arange(len(rep))
    for start in range(0, len(rep), 256):
        rows = np.arange(start, min(start + 256, len(rep)))
        near = unit[rows] @ unit.T >= settings.least_cosine
        near &= (rep[rows][:, None] < rep[None, :]) & (home[rows][:, None] | home[None, :])
        if across:
            near &= side[rows][:, None] != side[None, :]
        a, b = np.nonzero(near)
        a = rows[a]
        for part in range(0, len(a), 50_000):
            i, j = a[part : part + 50_000], b[part : part + 50_000]
            tables = meet(own[i][:, : number + 1], seen[i][:, : number + 1], own[j][:, : number + 1], seen[j][:, : number + 1])
            first = tables.argmax(1) == number
            same = home[i] & home[j]
            visits = (seen[j][:, number] == own[i][:, number, None]).any(1)
            here = first & (same | (~same & np.where(home[i], visits, ~visits)))
            i, j = i[here], j[here]
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            for x, y in zip(i, j, strict=True):
                if root[x] != root[y]:
                    links.append((int(rep[x]), int(rep[y])))
                    root[root == root[y]] = root[x]
    return counts, links


def near_duplicates(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings`` (vec_id, embedding, label).

    Rows that link with nothing are components of their own. Rows that repeat a vec_id
    are vectors of their own in the counts; in components they are one. A row without a
    vec_id links with nothing and is kept.
    """
    small_batches(embeddings.sparkSession)
    rows = cut_lineage(prepare(embeddings), "vectors")
    valid = rows.where("digest IS NOT NULL AND vec_id IS NOT NULL")
    classes = valid.groupBy("label", "digest").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = cut_lineage(rank_all(classes, [F.col("label"), F.col("digest")], "rep"), "vector_classes")
    units = valid.select("label", "digest", "vec_id", "unit").join(classes, ["label", "digest", "vec_id"]).dropDuplicates(["rep"])
    placed = cut_lineage(place(units, settings), "placed")

    own = placed.select("rep", F.posexplode("own").alias("table", "cell"), F.lit(True).alias("home"))
    seen = placed.select("rep", F.posexplode("seen").alias("at", "cell")).select("rep", F.expr(f"cast(at div {settings.probes} as int)").alias("table"), "cell", F.lit(False).alias("home"))
    visits = cut_lineage(own.union(seen), "visits")
    busy = visits.groupBy("table", "cell").agg(F.count("*").alias("size"), F.max("home").alias("lived_in"))
    busy = busy.where("size > 1 AND lived_in")
    parts = F.ceil(F.col("size") / F.lit(settings.block)).cast("int")
    members = visits.join(busy.select("table", "cell", parts.alias("parts")), ["table", "cell"])
    members = members.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    members = members.select("table", "cell", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "rep")
    members = members.join(placed, "rep")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        counts, links = compare(group, settings)
        reps = group.column("rep").to_numpy()
        found = np.flatnonzero(counts)
        a = np.concatenate([reps[found], np.array([x[0] for x in links], np.int64)]).astype(np.int64)
        n = np.concatenate([counts[found], np.zeros(len(links), np.int64)])
        b = [None] * len(found) + [x[1] for x in links]
        return pa.table({"a": pa.array(a), "n": pa.array(n), "b": pa.array(b, pa.int64())})

    found = cut_lineage(members.groupBy("table", "cell", "i", "j").applyInArrow(run, "a long, n long, b long"), "links")
    # The classes of rows that share a vec_id are one in components.
    named = valid.join(classes.select("label", "digest", "rep"), ["label", "digest"]).select("vec_id", "rep")
    same = named.groupBy("vec_id").agg(F.min("rep").alias("a"), F.max("rep").alias("m")).where("a < m").select("vec_id", "a")
    same = same.join(named, "vec_id").where("a <> rep").select("a", F.col("rep").alias("b"))
    labels = components(found.where("b IS NOT NULL").select("a", "b").union(same))
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    joined = classes.join(counts, "rep", "left").join(labels.select(F.col("id").alias("rep"), F.col("component_id").alias("component")), "rep", "left")
    joined = cut_lineage(joined.withColumn("component", F.coalesce("component", "rep")), "vector_components")
    joined = joined.join(joined.groupBy("component").agg(F.min("vec_id").alias("c")), "component")
    joined = joined.select("label", "digest", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), "c")
    out = rows.select("vec_id", "label", "digest").join(joined, ["label", "digest"], "left")
    known = F.col("vec_id").isNotNull()
    component = F.when(known, F.coalesce("c", "vec_id"))
    return out.select("vec_id", F.when(known, F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
