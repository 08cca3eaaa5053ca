"""Centroid clustering, mixing and fill-in-middle against plain versions."""

import hashlib
import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from seine.llm import centroids, infill, langid, lattice, minhash, mixture, toxicity, warc

VECTORS = "vec_id long, embedding array<double>, label int"
DOCS = "doc_id long, text string, source string, rank string, chunk string, size long"


def plain_clusters(rows, k=16, rounds=3, dims=64):
    good = [(i, e) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    v = [(i, tuple(math.floor(Fraction(x) * 64) for x in e), tuple(e)) for i, e in good]
    name = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    c = [r[1] for r in sorted(v, key=lambda r: (r[0] is None, name(r[0]), r[2]))[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))
    for _ in range(rounds):
        own = [nearest(x)[1] for _, x, _ in v]
        for j in range(len(c)):
            mine = [x for (_, x, _), q in zip(v, own) if q == j]
            if mine:
                c[j] = tuple(sum(column) // len(mine) for column in zip(*mine))
    own, top = [nearest(x) for _, x, _ in v], 2**63 - 1
    inertia = {j: sum(d for d, q in own if q == j) for j in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    total = sum(d for d, _ in own)
    return sorted(repr((i, j, min(d, top), min(inertia[j], top), min(total, top), sha[j])) for (i, _, _), (d, j) in zip(v, own))


def vectors():
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([0.0, 1 / 64, -1 / 64, 0.5]) for _ in range(64)], 1) for i in range(120)]  # many ties
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 2), (5, rows[9][1], 2), (None, rows[6][1], None)]
    rows += [(300, None, 1), (301, [1.0] * 63, 1), (302, [None] + [1.0] * 63, 1), (303, [math.nan] * 64, 1), (304, [-math.inf] + [0.0] * 63, 1), (305, [], 1)]
    wide = [(400 + i, [1e300 * (i + 1)] + [0.5] * 63, 1) for i in range(3)]
    wide += [(500, [-1.7e308] * 64, 1), (501, [5e6] * 64, 1), (502, [2e6] * 64, 2), (503, [5e-324] * 64, 1), (504, [-5e-324] * 64, 1)]
    return rows, wide


@pytest.mark.parametrize("pick", ["usual", "wide", "few", "none"])
def test_centroids_against_plain_integers(spark, pick):
    rows, wide = vectors()
    rows = {"usual": rows, "wide": rows[:30] + wide, "few": rows[:3], "none": []}[pick]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = sorted(repr(tuple(r)) for r in centroids.cluster(frame).collect())
    assert got == plain_clusters([(i, e) for i, e, _ in rows])


def test_the_filter_never_drops_the_nearest():
    rnd = np.random.default_rng(4)
    for scale in (1, 60, 5000):
        x = rnd.integers(-scale, scale + 1, (400, 64))
        turn, _ = np.linalg.qr(rnd.normal(size=(64, 64)))
        found = centroids.Centroids([tuple(map(int, r)) for r in x[:16] + rnd.integers(-1, 2, (16, 64))], turn[:, :12].T)
        lead, rest = centroids._turn(x.astype(float), turn[:, :12].T)
        best, distance = found.nearest(x, lead, rest)
        full = ((x[:, None] - found.x[None]) ** 2).sum(2)
        assert (best == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_sums_in_digits():
    for value in (0, 1, -1, 2**30, -(2**30) - 5, 64 * int(1.7e308), -12345678901234567890):
        assert sum(d << (30 * at) for at, d in centroids._digits(value)) == value
    assert centroids.whole(-1e-320, 64) == -1 and centroids.whole(1.7e308, 64) == 64 * int(1.7e308)


MIXED = [
    (1, "one two three", "b", "x", "y", 1), (1, "one two three", "b", "x", "y", 1), (1, "other text", "b", "x", "y", 1), (2, None, "b", None, None, None),
    (3, "", "a", "x", "y", 1), (4, " \t\n ", "a", "x", "y", 1), (None, "no id here", "a", "x", "y", 1), (None, "no id here", None, "x", "y", 1), (5, "word " * 40_000, "c", "x", "y", 1),
    (6, "tiny", "Z", "x", "y", 1), (7, "nul is one", "", "x", "y", 1), (8, "a  b\x0bc\x1cd", "é", "x", "y", 1),
] + [(i, f"hot source document number {i} " * (i % 7), "hot", "x", "y", 1) for i in range(100, 400)]


def plain_targets(rows):
    n = lambda t: len((t or "").encode().split())
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += n(r[1])
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    weight, free, total = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set(order), 1.5 * sum(size.values())
    while True:
        left, all_weights = total - sum(2 * size[s] for s in order if s not in free), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / all_weights > 2 * size[s]}
        if not over:
            return size, {s: left * weight[s] / all_weights if s in free else 2 * size[s] for s in order}
        free -= over


@pytest.mark.parametrize("settings", [mixture.Settings(), mixture.Settings(block_words=50, shards=37, part_rows=40), mixture.Settings(block_words=1, shards=1)])
def test_mixture_meets_its_targets(spark, settings):
    rows = MIXED if settings.block_words > 1 else MIXED[:8] + MIXED[9:60]
    documents = spark.createDataFrame(rows, DOCS).repartition(3)
    mixed = mixture.mix_sources(documents, settings)
    got = [tuple(r) for r in mixture.taken(mixed).collect()]
    size, target = plain_targets(rows)
    n = lambda t: len((t or "").encode().split())
    key = lambda r: repr((r[0], r[1], r[2], round(r[3], 6)))
    assert sorted(map(key, got)) == sorted(key((r[0], n(r[1]), size[r[2]], float(target[r[2]]))) for r in rows)
    assert all(0 <= taken <= 2 * size for _, size, _, _, taken in got)
    sums, ranks = defaultdict(int), {(r["rank"], r["target"]) for r in mixed.rows.collect()}
    for r in mixed.pieces.collect():
        sums[r["rank"]] += r["n_words"]
    assert all(abs(sums[rank] - want) <= 1 for rank, want in ranks)
    assert sum(r[4] for r in got) == sum(sums.values())
    # The same rows dealt otherwise give the same mix.
    again = mixture.taken(mixture.mix_sources(spark.createDataFrame(rows[::-1], DOCS).repartition(5), settings))
    assert sorted(map(repr, map(tuple, again.collect()))) == sorted(map(repr, got))


def test_mixture_shards_and_texts(spark):
    settings = mixture.Settings(block_words=30, shards=9)
    documents = spark.createDataFrame(MIXED, DOCS)
    mixed = mixture.mix_sources(documents, settings)
    shards = [r[1] for r in mixture.shuffled(mixed, settings).groupBy("shard").sum("n_words").collect()]
    assert len(shards) == 9 and max(shards) <= 1.1 * min(shards)
    words = defaultdict(set)
    for i, t, *_ in MIXED:
        words[i].add(tuple((t or "").encode().split()))
    for r in mixture.texts(documents, mixed).collect():
        piece, first = tuple(r["text"].encode().split()), r["first_word"]
        assert any(w[first : first + len(piece)] == piece for w in words[r["doc_id"]])
    assert mixture.mix_sources(documents.limit(0), settings).pieces.count() == 0
    assert mixture.taken(mixture.mix_sources(documents.limit(0), settings)).count() == 0
    with pytest.raises(ValueError):
        mixture.Settings(share=3.0)


def test_the_tree_draws_like_a_shuffle():
    """Counts add up in every shard and source, and the mean of a cell is that of a shuffled deck."""
    quotas, shards, runs = [500, 30, 0, 270], 8, 400
    total = sum(quotas)
    mean = np.zeros((4, shards))
    for seed in range(runs):
        node, cells = mixture.Node(0, shards, total, shards, 10, seed), np.zeros((4, shards), int)
        for rank, count in enumerate(quotas):
            at = 0
            for low, high, start, n in node.split(rank, 0, count):
                assert high == low + 1 and start == at
                cells[rank, low], at = n, at + n
            assert at == count
        assert cells.sum(0).tolist() == [100] * shards
        mean += cells
    mean /= runs
    assert np.abs(mean - np.array(quotas)[:, None] / shards).max() < 1.5


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    once = mixture.permuted(np.arange(n), n, 5)
    assert sorted(once.tolist()) == list(range(n)) and (n < 64 or (once != np.arange(n)).any())


def plain_infill(doc_id, text, percent=100):
    text = text or ""
    units, sha = re.findall(r"[^\n]*\n|[^\n]+", text), lambda x: hashlib.sha256(x.encode()).hexdigest()
    digits = sha(f"7:{'' if doc_id is None else doc_id}")
    h, n = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)], len(units)
    if not text or h[2] % 100 >= percent or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


LINES = [
    (1, "one\ntwo\nthree", "a"), (1, "one\ntwo\nthree", "a"), (1, "else\n", "a"), (2, None, "a"), (3, "", "a"), (4, "\n\n\n", "a"), (None, "no id\nat all", "a"), (None, "no id\nat all", "b"),
    (5, "has <M> in it\n", "a"), (6, "ends in <\nS>P>\n<", "a"), (7, "äöü\r\nfünf x\n漢字", "a"), (8, "x" * 300_000, "a"), (9, "line of words\n" * 30_000, "a"), (10, "one line", "a"),
] + [(i, "\n".join(f"{i} {j}" for j in range(i % 9)), "a") for i in range(20, 80)]


@pytest.mark.parametrize("piece_bytes,percent", [(1 << 16, 100), (7, 60)])
def test_infill_against_plain_strings(spark, piece_bytes, percent):
    rows = [r for r in LINES if piece_bytes > 100 or len(r[1] or "") < 10_000]
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DOCS).repartition(4)
    settings = infill.Settings(piece_bytes=piece_bytes, percent=percent)
    got = sorted(repr(tuple(r)) for r in infill.digests(frame, settings).collect())
    assert got == sorted(repr(plain_infill(i, t, percent)) for i, t, _ in rows)
    texts = infill.transform(frame, settings).collect()
    assert sorted(infill.restore(r["text"].encode(), r["form"]) for r in texts) == sorted((t or "").encode() for _, t, _ in rows)
    assert infill.digests(frame.limit(0)).count() == 0 and infill.transform(frame.limit(0)).count() == 0


def test_infill_exchanges_once(spark):
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in LINES[:3]], DOCS)
    plan = infill.digests(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_pieces_hold_whole_units():
    text = b"aa\nbbbb\ncc\n" + b"d" * 25 + b"\ne"
    cut = infill.Plan("plain", np.array([3, 8, 11, 37, 38]), 0, 0)
    assert list(infill.output(text, cut, 10)) == [b"aa\nbbbb\n", b"cc\n", b"d" * 10, b"d" * 10, b"d" * 5 + b"\ne"]


def test_rows_that_share_a_vector_id(spark):
    """(1,A) (1,B) (2,A'): A' links with A alone; all are one component by the shared id."""
    a, b = [1.0] + [0.0] * 15, [0.0] * 15 + [1.0]
    near = [1.0, 0.05] + [0.0] * 14
    rows = [(1, a, 3), (1, b, 3), (2, near, 3), (3, b, 4), (None, a, 3), (4, [0.0] * 16, 3), (4, b, 3), (5, None, 3)]
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == {
        (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (None, 0, None, True), (4, 0, 4, True), (4, 1, 1, False), (5, 0, 5, True),
    }
    assert lattice.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_near_copies_of_repeated_ids(spark):
    """No text is lost with a row of its id: (5,T1) stays when (5,T2) goes."""
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(4, two, "x"), (5, two, "y"), (5, one, "z"), (6, one, "w"), (6, one, "w"), (7, one + " c", "v"), (None, one, "n"), (8, "", "e"), (8, None, "e"), (5, "", "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, left string")
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(frame).collect()} == {(4, 4), (5, 4), (6, 4), (7, 4), (None, None), (8, 8)}
    kept = minhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r[0] or 0, r[1] or "", r[2]) for r in kept.collect()) == sorted([(4, two, "x"), (5, one, "z"), (0, one, "n"), (8, "", "e"), (8, "", "e"), (5, "", "q")])


def test_letters_are_letters():
    assert [langid.has_letter(t.encode()) for t in ("½ ² Ⅷ 12 _", "é", "漢", "", "١٢", "ª")] == [False, True, True, False, False, True]


def test_record_identifiers():
    ids = {warc.record_id(p, d) for p, d in [(1, b"a"), (1, b"b"), (None, b"a"), (None, b"b"), (2, b"a")]}
    assert len(ids) == 5 and warc.record_id(1, b"a") == warc.record_id(1, b"a")


def dense_logistic(x, y, penalty, steps=60):
    """Ridge logistic regression by plain Newton on a dense matrix, the intercept last and all but free."""
    x, ridge = np.hstack([x, np.ones((len(x), 1))]), np.array([penalty] * x.shape[1] + [1e-4])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w), -1, 1)
    return w


def test_chain_against_a_plain_one():
    """Out-of-fold inputs, weights and probabilities of the chain equal those of dense matrices."""
    rnd = np.random.default_rng(2)
    x = (rnd.random((160, 12)) < 0.3).astype(float)
    y = np.stack([(x[:, 0] + x[:, 1] > rnd.random(160)), (x[:, 2] + 0.5 * x[:, 0] > rnd.random(160))], 1).astype(float)
    fold, settings = np.arange(160) % 4, toxicity.Settings(penalty=1.0, steps=60)
    words = [rnd.random(12) < 0.9 for _ in range(4)]
    chain = toxicity.Chain(["a", "b"], {f"w{i}": i for i in range(12)})
    chain.fit(toxicity.Features.of([np.flatnonzero(r).tolist() for r in x], 12), y, fold, words, settings)
    first, held = dense_logistic(x, y[:, 0], 1.0), np.zeros(160)
    for k in range(4):
        w = dense_logistic((x * words[k])[fold != k], y[fold != k, 0], 1.0)
        held[fold == k] = 1 / (1 + np.exp(-(x * words[k])[fold == k] @ w[:-1] - w[-1]))
    second = dense_logistic(np.hstack([x, held[:, None]]), y[:, 1], 1.0)
    assert np.abs(chain.weights[0] - first).max() < 0.05 and np.abs(chain.weights[1] - second).max() < 0.05
    texts = [" ".join(f"w{i}" for i in np.flatnonzero(r)).encode() for r in x] + [None, b""]
    p = chain.score(texts)
    p0 = 1 / (1 + np.exp(-x @ first[:-1] - first[-1]))
    p1 = 1 / (1 + np.exp(-np.hstack([x, p0[:, None]]) @ second[:-1] - second[-1]))
    assert np.abs(p[:160] - np.stack([p0, p1], 1)).max() < 0.02 and (p[160] == p[161]).all()


def test_chi2_against_a_plain_table():
    counts, totals = np.array([[10, 8], [50, 20], [0, 0], [100, 40]]), np.array([100, 40])
    plain = lambda n, both: sum((o - e) ** 2 / e for o, e in zip((both, n - both, 40 - both, 60 - n + both), (n * 0.4, n * 0.6, (100 - n) * 0.4, (100 - n) * 0.6)))
    assert toxicity.chi2(counts, totals) == pytest.approx([plain(10, 8), plain(50, 20), 0, 0])
