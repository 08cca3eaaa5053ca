"""The operators on texts against plain versions, with nulls, empty and very long texts, copies and empty tables."""

import glob
import hashlib
import itertools
import random
import re
import tempfile
import time
import zlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seine import session
from seine.llm import bpe, catalog, chat, components, exact, langid, lattice, lines, minhash, packing, toxicity, warc

DOCS = "doc_id long, text string, lang string, score string"
LONG = " ".join(f"w{i}" for i in range(30_000))
CASES = [
    (1, "One two three four five six seven eight nine ten", "en", "a"), (2, "one TWO three four five six seven eight nine ten", "en", "b"),
    (3, None, "en", "c"), (4, "", None, "d"), (5, "", "en", "e"), (6, "12 34 !!", "en", "f"), (7, LONG, "en", "g"), (8, LONG + " tail", "en", "h"),
    (9, "word", "de", "i"), (9, "word", "de", "i"), (None, "no id", "en", "j"), (10, "Ärger über Öl", "de", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(CASES, DOCS).repartition(3).cache()


def linked(sets):
    """Components of sets of Jaccard similarity 0.8 or more, by brute force; the least key names one."""
    root = {k: k for k in sets}
    find = lambda k: k if root[k] == k else find(root[k])
    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash_against_all_pairs(spark, docs):
    rng = random.Random(3)
    base = [f"v{i}" for i in range(60)]
    copies = [(i, " ".join(w if rng.random() > 0.06 else f"x{rng.random()}" for w in base)) for i in range(100, 160)]
    rows = [(i, t) for i, t, *_ in CASES if i not in (None, 9)] + copies + [(500, copies[0][1]), (501, "v1"), (502, "V1")]
    want = linked({i: shingles(t, 2) for i, t in rows})
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), minhash.Settings(shingle=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(shingles(t, 2)), want[i], want[i] == i) for i, t in rows}
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 9, None, 10}


def test_bridges_join_what_any_link_joins():
    base = np.arange(100, dtype=np.uint64)
    sets = [base, np.unique(np.concatenate([base[15:], base[:9] + 500])).astype(np.uint64), np.unique(np.concatenate([base[15:], base[:1] + 500])).astype(np.uint64)]
    ids = np.array([1, 2, 3])
    found = minhash.bridges_within(ids, ids.copy(), sets, np.zeros(3, int), 80)
    assert {frozenset(x) for x in found} == {frozenset((1, 3)), frozenset((2, 3))}


def test_sketches_fill_every_bin():
    sets = [np.array([5], np.uint64), np.arange(1, 400, dtype=np.uint64), np.arange(1, 360, dtype=np.uint64)]
    rows = minhash.sketches(sets, 252)
    assert (rows != 2**64 - 1).all() and abs((rows[1] == rows[2]).mean() - 359 / 399) < 0.08


def test_exact_index(spark, docs):
    rows = exact.digests(docs).cache()
    index = exact.DigestIndex(spark, "test_index", str(spark.conf.get("spark.checkpoint.dir")) + "/test_index", 4)
    index.add(rows)
    index.add(rows)
    got = {(r.doc_id, r.keep_id, r.n_rows, r.kept) for r in index.resolve(rows).collect()}
    assert {(1, 2, 2, False), (2, 2, 2, True), (3, 5, 3, False), (5, 5, 3, True), (9, 9, 2, True), (None, None, 1, True)} <= got
    assert index.entries().count() == rows.select("digest").distinct().count()
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted((i or 0, t) for i, t in [(c[0], c[1]) for c in CASES[1:2] + CASES[4:9] + CASES[10:]])


@pytest.mark.parametrize("frequent", [3, 1000])
def test_line_dedup_against_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(lines, "PART_BITS", frequent)
    monkeypatch.setattr(lines, "BEFORE", frequent)
    rng = random.Random(5)
    words = [f"t{i}" for i in range(40)]
    base = [" ".join(rng.sample(words, rng.randint(1, 20))) for _ in range(25)] + [" ".join(f"z{i}" for i in range(300))]
    alter = lambda s: " ".join(w for w in s.split() if rng.random() > 0.08)
    rows = [(i, "\n".join(alter(rng.choice(base)) if rng.random() < 0.6 else rng.choice(base) for _ in range(6)) + "\n\n") for i in range(30)]
    rows += [(90, None), (91, ""), (92, "A b\tc"), (93, "c B a")]
    seen, want = [], {}
    for i, text in rows:
        gone = []
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            s = frozenset(re.findall(r"[^ \t\r\f\x0b]+", line.lower()))
            if s and any(100 * len(s & t) >= 80 * len(s | t) for t in seen):
                gone.append(k)
            seen.append(s)
        want[i] = (0 if text is None else text.count("\n") + 1, gone)
    got = lines.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_lines, r.removed) for r in got} == want
    assert all(r.n_kept == r.n_lines - len(r.removed) for r in got)


@pytest.mark.parametrize("frequent", [1, 1000])
def test_line_dedup_of_rows_without_an_id(spark, monkeypatch, frequent):
    """Near copies of a line that first stands in one of several rows with a null doc_id go too."""
    monkeypatch.setattr(lines, "PART_BITS", frequent)
    monkeypatch.setattr(lines, "BEFORE", frequent)
    base, other = [f"a{i}" for i in range(10)], [f"b{i}" for i in range(10)]
    texts = [(None, " ".join(base) + "\nonly here"), (None, " ".join(other) + "\nmore text"), (1, " ".join(base[:9])), (2, "x y z\n" + " ".join(other[1:]))]
    got = lines.clean(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_lines, r.n_kept, r.removed) for r in got} == {None: (4, 4, []), 1: (1, 0, [0]), 2: (2, 1, [1])}


def test_line_rows_are_exchanged_once_for_both_joins(spark, monkeypatch):
    """Rows of prefix tokens and words to verify are most of the disk: each is written to one exchange."""
    plans = {}
    cut = lines._cut

    def noted(df, label):
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return cut(df, label)

    monkeypatch.setattr(lines, "_cut", noted)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    texts = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "l m n o p\nq r s t u")]
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = {r.doc_id: r.removed for r in lines.clean(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == {1: [], 2: [0], 3: []}
    assert len(re.findall(r"\+- Exchange hashpartitioning\(token", plans["line_pairs"])) == 2
    assert spark.conf.get(session.CLEANUP_KEY) == "false"
    assert "line_tokens" not in plans and "ReusedExchange" in plans["line_matches"]


def test_shuffle_files_of_a_tidy_cut_go_at_its_end(spark):
    found = lambda: set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))
    before = found()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert lines._cut(rows, "tidy").count() == 7
    until = time.monotonic() + 10
    while len(found() - before) > 1 and time.monotonic() < until:
        time.sleep(0.1)
    # One is the counting's own, which is not written.
    assert len(found() - before) <= 1


def test_words_are_ranked_by_their_own_frequency(spark):
    """Rows of unlike lines do not meet: every rare word comes before the frequent ones, and one that occurs once is in no row."""
    rows = [(i, " ".join(f"w{i * 40 + k}" for k in range(40)) + " the of and\tto in\r") for i in range(300)]
    table = spark.createDataFrame([*rows, (300, "w0 w0 w1\n\nw1 other")], "doc_id long, text string")
    ranks = lines._counters(table).collect()[0].ranks
    assert len(ranks) == lines.COUNTERS
    place = lambda w: spark.range(1).select(F.expr(f"xxhash64('{w}') & {lines.COUNTERS - 1}").alias("p")).collect()[0].p
    assert [ranks[place(w)] for w in ("the", "and", "to", "in")] == [8] * 4 and [ranks[place(w)] for w in ("w0", "w1")] == [1, 1]
    single = [ranks[place(f"w{i}")] for i in range(100, 140)]
    assert single.count(0) >= 35 and max(single) <= 1


def test_lines_to_verify_are_found_by_their_own_text(spark):
    """Rows that share a place, by a repeated or missing id, are told apart; blanks of every kind divide words."""
    base = [f"a{i}" for i in range(20)]
    near = " ".join(["other", *base[1:]])
    texts = [(1, "x " * 9), (1, " ".join(base)), (1, "y z " * 9), (None, "no id"), (None, "b c d e f g h i j k"), (2, near.replace(" ", "\t")), (3, "b\x0bc\rd e f  g h i j\f")]
    got = {r.doc_id: r.removed for r in lines.clean(spark.createDataFrame([*texts, texts[1]], "doc_id long, text string")).collect()}
    assert got == {1: [], None: [], 2: [0], 3: [0]}


def test_texts_without_their_removed_lines(spark):
    """Each row's own text is rebuilt, also of rows that share an id or have none, with every column kept."""
    line = "one two three four five"
    rows = [(1, f"{line}\n\nown", "p"), (2, f"x\n{line.upper()}\ny\n", "q"), (3, line, None), (4, f"{line}\nrest", "r"), (4, f"other\n{line}", "s"), (4, f"other\n{line}", "t")]
    rows += [(5, None, "u"), (6, "", "v"), (None, f"{line} six\nno id", "w"), (None, "second", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = lines.without_lines(table)
    assert got.columns == table.columns
    want = [(1, "\nown", "p"), (2, "x\ny\n", "q"), (3, "", None), (4, "rest", "r"), (4, "other", "s"), (4, "other", "t"), (5, None, "u"), (6, "", "v"), (None, f"{line} six\nno id", "w"), (None, "second", "x")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    names = ["doc_id", "text", "_gone"]
    clash = table.toDF(*names).withColumns({c: F.lit(i) for i, c in enumerate(["gone", "parts", "stay", "own_id", "lost_text", "c0", "_d", "first"])})
    assert sorted(map(repr, map(tuple, lines.without_lines(clash).select(*names).collect()))) == sorted(map(repr, want))
    assert lines.without_lines(clash).columns == clash.columns and lines.clean(table.limit(0)).count() == 0
    counts = {r.doc_id: (r.n_lines, r.n_kept, r.removed) for r in lines.clean(table).collect()}
    assert counts == {1: (3, 2, [0]), 2: (4, 3, [1]), 3: (1, 0, [0]), 4: (6, 3, [0, 1]), 5: (0, 0, []), 6: (1, 1, []), None: (3, 3, [])}


def test_packing_covers_every_id_once(docs):
    path = catalog.tokenizer_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    pieces = packing.pack(docs, lambda: packing.WordTokenizer(path), packing.Settings(window=64)).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc, text, *_ in CASES:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[doc], key=lambda p: (p.start, p.sequence_id))
        if doc != 9:
            assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == ids and {p.doc_tokens for p in own} == {len(ids)}
    assert sum(p.length for p in by_doc[9]) == 2 * (len(plain.encode("word", add_special_tokens=False).ids) + 1)
    for row in by_sequence.values():
        row.sort(key=lambda p: p.offset)
        assert [p.offset for p in row] == [0, *np.cumsum([p.length for p in row])[:-1].tolist()]
        size = sum(p.length for p in row)
        assert size == 64 or size & (size - 1) == 0


def test_combinations_solve_the_histogram():
    settings = packing.Settings(window=100)
    lengths = packing.Counter({60: 50, 40: 50, 30: 20, 70: 20, 20: 30})
    combos = packing.combinations(lengths, settings)
    used = packing.solve_counts(combos, lengths, settings) @ np.array([[c.count(n) for n in sorted(lengths)] for c in combos])
    assert all(sum(c) == 100 for c in combos) and np.abs(used - [lengths[n] for n in sorted(lengths)]).max() < 1


def test_word_tokenizer_equals_the_library():
    path = catalog.tokenizer_path("word_bpe_49k.json")
    plain, own, rng = Tokenizer.from_file(path), packing.WordTokenizer(path), random.Random(1)
    texts = ["", "don't I'll 'sup", "a\x1cb !\x1c!", "É x≠ ß ẞ ΑΣ", "<|endoftext|>a", "漢字 hi", "…)( a.b,c!?!"]
    texts += ["".join(rng.choice("aÉé'.,!1 \n-́(\"") for _ in range(40)) for _ in range(300)]
    assert [x.tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_equals_the_library(spark, docs):
    path = catalog.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    codec, rng = bpe.Codec(path), random.Random(2)
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
    texts = [None, "", "\n\n a  b\n", "I'll'd 've''s 'r 'v rel 'lll", "漢字 हिन्दी \x1c\x00", "x" * 3000, "ab" * 900, " " * 900 + "a"]
    texts += ["".join(rng.choice("aré'rvlsed.!1 \n  　漢\0") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    for text, (said, ids) in zip(texts, codec.encode(texts), strict=True):
        want = plain.encode_ordinary(text or "")
        assert ids.tolist() == want and said == ",".join(map(str, want)).encode() and codec.decode(ids) == (text or "").encode()
    encoded = bpe.encode(docs, lambda: bpe.Codec(path))
    back = {(r.doc_id, bytes(r.text).decode()) for r in bpe.decode(encoded, lambda: bpe.Codec(path)).collect()}
    assert back == {(i, t or "") for i, t, *_ in CASES}
    row = bpe.round_trip(docs.where("doc_id = 9").limit(1), lambda: bpe.Codec(path)).first()
    assert row.decoded_sha256 == hashlib.sha256(b"word").hexdigest()


def test_chat_reads_back_exactly(spark):
    rows = [(1, 0, "system", None), (1, 1, "user", "\\### a: </turn>\n"), (1, 2, "assistant", "ü<#\\"), (1, 3, "assistant", ""), (2, 0, "odd: r\n", "x"), (3, 0, None, LONG)]
    made = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    told = "".join(f"{r or ''}\n{t or ''}\n" for c, _, r, t in rows if c == 1)
    assert got[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest() and got[1].n_turns == 4
    assert (got[1].loss_chars, got[1].loss_sha256) == (4, hashlib.sha256("ü<#\\".encode()).hexdigest())
    assert got[2].turns_sha256 == hashlib.sha256(b"odd: r\n\nx\n").hexdigest() and got[3].loss_chars == 0
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big, other = "<p>" + "é" * 1200 + "\r\n\r\n", "y" * 5000 + "\nWARC/1.1\r\n"
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "http://c/", big), (4, "http://d/", None), (5, "http://e/", "s"), (6, "http://f/", "s"), (7, "http://g/", other), (None, "http://h/", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    warc.write_arc(pages, str(tmp_path / "arc"))
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    got = {r.page_id: r for r in warc.read_warc(spark, str(tmp_path / "warc")).collect()}
    for page_id, _, html in rows:
        data, row = (html or "").encode(), got[page_id]
        assert (row.payload_bytes, row.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (row.record_type, row.refers_to) == (("revisit", 3) if page_id in (1, 2) else ("response", None))
        assert row.html is None if page_id in (1, 2) else bytes(row.html) == data
    v1 = [b"filedesc://x 0.0.0.0 20240102030405 text/plain 77", b"1 0 x", b"URL IP-address Archive-date Content-type Archive-length", b"", b""]
    with pytest.raises(ValueError):
        list(warc.arc_records(warc.Lines(iter(v1[:2]))))


def test_language_network_learns(spark):
    rng = random.Random(4)
    word = {"aa": "abcde", "bb": "uvwxyz"}
    rows = [(i, " ".join("".join(rng.choice(word[lang]) for _ in range(5)) for _ in range(30)), lang) for i in range(120) for lang in (("aa", "bb")[i % 2],)]
    rows += [(900, None, "aa"), (901, "12 !", "aa"), (902, "", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = langid.train(table, langid.Settings(steps=60))
    got = {r.doc_id: r for r in langid.predict(table, network).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows[:120]) >= 118
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert got[5].held_out == (zlib.crc32(b"5") % 5 == 0)
    assert {r.doc_id for r in langid.keep_known(table, network).collect()} == set(range(120))
    assert langid.predict(table, langid.train(table.limit(0))).first().lang_pred == "und"


def test_every_language_is_learned(spark):
    """More languages than 64, of one letter each; the sample's bound is shared by all."""
    rng = random.Random(6)
    rows = [(i, " ".join(chr(0x4E00 + 97 * (i % 70)) * rng.randint(2, 6) for _ in range(40)), f"l{i % 70:02}") for i in range(700)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = langid.train(table, langid.Settings(max_docs=350))
    assert network.langs == [f"l{k:02}" for k in range(70)]
    got = {r.doc_id: r for r in langid.predict(table, network).collect()}
    right = {i for i, _, lang in rows if got[i].lang_pred == lang}
    assert len(right) >= 560 and sum(i % 70 >= 64 for i in right) >= 45
    kept = {r.doc_id for r in langid.keep_known(table, network).collect()}
    assert len(kept) >= 690


def test_gradients_match_differences():
    network = langid.Network(["a", "b"], langid.Settings(hidden=3))
    rng = np.random.default_rng(0)
    codes, target = rng.integers(0, 256, (7, 5)), np.array([0, 1, 1, 0, 1])
    _, grads = network.gradients(codes, target)
    for values, grad in zip(network.parameters(), grads, strict=True):
        spot = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        before, step = values[spot], 1e-2
        values[spot] = before + step
        up = network.gradients(codes, target)[0]
        values[spot] = before - step
        down = network.gradients(codes, target)[0]
        values[spot] = before
        assert abs((up - down) / (2 * step) - grad[spot]) < 0.05 * abs(grad[spot]) + 1e-4


def test_toxicity_chain(spark):
    rows = [(i, f"some plain words {i % 7} here" + (" you utter nastyword" if i % 5 == 0 else "")) for i in range(300)] + [(900, None), (901, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = table.where("doc_id < 200").select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"), F.lit(1).alias("quality"))
    chain = toxicity.train(table, labels, catalog.categories())
    flagged = {r.doc_id for r in toxicity.score(table, chain).where("flagged").collect()}
    assert flagged == {i for i in range(300) if i % 5 == 0}
    assert toxicity.keep_clean(table, chain).count() == 242
    empty = toxicity.train(table, labels.limit(0), catalog.categories())
    assert toxicity.score(table, empty).where("flagged").count() == 0


def test_toxic_words_beside_other_characters(spark):
    """Quotes, dashes, no-break spaces and inverted marks end a word; capitals fold, stems are of characters."""
    rows = [(i, f"some plain words {i % 7} here" + (" you utter éçàüword" if i % 5 == 0 else "")) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = table.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"), F.lit(1).alias("quality"))
    chain = toxicity.train(table, labels, catalog.categories())
    texts = ["some “you” «utter» ¡éçàüword! here", "you\u00a0utter\u00a0éçàüword—plain", "YOU UTTER ÉÇÀÜWORD", "you… utter… éçàüwords", "plain “words” – here"]
    assert [p >= 0.5 for p in chain.score([t.encode() for t in texts])[:, chain.categories.index("toxic")]] == [True, True, True, True, False]
    assert toxicity.words_of("हिन्दी e\u0301te_x".encode()) == {"हिन्दी", "हिन्द*", "हिन्*", "e\u0301te", "x"}
    assert {"坏话", "他说坏话"} <= toxicity.words_of("“他说坏话”。".encode()) and toxicity.words_of(b"\xff a\xff") == {"a"}


def test_lattice_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 64))
    near = [b + rng.normal(size=64) * s for b in base for s in (0.05, 0.12, 0.17)]
    vectors = [v.tolist() for v in [*base, *near, base[0] * 3]] + [base[1].tolist()]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [0.0] * 64, 1), (902, [float("nan")] * 64, 1), (903, vectors[1], None), (904, [None] * 64, 1), (905, [], 1)]
    want_n, sets = {i: 0 for i, *_ in rows}, {}
    root = {i: i for i in want_n}
    find = lambda k: k if root[k] == k else find(root[k])
    good = [(i, np.array(v) / np.linalg.norm(v), y) for i, v, y in rows if i < 900]
    for (i, u, x), (j, v, y) in itertools.combinations(good, 2):
        if x == y and u @ v >= 0.98:
            want_n[i] += 1
            want_n[j] += 1
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    got = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), lattice.Settings(block=8)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n, find(i), find(i) == i) for i, n in want_n.items()}
    assert sum(want_n.values()) > 40 and not sets
    x = rng.normal(size=(50, 8))
    nearest = lattice.nearest_point(x)
    assert all(((x[i] - nearest[i]) ** 2).sum() <= ((x[i] - nearest[i] - r) ** 2).sum() + 1e-9 for i in range(50) for r in lattice.ROOTS)
