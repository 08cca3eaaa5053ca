"""Line dedup by an exact set-similarity join, in DataFrame operations only.

The tokens of a line are its distinct words. They are ordered by rarity, and two lines of
Jaccard similarity 0.8 or more must share a token in their prefixes of that order. Lines
meet on prefix tokens; the length filter, the positional filter and a bound on the overlap
from 64-bit token maps leave few pairs; long lines must share several prefix tokens. The
similarity of what is left is computed in full. A line
is removed if an earlier one, by doc_id and line number, is similar enough, whether that
one is itself removed or not.

A group of near copies would make all its pairs, whose verdicts are the same. So every line
is first compared with a few before it that share a rare token and about its length; those
similar to one are settled, and only the others look for an earlier match among all lines.

Lines with equal tokens are one set, which its first occurrence stands for. Rarity comes
from a fixed number of counters over hashed tokens: any one order is exact, and a bounded
table is all that has to go to the tasks.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import marked

PERCENT = 80
COUNTERS = 1 << 19
# Counters that one task puts in order.
COUNTER_ROWS = 1 << 12
# A prefix is longer by one token per so many, and pairs must share as many tokens more.
MORE = 32
# Tokens of a set on each of which it is first compared with one of so many sets before it.
TRIED_TOKENS = 3
BEFORE = 8
# Words seen more than 2 to this power times have early sets of their own in parts of about so many sets.
PART_BITS = 12
# Bits of the maps of the lines and sets to verify, which spare the other lines being cut into words.
VERIFY_BITS = 1 << 23
BLANKS = " \t\r\f\x0b"


def _cut(df: DataFrame, label: str) -> DataFrame:
    return cut_lineage(df, label, tidy=True)


def line_rows(documents: DataFrame) -> DataFrame:
    """doc_id, text_id, line_no and line of every line; a null text has none.

    The text_id is a hash of the whole text: it tells rows that share a doc_id, or have none, apart.
    """
    rows = documents.where("text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), F.split("text", "\n", -1).alias("lines")
    )
    return rows.select("doc_id", "text_id", F.posexplode("lines").alias("line_no", "line"))


def words(line: str = "line") -> str:
    """The words of a line, which ASCII white space divides, and empty ones; most lines hold no other than the space."""
    other = " OR ".join(f"contains({line}, '{c}')" for c in BLANKS[1:])
    plain, rest = f"split(lower({line}), ' ', -1)", f"split(lower({line}), '[{BLANKS}]+', -1)"
    return f"if({other}, {rest}, {plain})"


def worded_lines(documents: DataFrame) -> DataFrame:
    """The rows of ``line_rows`` that have words."""
    return line_rows(documents).where(F.btrim("line", F.lit(BLANKS)) != "")


def _counters(documents: DataFrame) -> DataFrame:
    """One row: how often a word of each hashed value occurs, as an array of powers of two; 0 stands for once at most."""
    found = documents.select(F.explode(F.expr(words("replace(text, '\n', ' ')"))).alias("word"))
    counts = found.groupBy(F.expr(f"cast(xxhash64(word) & {COUNTERS - 1} as int)").alias("place")).agg(F.count("*").alias("n"))
    places = documents.sparkSession.range(COUNTERS).select(F.col("id").cast("int").alias("place"), F.lit(0).cast("long").alias("n"))
    # Rarity by powers of two, at most 62; the packed order then is a few bits and the hash.
    rank = F.floor(F.log2(F.greatest(F.max("n"), F.lit(1)))).cast("tinyint")
    every = places.union(counts).groupBy("place").agg(rank.alias("rank"))
    parts = every.groupBy(F.expr(f"place div {COUNTER_ROWS}").alias("part")).agg(F.array_sort(F.collect_list(F.struct("place", "rank"))).alias("rows"))
    parts = parts.select("part", F.col("rows.rank").alias("ranks"))
    return parts.agg(F.array_sort(F.collect_list(F.struct("part", "ranks"))).alias("rows")).select(F.flatten(F.col("rows.ranks")).alias("ranks"))


def _lines(documents: DataFrame, view: str) -> DataFrame:
    """Every line with words: its place, the id and size of its set, a map of the tokens and the prefix of their order.

    The one row of ranks is a scalar subquery: a constant of fixed size in the plan.
    """
    place = ("doc_id", "text_id", "line_no")
    hashes = f"array_remove(transform({words()}, w -> xxhash64(w)), xxhash64(''))"
    hashed = worded_lines(documents).selectExpr(*place, f"{hashes} AS hashes", f"(SELECT ranks FROM {view}) AS ranks")
    # Longs that cannot be null are sorted without being boxed.
    rank = f"coalesce(cast(ranks[h & {COUNTERS - 1}] as bigint), 0L)"
    order = f"transform(hashes, h -> shiftleft({rank}, 58) | shiftrightunsigned(h, 6))"
    return hashed.selectExpr(*place, f"sort_array(array_distinct({order})) AS tokens").selectExpr(
        *place, "xxhash64(tokens) AS set_id", "size(tokens) AS n",
        "aggregate(tokens, 0L, (a, t) -> a ^ shiftleft(1L, cast(t & 63 as int))) AS bits",
        f"slice(tokens, 1, size(tokens) - {_ceil(f'size(tokens) * {PERCENT}', 100)} + 1 + cast(size(tokens) div {MORE} as int)) AS prefix",
    )


def _close(x_n: str = "x.n", y_n: str = "y.n") -> str:
    """The length and map filters on sets x and y."""
    need = _ceil(f"{PERCENT} * ({x_n} + {y_n})", 100 + PERCENT)
    return f"100 * least({x_n}, {y_n}) >= {PERCENT} * greatest({x_n}, {y_n}) AND {x_n} + {y_n} - bit_count(x.bits ^ y.bits) >= 2 * {need}"


def _close_on_token() -> str:
    """The length, positional and map filters on rows x and y of one prefix token, whose ``at`` packs size and position."""
    size, pos = (lambda r: f"cast(shiftright({r}.at, 32) as int)"), (lambda r: f"cast({r}.at & 2147483647 as int)")
    less, need = f"least({size('x')}, {size('y')})", _ceil(f"{PERCENT} * ({size('x')} + {size('y')})", 100 + PERCENT)
    left = f"least({size('x')} - {pos('x')}, {size('y')} - {pos('y')})"
    return f"{left} >= {need} - {less} div {MORE} AND {_close(size('x'), size('y'))}"


def _verified(pairs: DataFrame, documents: DataFrame, firsts: DataFrame) -> DataFrame:
    """set_id and match of ``pairs`` (a, b) that are similar: the later set's, and where the earlier first stands.

    Only the lines asked for, found by their places, are cut into words again.
    """
    asked = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct().join(firsts, "set_id")
    asked = _cut(asked.select("set_id", "first", "first.doc_id", "first_text", "first.line_no"), "line_asked")
    keys = asked.select("doc_id", F.col("first_text").alias("text_id"), "line_no")
    rows = line_rows(documents).where(marked(keys, "doc_id", "text_id", "line_no", size=VERIFY_BITS)).alias("r")
    met = rows.join(asked.alias("k"), F.expr("r.doc_id <=> k.doc_id AND r.text_id = k.first_text AND r.line_no = k.line_no")).select("set_id", "first", "line")
    # Both joins read one exchange of the lines; their words, which take more room, come after.
    found = met.dropDuplicates(["set_id"])
    one = pairs.join(found.select(F.col("set_id").alias("a"), F.col("line").alias("s"), F.col("first").alias("f")), "a")
    both = one.join(found.select(F.col("set_id").alias("b"), F.col("line").alias("t"), F.col("first").alias("g")), "b")
    both = both.selectExpr("a", "b", "f", "g", *[f"array_remove(array_distinct({words(c)}), '') AS {c}" for c in "st"])
    both = both.withColumn("common", F.size(F.array_intersect("s", "t")))
    similar = both.where(f"100 * common >= {PERCENT} * (size(s) + size(t) - common)")
    later = F.when(F.col("f") < F.col("g"), F.col("b")).otherwise(F.col("a"))
    matches = similar.groupBy(later.alias("set_id")).agg(F.min(F.least("f", "g")).alias("match"))
    return _cut(matches, "line_matches")


def _early_pairs(reps: DataFrame) -> DataFrame:
    """Pairs (a, b) of a set and one before it with which it shares a token and about its length.

    Of a prefix the tokens of least hash are tried, which near copies are likely to share
    whatever rare words each has of its own; on each, of the sets just before and the first
    one, that of the most similar map. The turned token begins with its hash and ends with
    its rarity, which bounds the sets it is in: those of a frequent one are dealt to parts.
    """
    turned = f"slice(sort_array(transform(prefix, t -> shiftleft(t, 6) | shiftrightunsigned(t, 58))), 1, {TRIED_TOKENS})"
    rows = reps.selectExpr(
        "set_id", "n", "bits", "first.doc_id AS doc", f"explode({turned}) AS token", f"cast(floor(ln(n) / {math.log(100 / PERCENT)}) as int) AS band"
    )
    part = f"pmod(xxhash64(set_id), shiftleft(1L, cast(greatest((token & 63) - {PART_BITS}, 0) as int)))"
    rows = rows.where("token & 63 > 0").selectExpr("n", "doc", f"hash(token, band, {part}) AS key", "set_id", "bits")
    order = Window.partitionBy("key").orderBy("doc", "set_id")
    y = F.struct("set_id", "n", "bits")
    some = F.array_append(F.collect_list(y).over(order.rowsBetween(-BEFORE, -1)), F.first(y).over(order))
    near = f"filter(some, x -> x.set_id <> y.set_id AND {_close()})"
    best = f"array_min(transform({near}, x -> struct(bit_count(x.bits ^ y.bits) AS apart, x.set_id)))"
    tried = rows.select(y.alias("y"), some.alias("some")).where(F.size("some") > 1).selectExpr(f"{best}.set_id AS a", "y.set_id AS b")
    return tried.where("a IS NOT NULL").distinct()


def _prefix_rows(reps: DataFrame) -> DataFrame:
    """A row for every prefix token of the sets ``reps`` that another set may hold."""
    rows = reps.select("set_id", "n", "bits", "first", F.posexplode("prefix").alias("pos", "token"))
    # A word that occurs once, whose token so has rank 0, is in no other set.
    rows = rows.where("shiftrightunsigned(token, 58) > 0")
    # Tokens meet by 32 bits of them: two that agree by chance add pairs to verify and lose none.
    return rows.selectExpr("hash(token) AS token", "set_id", "bits", "shiftleft(cast(n as bigint), 32) | pos AS at", f"coalesce(first.doc_id, {-(2**63) + 1}L - 1) AS doc")


def similar_lines(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every line with words (doc_id, text_id, line_no, set_id, ...), and the sets of several lines or with a match.

    The latter are set_id, the first place, and match: the place of an earlier set that is
    similar, null if there is none.
    """
    view = f"rarity_{uuid.uuid4().hex}"
    _cut(_counters(documents), "rarity").createOrReplaceTempView(view)
    lines = _cut(_lines(documents, view), "lines")
    here = F.struct("doc_id", "line_no")
    firsts = lines.groupBy("set_id").agg(F.min(F.struct("doc_id", "line_no", "text_id")).alias("f"), F.count("*").alias("copies"))
    firsts = firsts.select("set_id", F.struct("f.doc_id", "f.line_no").alias("first"), F.col("f.text_id").alias("first_text"), "copies")
    firsts = _cut(firsts, "line_sets")
    several = firsts.where("copies > 1").select("set_id", "first")
    # A set's first line stands for it; repeated rows of its document do as well, which adds nothing.
    # Maps of the sets of several lines, and of the settled ones, spare the other lines an exchange.
    every, many = lines.select("set_id", "n", "bits", "prefix", here.alias("here")), marked(several, "set_id", size=VERIFY_BITS)
    stand = every.where(many).join(several, "set_id", "left").where("first IS NULL OR first <=> here").drop("first")
    reps = every.where(~many).union(stand).withColumnRenamed("here", "first")

    settled = _verified(_cut(_early_pairs(reps), "early_pairs"), documents, firsts)

    # The others meet one another, and settled ones that do not stand in a later document, on every prefix token.
    mark, maybe = settled.select("set_id"), marked(settled, "set_id", size=VERIFY_BITS)
    unsettled = reps.where(~maybe).union(reps.where(maybe).join(mark, "set_id", "left_anti"))
    open_rows, done_rows = _prefix_rows(unsettled), _prefix_rows(reps.where(maybe).join(mark, "set_id", "left_semi"))
    pair = ["least(x.set_id, y.set_id) AS a", "greatest(x.set_id, y.set_id) AS b", f"least(shiftright(x.at, 32), shiftright(y.at, 32)) div {MORE} AS more"]
    x, y, z = open_rows.alias("x"), open_rows.alias("y"), done_rows.alias("x")
    # Both joins use the same columns of the open rows, so that these are exchanged once for all.
    once = "(x.doc < y.doc OR x.doc = y.doc AND x.set_id < y.set_id)"
    pairs = x.join(y, F.expr(f"x.token = y.token AND {once} AND {_close_on_token()}")).selectExpr(*pair)
    pairs = pairs.union(z.join(y, F.expr(f"x.token = y.token AND x.doc <= y.doc AND {_close_on_token()}")).selectExpr(*pair))
    shared = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("more").alias("more"))
    found = _verified(_cut(shared.where("shared > more").select("a", "b"), "line_pairs"), documents, firsts)

    matches = _cut(settled.union(found).groupBy("set_id").agg(F.min("match").alias("match")), "line_verdicts")
    alone = several.join(matches, "set_id", "left_anti").withColumn("match", F.lit(None).cast(matches.schema["match"].dataType))
    return lines, alone.unionByName(firsts.select("set_id", "first").join(matches, "set_id"))


def _ceil(value: str, divisor: int) -> str:
    return f"cast(({value} + {divisor - 1}) div {divisor} as int)"


def removed_lines(documents: DataFrame) -> DataFrame:
    """doc_id, text_id and line_no of every line to remove, and the place of an earlier line it is like.

    A line without words is never removed. Repeated rows of a document stand at the same
    places and do not remove each other.
    """
    lines, sets = similar_lines(documents)
    here = F.struct("doc_id", "line_no")
    joined = lines.select("doc_id", "text_id", "line_no", "set_id").join(sets, "set_id")
    gone = joined.where((here > F.col("first")) | (F.col("match") < here))
    like = F.least("first", "match")
    return gone.select("doc_id", "text_id", "line_no", like["doc_id"].alias("like_doc_id"), like["line_no"].alias("like_line_no"))


def _gone(documents: DataFrame) -> DataFrame:
    """The sorted numbers of the lines to remove of every text that loses any: doc_id, text_id, gone."""
    gone = removed_lines(documents).groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    return _cut(gone, "lines_gone")


def without_lines(documents: DataFrame) -> DataFrame:
    """The documents, every row and column kept, their texts without the lines to remove.

    A text all of whose lines go is empty; a null text stays null. Columns beyond doc_id and
    text may have any name.
    """
    names = documents.columns
    gone = _gone(documents.select("doc_id", "text"))
    plain = documents.toDF(*[n if n in ("doc_id", "text") else f"c{i}" for i, n in enumerate(names)])
    keyed = plain.withColumns({"own_id": F.col("doc_id").cast("long"), "own_text": F.xxhash64("text")})
    keys = gone.select(F.col("doc_id").alias("own_id"), F.col("text_id").alias("own_text"))
    # Texts without a removed line need no join, so they are not exchanged.
    touched = F.col("text").isNotNull() & marked(keys, "own_id", "own_text")
    held = gone.select(F.col("doc_id").alias("lost_id"), F.col("text_id").alias("lost_text"), "gone")
    met = keyed.where(touched).join(held, F.expr("own_id <=> lost_id AND own_text = lost_text"), "left")
    cut = met.withColumn("parts", F.split("text", "\n", -1)).withColumn("stay", F.expr("array_except(sequence(0, size(parts) - 1), gone)"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.expr("array_join(transform(stay, i -> parts[i]), '\n')"))
    whole = keyed.where(~touched).select(*plain.columns)
    return whole.union(cut.withColumn("text", text).select(*plain.columns)).toDF(*names)


def clean(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_kept and the sorted numbers of the lines removed.

    Rows that share a doc_id are taken together; a document without text has no lines.
    ``without_lines`` gives the texts themselves.
    """
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), n_lines.cast("long").alias("n_lines"))
    texts = rows.groupBy("doc_id", "text_id").agg(F.sum("n_lines").alias("n_lines"), F.count("*").alias("rows"))
    held = _gone(documents.select("doc_id", "text")).select(F.col("doc_id").alias("lost_id"), F.col("text_id").alias("lost_text"), "gone")
    met = texts.join(held, F.expr("doc_id <=> lost_id AND text_id = lost_text"), "left")
    kept = F.col("n_lines") - F.col("rows") * F.coalesce(F.size("gone"), F.lit(0))
    removed = F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone"))))
    return met.withColumn("n_kept", kept).groupBy("doc_id").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_kept").alias("n_kept"), removed.alias("removed"))
