"""The registered queries of this package and their SQL checks."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from . import bpe, centroids, chat, exact, infill, langid, lattice, lines, minhash, mixture, packing, toxicity, warc
from .common import table

# The flag is the last category's, whose model sees the probabilities of those before it.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def categories():
    return {name: F.expr(sql) for name, sql in CATEGORIES.items()}


def tokenizer_path(name: str) -> str:
    """The place of a vocabulary file, the same on every machine; SEINE_TOKENIZERS names another folder."""
    folder = os.environ.get("SEINE_TOKENIZERS")
    return f"{folder}/{name}" if folder else public_tokenizers.path(name)


def op1_lattice(spark, sf_dir):
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(shingle=2))


def op3_packing(spark, sf_dir):
    path = tokenizer_path("word_bpe_49k.json")
    pieces = packing.pack(table(spark, sf_dir, "documents"), lambda: packing.WordTokenizer(path))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_exact_dedup(spark, sf_dir):
    rows = cut_lineage(exact.digests(table(spark, sf_dir, "documents")), "digests")
    path = scratch_path(spark, "digest_index")
    index = exact.DigestIndex(spark, path.rpartition("/")[2].replace("-", "_"), path)
    index.add(rows)
    return index.resolve(rows).select(
        "doc_id", "keep_id", F.col("n_rows").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_line_dedup(spark, sf_dir):
    return lines.clean(table(spark, sf_dir, "documents"))


def op6_chat(spark, sf_dir):
    text = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(rows.union(planted)))


def op7_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels"), categories()))


def op8_bpe(spark, sf_dir):
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), lambda: bpe.Codec(path))


def op9_warc(spark, sf_dir):
    arc, archive = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc)
    warc.convert(spark, arc, archive)
    return warc.read_warc(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return langid.predict(documents, langid.train(documents))


def op11_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_mixture(spark, sf_dir):
    return mixture.taken(mixture.mix_sources(table(spark, sf_dir, "documents")))


def op13_infill(spark, sf_dir):
    return infill.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_lattice, op2_minhash, op3_packing, op4_exact_dedup, op5_line_dedup, op6_chat, op7_toxicity, op8_bpe, op9_warc, op10_language,
        op11_centroids, op12_mixture, op13_infill,
    )
}


def _centroids_sql(rounds: int) -> str:
    """The rounds written out: centroids c0, c1, ..., and assignments a0, a1, ... to them."""
    steps = [
        """v AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "f AS MATERIALIZED (SELECT x, sha256(concat('1:', vec_id)) AS h FROM v ORDER BY h LIMIT 16)",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS j, x AS c FROM f)",
    ]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (
        SELECT vec_id, x, j, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{i})""")
        steps.append(f"""a{i} AS MATERIALIZED (
        SELECT vec_id, x, j, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, j) AS rn FROM d{i}) WHERE rn = 1)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
        SELECT j, p, sum(y) AS s, count(*) AS n FROM (SELECT j, unnest(x) AS y, unnest(range(64)) AS p FROM a{i}) GROUP BY j, p)""")
            steps.append(f"""c{i + 1} AS MATERIALIZED (
        SELECT c.j, coalesce(n.c, c.c) AS c FROM c{i} c LEFT JOIN (
          SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS c FROM m{i} GROUP BY j) n ON n.j = c.j)""")
    return f"""
      WITH {', '.join(steps)}
      SELECT vec_id, CAST(a.j AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
        CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
      FROM a{rounds} a JOIN c{rounds} c ON c.j = a.j"""


ORACLES = {
    "op4_exact_dedup": """
      WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
      SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
      FROM d WINDOW w AS (PARTITION BY h)""",
    "op6_chat": """
      WITH t AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
      SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(4 + length(role) + 2 + 8 + length(text)
          + 2 * length(text) - length(replace(replace(text, '#', ''), '<', '')) - length(replace(text, chr(92), ''))) AS BIGINT) AS formatted_chars
      FROM t GROUP BY conv_id""",
    "op9_warc": """
      WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last FROM p)
      SELECT page_id, n AS payload_bytes, d AS payload_digest,
        CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to FROM w""",
    "op11_centroids": _centroids_sql(3),
    "op13_infill": r"""
      WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256(concat('7:', doc_id)) AS h FROM documents),
        e AS (SELECT *, len(u) AS n, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) AS h1, CAST(concat('0x', substr(h, 9, 8)) AS BIGINT) AS h2,
          CAST(concat('0x', substr(h, 25, 8)) AS BIGINT) AS h4 FROM d),
        f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e),
        g AS (SELECT *, array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, b), '') AS m,
          array_to_string(list_slice(u, b + 1, n), '') AS s FROM f)
      SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM g""",
}
