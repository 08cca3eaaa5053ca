"""The pipeline against a plain version of its deterministic stages."""

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_pipeline_on_the_small_tables(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), documents.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert docs.columns == documents.columns
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert kept["language"].keys() <= texts.keys() and len(kept["language"]) >= len(texts) - 2
    last = {}
    for doc, text in kept["toxicity"].items():
        folded = text.encode().lower()
        last[folded] = max(doc, last.get(folded, doc))
    assert set(kept["exact dedup"]) == set(last.values())
    sets = {}
    for doc, text in kept["exact dedup"].items():
        words = text.encode().lower().split()
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root = {d: d for d in sets}
    find = lambda d: d if root[d] == d else find(root[d])
    ordered = sorted(sets)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(kept["near dedup"]) == {d for d in sets if find(d) == d}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {p.doc_id for p in pieces} == set(kept["near dedup"])


def test_an_empty_corpus(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
