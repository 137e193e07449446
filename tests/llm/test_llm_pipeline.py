"""The pipeline's rows against a sequential run of its stages."""

import numpy as np

import brute
import corpus_pipeline
from vigil.llm import bpe, quality_knn, registry

SF = "/root/testdata/sf0.001"


def without_repeats(docs, width=50):
    words = {i: brute.WORD.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][k:k + width]), i)
    for i, t in docs:
        w, gone = words[i], set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        yield i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t


def test_pipeline_matches_sequential_stages(spark):
    scores = {r.doc_id: r.score for r in registry.QUERIES["op4_quality_knn"](spark, SF).collect()}
    docs = [(i, t) for i, t in brute.table(SF, "documents", "doc_id, text")
            if scores[i] >= quality_knn.THRESHOLD]
    last = {brute.ascii_lower(t): i for i, t in docs}
    docs = [(i, t) for i, t in docs if last[brute.ascii_lower(t)] == i]
    group = brute.jaccard_components(docs)
    docs = [(i, t) for i, t in docs if group[i][1] == i]
    codec = bpe.WordBpe(bpe.load(bpe.default_vocabulary()))
    want = set()
    for i, t in without_repeats(docs):
        ids = np.frombuffer(codec.encode([t or ""])[0], "<u4").tolist() + [1]
        want |= {(i, s, len(ids[s:s + 2048]), brute.crc(ids[s:s + 2048]), len(ids))
                 for s in range(0, len(ids), 2048)}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows} == want
    assert len(rows) == len(want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(30), SF).columns == docs.columns
