"""Every stage of the pipeline on nulls, blank texts, repeated rows and empty tables."""

import brute
import corpus_pipeline
import pytest
from test_llm_operators import docs_of, odd  # noqa: F401  (a fixture)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = [f for _, f in corpus_pipeline.STAGES]


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], SCHEMA)


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=lambda i: (i is None, i))


def test_near_keeps_null_ids(spark, odd):  # noqa: F811
    group = brute.jaccard_components(list({i: (i, t) for i, t in odd if i is not None}.values()))
    want = sorted(i for i, _ in odd if i is not None and group[i][1] == i)
    assert ids(corpus_pipeline.near(spark, table(spark, odd), SF)) == [*want, None]
    assert len(want) < len({i for i, _ in odd}) - 1


def test_other_stages_keep_odd_rows(spark, odd):  # noqa: F811
    docs = table(spark, odd)
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert (None in ids(kept)) == (7 in ids(kept)) and ids(kept).count(9) in (0, 2)
    assert ids(corpus_pipeline.exact(spark, table(spark, [*odd, (None, "alone")]), SF)) == [
        2, 3, 4, 6, 8, 9, 10, 12, 13, None]
    assert ids(corpus_pipeline.substrings(spark, docs, SF)) == ids(docs)
    assert set(ids(corpus_pipeline.packed(spark, docs, SF))) == set(ids(docs))


@pytest.mark.parametrize("stage", STAGES, ids=lambda f: f.__name__)
def test_stages_of_an_empty_table(spark, stage):
    assert stage(spark, table(spark, []), SF).count() == 0


def test_further_columns_go_along(spark, odd):  # noqa: F811
    docs = docs_of(spark, odd).selectExpr("*", "1 AS kept", "2 AS n_removed")
    for stage in (corpus_pipeline.quality, corpus_pipeline.substrings):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(tuple(r)[2:] == (1, 2, 3, 4, 5, 0.5, "k", 1, 2) for r in rows)
    assert len(rows) == len(odd)
    plain = docs.select("doc_id", "text")
    assert corpus_pipeline.substrings(spark, plain, SF).count() == len(odd)


def test_kept_documents_of_hot_texts(spark):
    from pyspark.sql import functions as F

    from vigil.llm import exact_dedup
    rows = [(i, ("Hot Text", "hot text", "HOT TEXT")[i % 3], i % 5) for i in range(900)]
    rows += [(1000 + i, f"Cold {i // 2}", i) for i in range(20)]
    rows += [(None, "cold 3", 1), (None, None, 1), (None, "Alone", 1), (2000, "", 1), (2000, None, 2)]
    table = spark.createDataFrame(rows * 2, "doc_id long, text string, digest int").repartition(7)
    for digest in (exact_dedup.sha256, lambda c: F.lit(b"same")):  # the last: one hot digest
        got = exact_dedup.kept_documents(table, digest=digest)
        assert got.columns == table.columns
        kept = sorted(((r.doc_id, (r.text or "").lower()) for r in got.collect()), key=str)
        want = {}
        for i, t, _ in rows:
            t = (t or "").lower()
            want[t] = i if t not in want or (want[t] is None) or (i is not None and i > want[t]) else want[t]
        assert kept == sorted(((i, t) for t, i in want.items()), key=str)
