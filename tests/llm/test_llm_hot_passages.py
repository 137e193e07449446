"""A passage that most documents hold, in different surroundings in each."""

import random

import brute
import pytest
from vigil.llm import repeats, suffix_dedup, superkmers

N = 9000


def documents(spark, passage):
    rnd = random.Random(7)

    def around():  # three words of four, then words that no other document has
        return rnd.choices(["abcdefghi", "jklmnopqr", "stuvwxyzA", "BCDEFGHIJ"], k=3), [
            f"{rnd.getrandbits(36):09x}" for _ in range(20)]

    rows = []
    for i in range(N):
        (left, far_left), (right, far_right) = around(), around()
        rows.append((i, " ".join([*far_left, *left, *passage, *right, *far_right])))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(8)


CASES = [(suffix_dedup, [f"line{i}" for i in range(10)], 100, 32),
         (superkmers, [f"w{i}" for i in range(44)], 50, 8)]


@pytest.mark.parametrize("op, passage, width, gram", CASES)
def test_no_bucket_holds_the_passage_of_all(spark, op, passage, width, gram):
    _, docs = documents(spark, passage)
    *before, match = op._functions(width, gram)

    def guarded(ids, rows, starts, packed):
        if len(packed) > N // 4:
            raise ValueError(f"{len(packed)} strings in one bucket")
        return match(ids, rows, starts, packed)

    found, n_blocks = repeats.with_blocks(docs, "doc_id", "text")
    repeats.repeated_spans(found, n_blocks, *before, guarded).count()


def test_hot_passages_match_brute_force(spark):
    rows, docs = documents(spark, CASES[0][1])
    want = brute.byte_repeats(rows)
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans))
           for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert got == {i: w[:3] for i, w in want.items()}
    assert sum(w[1] > 0 for w in want.values()) > N // 4
    rows, docs = documents(spark, CASES[1][1])
    want = brute.word_repeats(rows)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in superkmers.substring_dedup(docs).collect()}
    assert got == {i: w[:2] for i, w in want.items()}
    assert sum(w[1] > 0 for w in want.values()) > N // 4
