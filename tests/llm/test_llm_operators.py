"""Every operator against a brute-force version, and on awkward small tables."""

import hashlib
import random
import unicodedata

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL
from vigil.llm import (bpe, dual_tree, exact_dedup, jaccard_join, packing, quality_knn, registry,
                       sharding, suffix_dedup, superkmers, url_filter)
from vigil.llm.components import components

LONG = "word " * 30_000


def docs_of(spark, rows):
    """A documents table with more columns, some named like the operators' own."""
    schema = ("doc_id long, text string, id long, block int, keep_id long, n long, bucket int, "
              "score double, key string")
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 0.5, "k") for r in rows], schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    p = " ".join(f"w{i}" for i in range(60))
    return [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "Ab " * 40), (6, "aB " * 40),
            (7, p), (8, "other " + p + " end"), (9, p.upper()), (9, p.upper()), (None, p),
            (10, "\x00\x00 é ÉÀ ß " * 20), (11, "a"), (12, "A"), (13, p.replace("w30", "x"))]


def test_registered_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in registry.ORACLE.items():
        df = registry.QUERIES[name](spark, SF_SMALL)
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        got = sorted(repr(tuple(str(r[c]) for c in names)) for r in df.collect())
        want = sorted(repr(tuple(str(x) for x in r)) for r in res.fetchall())
        assert sorted(df.columns) == sorted(names) and got == want, name


# -- op1 ---------------------------------------------------------------------------------------
def test_suffix_dedup_matches_brute_force(spark):
    want = brute.byte_repeats(brute.table(SF_SMALL, "documents", "doc_id, text"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in registry.QUERIES["op1_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == want


def test_suffix_dedup_odd(spark, odd):
    out = suffix_dedup.suffix_dedup(docs_of(spark, odd)).collect()
    assert len(out) == len(odd)
    rows = sorted([(i if i is not None else 1 << 62, t) for i, t in odd],
                  key=lambda r: (r[0], r[1] or ""))
    # rows of one id are told apart by their place
    want = brute.byte_repeats([(k, t) for k, (_, t) in enumerate(rows)])
    assert sorted(hashlib.sha256(r.kept).hexdigest() for r in out) == sorted(w[3] for w in want.values())
    for r in out:
        assert r.n_bytes == len(r.kept) + sum(s.end - s.start for s in r.spans)
    assert suffix_dedup.suffix_dedup(docs_of(spark, [])).count() == 0


def test_suffix_family_against_a_set():
    rnd = random.Random(4)
    family = suffix_dedup.SuffixFamily(width=6, batch=64)
    seen = set()
    for _ in range(60):
        strings = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 40)))
                   for _ in range(rnd.randint(1, 9))]
        for s, mask in zip(strings, family.add(strings)):
            for k in range(max(0, len(s) - 5)):
                assert mask[k] == (s[k:k + 6] in seen)
                seen.add(s[k:k + 6])
    sizes = [len(x) for x in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(seen)


# -- op9 ---------------------------------------------------------------------------------------
def test_superkmers_match_brute_force(spark):
    want = brute.word_repeats(brute.table(SF_SMALL, "documents", "doc_id, text"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in registry.QUERIES["op9_superkmer_dedup"](spark, SF_SMALL).collect()}
    assert got == want


def test_superkmers_odd(spark, odd):
    out = superkmers.substring_dedup(docs_of(spark, odd), keep=("score",)).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(out) == len(odd) and all(r.score == 0.5 for r in out)
    assert by_id[1][0].kept is None and by_id[2][0].kept == "" and by_id[4][0].kept == LONG
    assert by_id[7][0].n_removed == 0 and by_id[8][0].kept == "other end"
    assert [r.n_removed for r in by_id[9]] == [0, 0]  # one document: nothing lost to itself
    assert by_id[None][0].n_removed == 60
    assert superkmers.substring_dedup(docs_of(spark, [])).count() == 0


# -- op6 ---------------------------------------------------------------------------------------
def test_exact_dedup_odd(spark, odd):
    out = exact_dedup.decisions(docs_of(spark, odd)).collect()
    assert len(out) == len(odd)
    keep = {r.id: r.keep_id for r in out}
    assert keep[1] == keep[2] == 2 and keep[5] == keep[6] == 6 and keep[11] == 12
    assert keep[7] == keep[9] == keep[None] == 9
    assert sorted(r.kept for r in out if r.id == 9) == [False, True]
    kept = exact_dedup.kept_documents(docs_of(spark, odd))
    assert kept.columns == docs_of(spark, odd).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 8, 9, 10, 12, 13]
    assert exact_dedup.decisions(docs_of(spark, [])).count() == 0
    assert exact_dedup.decisions(spark.createDataFrame([(None, "x")], "doc_id long, text string")
                                 ).first().kept


def test_exact_dedup_survives_digest_collisions(spark, odd):
    def poor(c):
        return F.encode(F.length(c).cast("string"), "utf-8")
    rows = [(i, t) for i, t in enumerate(["aa", "bb", "AA", "c", "bb", None, ""])]
    out = {r.id: (r.keep_id, r.group_size) for r in
           exact_dedup.decisions(docs_of(spark, rows), digest=poor).collect()}
    assert out == {0: (2, 2), 2: (2, 2), 1: (4, 2), 4: (4, 2), 3: (3, 1), 5: (6, 2), 6: (6, 2)}


# -- op7 ---------------------------------------------------------------------------------------
def test_jaccard_join_matches_brute_force(spark):
    want = brute.jaccard_components(brute.table(SF_SMALL, "documents", "doc_id, text"))
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in registry.QUERIES["op7_jaccard_join"](spark, SF_SMALL).collect()}
    assert got == want


def test_sketches_lose_no_similar_pair():
    rng = np.random.default_rng(7)
    sets, near, far = [], 0, 0
    for n in (1, 2, 9, 80, 90, 300, 345, 1400, 9000):  # similar pairs of unlike sketch lengths too
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        for change in (0, 0.05, 0.1, 0.112, 0.2, 0.6):
            other = base.copy()
            k = int(n * change)
            other[:k] = rng.integers(0, 2**63, k, dtype=np.uint64)
            more = rng.integers(0, 2**63, int(n * rng.choice([0, 0.05])), dtype=np.uint64)
            sets.append((np.unique(base), np.unique(np.concatenate((other, more)))))
    for a, b in sets:
        shared = len(np.intersect1d(a, b))
        similar = 100 * shared >= 80 * (len(a) + len(b) - shared)
        size_a, size_b = np.array([len(a)]), np.array([len(b)])
        may = jaccard_join.may_be_similar(jaccard_join.sketch(a)[None], jaccard_join.sketch(b)[None],
                                          size_a, size_b, 80)[0]
        assert may or not similar
        near, far = near + similar, far + (not may)
    assert near > 20 and far > 10


def test_pivot_pairs_are_all_pairs(monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS_AT_ONCE", 7)
    s, e = np.array([0, 1, 3, 13]), np.array([1, 3, 13, 30])
    want = [(i, j) for a, b in zip(s, e) for i in range(a, b) for j in range(i + 1, b)]
    got = [(int(p), int(q)) for first, last in ((0, 8), (8, jaccard_join.EVERY_PIVOT))
           for ps, qs in jaccard_join._pivot_pairs(s, e, first, last) for p, q in zip(ps, qs)]
    assert sorted(got) == sorted(want)


def _families(rng, n_families=12, most=14):
    """Sets in families around a base, at all distances about the limit, with shared features."""
    sets, common = [], rng.integers(0, 2**63, 40, dtype=np.uint64)
    for _ in range(n_families):
        base = rng.integers(0, 2**63, int(rng.choice([3, 12, 60, 250])), dtype=np.uint64)
        for _ in range(int(rng.integers(1, most))):
            other = base.copy()
            k = rng.integers(0, len(base), int(len(base) * rng.choice([0, 0.04, 0.08, 0.11, 0.14])))
            other[k] = rng.integers(0, 2**63, len(k), dtype=np.uint64)
            some = rng.choice(common, int(rng.choice([0, 0, 3])))
            sets.append(np.unique(np.concatenate((other, some))))
    return list({s.tobytes(): s for s in sets}.values())


def test_linked_sets_are_the_components_of_all_links(monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS_AT_ONCE", 64)
    linked = 0
    for seed in range(12):
        sets = _families(np.random.default_rng(seed))
        owner, mark = jaccard_join.signatures(sets)
        group = jaccard_join.connected(owner, mark, len(sets))
        order = np.argsort(group, kind="stable")
        sets, group = [sets[i] for i in order], group[order]
        want = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and want[i] != want[j]:
                    want = [want[j] if x == want[i] else x for x in want]
                    linked += 1
        got = jaccard_join.linked_sets(sets, group).tolist()
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))
    assert linked > 100


def test_signature_groups_leave_a_bucket_as_one_edge_a_node(spark):
    """A family of near copies, each unlike the others in its own way: pairs of its signatures would
    grow with the square of its size."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(400):
        words = list(base)
        for _ in range(3):
            words[rnd.randrange(120)] = f"x{k}-{rnd.random()}"
        rows.append((" ".join(words),))
    texts = spark.createDataFrame(rows, "text string").repartition(2)
    frequent = spark.sparkContext.broadcast(np.zeros(0, np.uint64))
    edges = jaccard_join.candidate_groups(texts, 8, frequent).collect()
    assert len(edges) < 2 * 400
    nodes = {e.a for e in edges} | {e.b for e in edges}
    assert len(nodes) > 380


def test_large_groups_give_the_same_components(spark, monkeypatch):
    rnd = random.Random(5)
    rows = []
    for f in range(6):
        base = [f"f{f}w{i}" for i in range(90)]
        for k in range(12):
            words = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3])):
                words[rnd.randrange(90)] = f"x{rnd.random()}"
            rows.append((100 * f + k, " ".join(words)))
    want = brute.jaccard_components(rows)
    for features in (jaccard_join.GROUP_FEATURES, 500, 0):  # none, some, all groups are large
        monkeypatch.setattr(jaccard_join, "GROUP_FEATURES", features)
        out = jaccard_join.jaccard_join(docs_of(spark, rows)).collect()
        assert {r.id: (r.n_shingles, r.component_id) for r in out} == want


def test_jaccard_join_odd_and_chains(spark, odd):
    rnd = random.Random(2)
    base = [f"t{i}" for i in range(400)]
    rows, text = [r for r in odd if r[0] != 9], list(base)
    for k in range(25):  # a chain: neighbours are similar, the ends are not
        rows.append((100 + k, " ".join(text)))
        for _ in range(6):
            text[rnd.randrange(400)] = f"n{k}-{rnd.random()}"
    want = brute.jaccard_components([r for r in rows if r[0] is not None])
    out = jaccard_join.jaccard_join(docs_of(spark, rows)).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in out if r.id is not None} == want
    assert [r.component_id for r in out if r.id is None] == [None]
    assert jaccard_join.jaccard_join(docs_of(spark, [])).count() == 0


def test_similar_sets_share_a_signature():
    """Pairs that differ as much as they may, with none to all of their features frequent."""
    rng = np.random.default_rng(3)
    for t in range(400):
        n = int(rng.integers(2, 60)) if t % 2 else int(rng.integers(30, 900))
        a = np.unique(rng.integers(0, 2**62, n).astype(np.uint64) * np.uint64(2))
        b = rng.choice(a, len(a) - int(rng.integers(0, len(a) // 5 + 1)), replace=False)
        more = 0
        while 100 * len(b) >= 80 * (len(a) + more + 1):
            more += 1
        b = np.unique(np.concatenate((b, rng.integers(0, 2**62, more).astype(np.uint64) * np.uint64(2)
                                      + np.uint64(1))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        frequent = np.sort(rng.choice(a, int(len(a) * rng.choice([0, 0.3, 0.9, 1])), replace=False))
        owner, mark = jaccard_join.signatures([a, b], 80, frequent)
        assert set(mark[owner == 0]) & set(mark[owner == 1])


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [
        (1000 + i, 1001 + i) for i in range(30)]
    parent = {}

    def root(i):
        while parent.get(i, i) != i:
            i = parent[i]
        return i
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.label for r in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    assert got == {x: root(x) for x in nodes if root(x) != x}


# -- op10, op3 ---------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_vocabulary())


def test_bpe_matches_library(spark, library, odd):
    codec = bpe.WordBpe(bpe.load(bpe.default_vocabulary()))
    texts = [t or "" for _, t in brute.table(SF_SMALL, "documents", "doc_id, text")]
    texts += [t or "" for _, t in odd] + [
        "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|>c's", "x" * 3000,
        "ab" * 2000 + "'s", "I'VE it's 'S 'd", "ΣΑΣ ΟΔΟΣ İ", "a\x1cb \x1f c", "é ẛ̣",
        "<|ENDOFTEXT|>", "4５６ ½²", "Ᲊx y՘z"]
    texts += [chr(c) + "a " + chr(c) for c in range(1, 0x3000)]
    want = library.encode_batch(texts, add_special_tokens=False)
    got = codec.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]
    for g, w in list(zip(got, want))[:300]:
        assert codec.decode(g) == library.decode(w.ids, skip_special_tokens=False)
    short = [t for t in texts if len(t) < 400][:200]
    long_way = bpe.WordBpe(bpe.load(bpe.default_vocabulary()))
    for w in {w for t in short for w in long_way.pattern.findall(bpe.normal(t))}:
        raw = np.frombuffer(w.encode(), np.uint8)
        parts = long_way.t["inner"][raw]
        parts[-1] = long_way.t["last"][raw[-1]]
        codec.learn([w])
        assert long_way.merge_long(parts).astype("<u4").tobytes() == codec.words[w]


def test_bpe_of_marks_that_character_tables_disagree_on(library):
    """Any marks in any order, some unknown to the library, some to Python."""
    rnd, codec = random.Random(9), bpe.WordBpe(bpe.load(bpe.default_vocabulary()))
    marks = [chr(c) for c in range(0x300, 0x20000) if unicodedata.category(chr(c))[0] in "MC" and not 0xD800 <= c < 0xE000]
    texts = ["\u1ac0\u0301", "a\u0301\u1ac0 b"] + ["".join(
        rnd.choice(["a", "É", "Σ", " ", "İ", rnd.choice(marks), rnd.choice(marks)]) for _ in range(rnd.randint(1, 9)))
        for _ in range(6000)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == want


def test_bpe_tables(spark, library, odd):
    docs = docs_of(spark, odd)
    ids = bpe.encode(docs)
    got = sorted((r.doc_id or 0, list(r.ids)) for r in ids.collect())
    want = sorted((i or 0, library.encode(t or "", add_special_tokens=False).ids) for i, t in odd)
    assert got == want
    texts = {r.doc_id: r.text for r in bpe.decode(ids).collect()}
    assert texts[8] == library.decode(library.encode(odd[7][1], add_special_tokens=False).ids,
                                      skip_special_tokens=False)
    q = {r.doc_id: r for r in registry.QUERIES["op10_bpe"](spark, SF_SMALL).limit(20).collect()}
    for i, t in brute.table(SF_SMALL, "documents", "doc_id, text"):
        if i in q:
            e = library.encode(t or "", add_special_tokens=False).ids
            assert q[i].n_tokens == len(e)
            assert q[i].ids_sha256 == hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()
    assert bpe.encode(docs_of(spark, [])).count() == 0


def check_packing(pieces, ids_of):
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(by_doc) == set(ids_of)
    for i, ids in ids_of.items():
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == brute.crc(ids[at:at + p.length])
            at += p.length
        assert at == len(ids)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by_seq)


def test_packing(spark, odd):
    codec = bpe.WordBpe(bpe.load(bpe.default_vocabulary()))
    docs = brute.table(SF_SMALL, "documents", "doc_id, text")
    ids = {i: np.frombuffer(codec.encode([t or ""])[0], "<u4").tolist() + [1] for i, t in docs}
    n = check_packing(registry.QUERIES["op3_packing"](spark, SF_SMALL).collect(), ids)
    assert n <= 1.02 * sum(map(len, ids.values())) / packing.CAPACITY + 1
    rows = [r for r in odd if r[0] not in (9, None)]
    ids = {i: np.frombuffer(codec.encode([t or ""])[0], "<u4").tolist() + [1] for i, t in rows}
    placed = packing.pack(docs_of(spark, rows))
    check_packing(placed.withColumnRenamed("id", "doc_id").collect(), ids)
    seqs = packing.sequences(docs_of(spark, rows), placed).collect()
    assert sum(r.n_ids for r in seqs) == sum(map(len, ids.values()))
    assert all(len(r.ids) == packing.CAPACITY for r in seqs)
    assert packing.pack(docs_of(spark, odd)).filter("id = 9").count() == 2
    assert packing.pack(docs_of(spark, [])).count() == 0


def test_best_fit_equals_the_sequential_form():
    import bisect
    rnd = random.Random(6)
    for _ in range(150):
        capacity = rnd.choice([5, 10, 33, 64])
        sizes = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 200))]
        bins, n_bins = [], 0
        for size in sorted(sizes, reverse=True):
            i = bisect.bisect_left(bins, size)
            left = bins.pop(i) if i < len(bins) else capacity
            n_bins += i == len(bins) and left == capacity
            bisect.insort(bins, left - size)
        fill = {}
        for size, _, each, first, _, n in packing.best_fit(
                {s: sizes.count(s) for s in set(sizes)}, capacity).tolist():
            for j in range(n):
                fill[first + j // each] = fill.get(first + j // each, 0) + size
        assert sorted(capacity - x for x in fill.values()) == sorted(bins)


# -- op4 ---------------------------------------------------------------------------------------
def test_quality_held_out(spark):
    labels = {i: q for i, q in brute.table("/root/testdata/sf0.01", "labels", "doc_id, quality")}
    out = registry.QUERIES["op4_quality_knn"](spark, "/root/testdata/sf0.01").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.held_out == quality_knn.held_out(r.doc_id) for r in out)
    fresh = [r for r in out if r.held_out and r.doc_id in labels]
    assert len(fresh) > 40
    assert np.mean([r.predicted == labels[r.doc_id] for r in fresh]) >= 0.95


def test_quality_odd(spark, odd):
    docs = docs_of(spark, odd)
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in odd if i] + [(4, None, None), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    tables = quality_knn.fit(docs, labels)
    out = quality_knn.classify(docs, tables).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    none = quality_knn.fit(docs, labels.limit(0))
    assert {r.score for r in quality_knn.classify(docs, none).collect()} == {0.5}
    assert quality_knn.classify(docs_of(spark, []), tables).count() == 0


def test_quality_scores_match_brute_force(spark):
    """Neighbour by neighbour, for every document of the small table."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    t = quality_knn.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), sample=50)
    assert len(t["labels"]) == 50
    texts = brute.table(SF_SMALL, "documents", "doc_id, text")
    got = {r.doc_id: r.score for r in quality_knn.classify(docs, t).collect()}
    for i, text in texts:
        x, empty = quality_knn.features(pa.array([text or ""]))
        v = (x[0] * t["weight"] - t["mean"]) @ t["axis"]
        cosines = [float(v @ s) / max(float(np.linalg.norm(v)), 1e-12) for s in t["sample"]]
        best = sorted(range(50), key=lambda j: -cosines[j])[:quality_knn.NEIGHBOURS]
        w = [max(cosines[j], 0.0) ** 2 for j in best]
        vote = (sum(a * t["labels"][j] for a, j in zip(w, best)) + 0.1 * t["base"]) / (sum(w) + 0.1)
        assert got[i] == pytest.approx(t["base"] if empty[0] else vote, abs=2e-3)


def test_quality_sample_has_each_id_once(spark):
    """Repeated documents change neither the sample nor its share of labels."""
    docs = spark.createDataFrame([(i, f"text number {i} " * 9) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    one = quality_knn.fit(docs, labels, sample=200)
    three = quality_knn.fit(docs.unionByName(docs).unionByName(docs), labels, sample=200)
    assert len(three["labels"]) == 200 and three["labels"].tolist() == one["labels"].tolist()
    assert 0.35 < three["base"] < 0.65


# -- op5 ---------------------------------------------------------------------------------------
def brute_top(rows, every, k, scale):
    ok = {i: np.floor(scale * np.array(v, float)).astype(int) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(v).all()}
    out = {}
    for q, v in ok.items():
        if q % every == 0:
            s = sorted((-int(v @ w), i) for i, w in ok.items() if i != q and len(w) == len(v))
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


@pytest.mark.parametrize("n, dim, k", [(900, 5, 7), (60, 3, 100)])
def test_top_k(spark, monkeypatch, n, dim, k):
    monkeypatch.setattr(dual_tree, "DATA_BLOCK", 150)
    monkeypatch.setattr(dual_tree, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(n)
    rows = [(i, (rng.normal(size=dim) * rng.choice([0.1, 1, 3])).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(60)]  # many equal vectors
    rows += [(5000, None), (5001, []), (5002, [None] * dim), (5003, [float("nan")] * dim),
             (None, [1.0] * dim), (5004, [float("inf")] + [0.0] * (dim - 1)), (5020, [1.0] * (dim + 1))]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows + rows[:3]],
                                  "vec_id long, embedding array<double>, id int, block int")
    got = {}
    for r in dual_tree.top_k(table, 20, k, 64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r["id"], r.score))
    got = {q: [(i, s) for _, i, s in sorted(v)] for q, v in got.items()}
    assert got == {q: v for q, v in brute_top(rows, 20, k, 64).items() if v}
    assert dual_tree.top_k(table.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e5, 3e6, 1e12, 1e16])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(int(size) % 97)
    rows = [(i, (rng.normal(size=5) * size).tolist()) for i in range(120)]
    rows += [(200 + i, [x + j / 64 for j, x in enumerate(rows[i][1])]) for i in range(40)]  # near ties
    rows += [(400, [1e300] + [0.0] * 4), (420, [-1e19] + [1.0] * 4)]  # beyond a long: take no part
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if i < 400}
    want = set()
    for q in (i for i in whole if i % 20 == 0):
        found = sorted((-min(max(sum(a * b for a, b in zip(whole[q], v)), -2**63 + 1), 2**63 - 1), i)
                       for i, v in whole.items() if i != q)[:7]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    assert {tuple(r) for r in dual_tree.top_k(table, 20, 7, 64).collect()} == want


def test_cover_tree_radii_shrink():
    rng = np.random.default_rng(3)
    centres = np.repeat(rng.normal(size=(30, 16)) * 400, 100, axis=0)
    tree = dual_tree.build(np.rint(centres + rng.normal(size=(3000, 16)) * 20), np.arange(3000))
    nodes, radius = tree["nodes"], tree["radius"]
    inner = np.flatnonzero(nodes[:, 3])
    assert len(inner)
    for i in inner:
        kids = slice(nodes[i, 2], nodes[i, 2] + nodes[i, 3])
        assert (radius[kids] <= radius[i] / dual_tree.BASE).all()
    assert sorted(tree["ids"]) == list(range(3000))


def test_search_prunes():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 6)) * 500
    points = np.rint(np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 6)))
    data = dual_tree.build(points, np.arange(2000))
    queries = dual_tree.build(points[::4], np.arange(0, 2000, 4))
    best = dual_tree.Best(queries["ids"], 5)
    met = dual_tree.search(queries, data, best)
    leaves = (data["nodes"][:, 3] == 0).sum() * (queries["nodes"][:, 3] == 0).sum()
    assert met < leaves / 2
    for q, ids in zip(queries["ids"], best.id):
        s = points @ points[q]
        s[q] = -np.inf
        assert list(ids) == list(np.lexsort((np.arange(2000), -s))[:5])


# -- op8, op2 ----------------------------------------------------------------------------------
def test_sharding_odd_and_growth(spark, odd):
    out = sharding.shard(docs_of(spark, odd), [1, 2, 0, 1]).collect()
    assert len(out) == len(odd) and {r.shard for r in out} <= {0, 1, 3}
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert all(r.grown_shard in (r.shard, 4) for r in out)
    assert {r.size for r in out if r.id in (1, 2)} == {1}
    many = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    n = {r.shard: r["count"] for r in sharding.shard(many, [1, 1, 2]).groupBy("shard").count().collect()}
    assert abs(n[2] - 4000) < 250 and abs(n[0] - 2000) < 200
    assert sharding.shard(docs_of(spark, []), [1, 1]).count() == 0


def test_url_filter_odd(spark):
    from datetime import date
    d = date(2024, 1, 1)
    rows = [(1, "https://a.b.com/x?q", date(2024, 1, 5)), (2, "https://b.com/", date(2024, 1, 20)),
            (3, None, date(2024, 1, 5)), (4, "nonsense", d), (5, "http://B.com:80/z#f", None),
            (6, "https://u@c.org/p", date(2024, 3, 1)), (6, "https://u@c.org/p", date(2024, 3, 1))]
    captures = spark.createDataFrame([(*r, "x") for r in rows],
                                     "page_id long, url string, fetch_date date, key string")
    entries = spark.createDataFrame([
        ("l1", "domain", "b.com", "add", date(2024, 1, 2)), ("l1", "domain", "b.com", "add", date(2024, 1, 3)),
        ("l1", "domain", "b.com", "remove", date(2024, 1, 10)), ("l2", "url", "https://a.b.com/x", "add", d),
        ("l1", "domain", "c.org", "add", date(2024, 2, 1)), ("l1", "domain", "c.org", "remove", date(2024, 2, 1)),
        (None, "domain", "c.org", "add", d)],
        "list_name string, kind string, pattern string, action string, effective date")
    out = {r.id: r for r in url_filter.url_filter(captures, entries).collect()}
    assert (out[1].n_entries, out[1].lists, out[1].pattern) == (2, "l1,l2", "https://a.b.com/x")
    assert [i for i, r in out.items() if r.blocked] == [1]
    assert url_filter.url_filter(captures, entries).count() == len(rows)
    assert url_filter.url_filter(captures.limit(0), entries).count() == 0
    assert url_filter.url_filter(captures, entries.limit(0)).filter("blocked").count() == 0
