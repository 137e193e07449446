"""Phrases, filter audit and SentencePiece codec against plain versions, and on awkward rows."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL
from test_llm_operators import LONG, docs_of, odd  # noqa: F401
from vigil.llm import collocations, filter_audit, pieces, registry

UPPER = {c: c + 32 for c in range(65, 91)}


# -- op11 --------------------------------------------------------------------------------------
def phrases(docs, min_count=10, top=2000):
    """The contract, one text after the other: {(part, rank): (phrase, a, l, r, n, score)}."""
    f, n = defaultdict(Counter), Counter()
    for part, text in docs:
        part = "und" if part is None else part
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[part] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[part][tuple(words[i:i + k])] += 1
    out = {}
    for part, counts in f.items():
        often = {g: a for g, a in counts.items() if len(g) > 1 and a >= min_count}
        found = []
        for g, a in often.items():
            longer = [b for h, b in often.items() if len(h) == 3 and len(g) == 2 and g in (h[:2], h[1:])]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(1_000_000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (s, a, p, le, r) in enumerate(sorted(found)[:top], 1):
            out[part, rank] = (p.decode(), -a, le, r, n[part], -s)
    return out


def rows_of(df, part="part"):
    return {(r[part], r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def test_phrases_match_brute_force(spark):
    want = phrases(brute.table(SF_SMALL, "documents", "lang, text"))
    assert rows_of(registry.QUERIES["op11_collocations"](spark, SF_SMALL), "lang") == want


@pytest.mark.parametrize("period", [1, 2, 7, 10_000])
def test_phrases_of_random_texts(spark, period):
    rnd = random.Random(period)
    tokens = ["a", "B", "b", "the", "The", ".", "\n", " ", "\t", " . ", "x-y", "é", "É", "日本", "!", "#"]
    docs = [(rnd.choice(["en", "fr", None, "und", ""]),
             "".join(rnd.choice(tokens) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(0, 60))))
            for _ in range(120)]
    docs += [("en", None), ("en", ""), ("en", " .. "), ("en", "a the b " * 700), ("zz", "q " * 3000)]
    docs += [("fr", "one passage that many share and repeat without an end")] * 40
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("gram", F.lit("g"))
    want = phrases(docs, 3, 50)
    assert rows_of(collocations.collocations(df, min_count=3, top=50, period=period)) == want


def test_chunks_hold_every_word_once():
    texts = pa.array(["a b c d e f g h " * 50, "", None, "One, two. three", "x"])
    chunks, ends, starting, text_of = collocations.parse(texts.fill_null(""), 3)
    assert starting.sum() == 404 and list(text_of[ends]) == [0, 3, 4]
    words = [len(re.findall(rb"[^ \n]+", c)) for c in chunks.to_pylist()]
    assert [w - s for w, s in zip(words, starting)] == [0 if e else 2 for e in ends]


def test_copies_share_chunks(spark):
    text = " ".join(f"w{i}" for i in range(2000))
    df = spark.createDataFrame([("en", text)] * 30 + [("en", "x y " + text)], "lang string, text string")
    d = collocations.dictionary(df).collect()
    assert sum(r.n * r.starts for r in d) == 31 * 2000 + 2 and sum(r.starts for r in d) < 2200


def test_no_phrases(spark, odd):  # noqa: F811
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    df = docs_of(spark, odd).withColumn("lang", F.lit(None).cast("string"))
    assert rows_of(collocations.collocations(df)) == phrases([(None, t) for _, t in odd])


# -- op12 --------------------------------------------------------------------------------------
def audited(docs, labels):
    """The contract, filter after filter: {(part, order, step): counts}."""
    marks = defaultdict(lambda: [0, 0])
    for i, quality, toxic in labels:
        if i is not None:
            marks[i][0] |= quality == 1
            marks[i][1] |= toxic == 1
    least = {}
    for i, _, text in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, part, text in docs:
        t, text = text or "", text
        words = brute.WORD.findall(t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": t in least and (i is None or i > least[t])}
        rows.append((part or "", fails, marks[i] if i is not None else [0, 0]))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        totals = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                totals[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[0][f] for r in own) - len(gone),
                    sum(r[0][f] and sum(r[0].values()) == 1 for r in own),
                    sum(m[0] for _, m in gone), sum(m[1] for _, m in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(totals[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows(df, part="part"):
    return {(r[part], r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                                r.toxic_lost, r.shapley) for r in df.collect()}


def test_audit_matches_brute_force(spark):
    want = audited(brute.table(SF_SMALL, "documents", "doc_id, lang, text"),
                   brute.table(SF_SMALL, "labels", "doc_id, quality, toxic"))
    assert audit_rows(registry.QUERIES["op12_filter_audit"](spark, SF_SMALL)) == want


def test_audit_odd(spark, odd):  # noqa: F811
    rnd = random.Random(3)
    docs = [(i, rnd.choice(["a", None, ""]), t) for i, t in odd]
    docs += [(20 + i, "hot", "same text") for i in range(300)] + [(5, "b", "Ab " * 40), (None, "c", "only a null id")]
    docs += [(400 + i, "d", " ".join(f"v{k % (i + 1)}" for k in range(198 + i % 5))) for i in range(120)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in [*range(1, 40), 7, 7, None, None, 999]]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").withColumns(
        {"part": F.lit("x"), "mask": F.lit(1), "n": F.lit(2), "good": F.lit(3), "quality": F.lit(1)})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audit_rows(filter_audit.audit(filter_audit.failures(df, marks))) == audited(docs, labels)
    empty = filter_audit.failures(df.limit(0), marks)
    assert filter_audit.audit(empty).count() == 0


def test_path_counts():
    forward, backward = filter_audit.path_counts(5)
    assert forward[-1] == backward[0] == 120 and forward[0b00111] == 6 and backward[0b00111] == 2
    assert sum(w for _, f, w in filter_audit.edges(5) if f == 2) == 120
    with pytest.raises(ValueError):
        filter_audit.audit(None, "ABCDEFGHI")


# -- op13 --------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def processor():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_vocabulary())


def test_pieces_match_library(spark, processor, odd):  # noqa: F811
    docs = brute.table(SF_SMALL, "documents", "doc_id, text")
    got = {r.doc_id: r for r in registry.QUERIES["op13_sentencepiece"](spark, SF_SMALL).collect()}
    for i, text in docs:
        ids = processor.encode(text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(raw).hexdigest(),
            hashlib.sha256(processor.decode(ids).encode()).hexdigest())
    out = pieces.encode(docs_of(spark, odd))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r.doc_id, r.ids) for r in out.collect()], key=key) == sorted(
        [(i, processor.encode(t or "", add_bos=True, add_eos=True)) for i, t in odd], key=key)
    back = sorted([(r.doc_id, r.text) for r in pieces.decode(out).collect()], key=key)
    assert back == sorted([(i, t or "") for i, t in odd], key=key)
    assert pieces.encode(docs_of(spark, [])).count() == 0


def test_pieces_of_random_texts(processor):
    codec, rnd = pieces.codec(pieces.load(pieces.default_vocabulary())), random.Random(5)
    tokens = ["a", "the", " ", "  ", "    ", "▁", "\n", "\t", "é", "漢", "🙂", "́", "\0", "<s>", "</s>", "<0x0A>",
              "<unk>", "ing", "tion", "12", ",", " ", " ", "\U0010ffff"]
    texts = ["", " ", "   ", "x" * 700, " " * 90, LONG[:4000], "ab" * 500]
    texts += ["".join(rnd.choice(tokens) for _ in range(rnd.randint(0, 50))) for _ in range(2000)]
    ids, bounds = codec.encode(pa.array(texts))
    want = processor.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want
    assert codec.decode(ids, bounds) == [processor.decode(w) for w in want]
    codec.chunks.clear()  # the table may be emptied at any time
    assert codec.encode(pa.array(texts))[0].tolist() == ids.tolist()


def test_any_ids_decode_as_the_library_does(spark, processor):
    rnd = random.Random(6)
    lists = [[rnd.choice([rnd.randint(0, 31_999), rnd.randint(3, 258), 0, 1, 2, 259, 29_871])
              for _ in range(rnd.randint(0, 14))] for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in pieces.decode(df).collect()}
    assert got == {i: processor.decode(v) for i, v in enumerate(lists)}
    odd_ids = spark.createDataFrame([(1, None), (2, []), (3, [None, 10 ** 6, -1, 278])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(odd_ids).collect()} == {1: "", 2: "", 3: processor.decode([278])}


def test_pieces_across_markers_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.default_vocabulary(), "rb") as f:
        model.ParseFromString(f.read())
    model.pieces.add(piece="of▁the", score=-40_000.0, type=1)
    path = tmp_path / "across.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="across whitespace markers"):
        pieces.load(str(path))
