"""Operator 10: BPE encoding and decoding with a contiguous rank array.

A short word is a row of part ids beside a row of the ranks of its adjacent pairs. The smallest
rank is looked for, its boundary is deleted from both rows, and the two neighbouring ranks are
looked up anew; this repeats until no pair has a rank. All distinct new words of one length go
through each step together as one matrix. Words beyond ``SHORT`` parts, for which repeated scans
would be quadratic, use a heap over a linked list instead. Texts are encoded whole, inside
map-only tasks; what is kept between texts is a bounded cache of words.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from vigil.llm.common import batch, by_bytes, documents, flat

VOCABULARY = "word_bpe_49k.json"
# Words of up to SHORT parts are merged by repeated scans, in matrices of these widths.
WIDTHS, SHORT = (6, 9, 13, 20), 48
# Entries of each word cache of a Python worker (about 200 bytes each).
CACHE = 700_000
# Bytes of texts that are encoded together: distinct new words are merged in one go.
TEXT_BYTES = 4 << 20
# Marks that are a word of their own behind letters.
PUNCTUATION = frozenset(".,;:!?")
NO_RANK = np.int32(2**31 - 1)
# White space as the vocabulary's own pattern library sees it (str.split also takes 0x1C-0x1F).
SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
SEPARATORS = "\x1c\x1d\x1e\x1f"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def load(path: str) -> dict:
    """Tables of a vocabulary file, ready to be broadcast (a few MB, fixed by the file): token
    strings by id, pair keys in order with their ranks and results, ids of single bytes inside
    and at the end of a word, special tokens and the word pattern."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    spec = json.loads(raw)
    model = spec["model"]
    vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = [""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in [*vocab.items(), *special.items()]:
        names[i] = token
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    made = np.array([vocab[a + b] for a, b in merges], np.int32)
    key = left << 32 | right
    order = np.argsort(key, kind="stable")
    symbols = byte_symbols()
    pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                   if p["type"] == "Split")
    bare = json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []})
    return {"names": names, "key": key[order], "rank": order.astype(np.int32), "made": made,
            "inner": np.array([vocab.get(s, -1) for s in symbols], np.int32),
            "last": np.array([vocab.get(s + end, -1) for s in symbols], np.int32),
            "special": special, "pattern": pattern, "spec": bare, "different": different(bare)}


_DIFFERENT: dict[str, frozenset] = {}


def normal(s: str) -> str:
    if not s.isascii():
        s = unicodedata.normalize("NFC", s).replace("Σ", "σ")  # no final sigma
    return s.lower()


def different(spec: str) -> frozenset:
    """Characters that the library's normaliser and Python's tables may treat differently, found by
    putting all of them through both: alone, taken apart into base and marks, and, for marks,
    beside a mark that sorts first and one that sorts last."""
    if spec not in _DIFFERENT:
        from tokenizers import Tokenizer
        known = [chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
        known = [c for c in known if not c.isspace()]
        tests = known + [unicodedata.normalize("NFD", c) for c in known if unicodedata.decomposition(c)[:1] not in ("", "<")]
        tests += [x for c in known if unicodedata.category(c)[0] == "M" for x in (c + "\u0334", "\u0345" + c)]
        library = Tokenizer.from_str(spec).normalizer.normalize_str("\x01".join(tests)).split("\x01")
        own = normal("\x01".join(tests)).split("\x01")
        _DIFFERENT[spec] = frozenset("".join(t for t, a, b in zip(tests, library, own, strict=True) if a != b))
    return _DIFFERENT[spec]


class WordBpe:
    """Encoder and decoder over the tables of ``load``."""

    def __init__(self, tables: dict):
        self.t = tables
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.pattern = regex.compile(tables["pattern"])
        names = sorted(map(regex.escape, tables["special"]), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(names) + ")") if names else None

    # -- merging ------------------------------------------------------------------------
    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of parts, NO_RANK where the vocabulary has no merge."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.t["key"], key)
        at[at == len(self.t["key"])] = 0
        return np.where(self.t["key"][at] == key, self.t["rank"][at], NO_RANK)

    def merge_short(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge all rows of a matrix of part ids, -1 behind the end of a word, to the end.
        Returns the rows in the order they finished, bounds, and the ids of all in that order."""
        rows, rank = np.arange(len(parts)), self.ranks(parts[:, :-1], parts[:, 1:])
        order, done_parts = [], []
        while len(rows):
            n, width = parts.shape
            every = np.arange(n)
            if width > 1:
                at = rank.argmin(axis=1)
                low = rank[every, at]
            else:
                at, low = np.zeros(n, np.int64), np.full(n, NO_RANK)
            done = low == NO_RANK
            if done.any():
                order.append(rows[done])
                done_parts.append(parts[done])
                rows, parts, rank, at, low = (x[~done] for x in (rows, parts, rank, at, low))
                n = len(rows)
                if not n:
                    break
                every = np.arange(n)
            parts[every, at] = self.t["made"][low]
            keep = np.ones((n, width), bool)
            keep[every, at + 1] = False  # the deleted boundary
            parts = parts[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[every, at] = False
            rank = rank[keep].reshape(n, width - 2)
            i = np.flatnonzero(at > 0)
            rank[i, at[i] - 1] = self.ranks(parts[i, at[i] - 1], parts[i, at[i]])
            i = np.flatnonzero(at < width - 2)
            rank[i, at[i]] = self.ranks(parts[i, at[i]], parts[i, at[i] + 1])
        sizes = np.concatenate([(p >= 0).sum(axis=1) for p in done_parts])
        flat_ids = np.concatenate([p[p >= 0] for p in done_parts])
        return np.concatenate(order), np.concatenate(([0], np.cumsum(sizes))), flat_ids

    def merge_long(self, parts: np.ndarray) -> np.ndarray:
        """The same for one word of any length: a heap of (rank, place) over a linked list."""
        ids = parts.tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.ranks(parts[:-1], parts[1:])
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)
        dead = [False] * n

        def push(i: int) -> None:
            j = nxt[i]
            if j < n:
                r = int(self.ranks(np.array([ids[i]]), np.array([ids[j]]))[0])
                if r != NO_RANK:
                    heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if dead[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i] = int(self.t["made"][r])
            dead[j] = True
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return np.array([x for x, d in zip(ids, dead) if not d], np.int32)

    def learn(self, words: list[str]) -> None:
        """Put the ids of distinct new words into the cache."""
        if not words:
            return
        raw, offsets = flat(pa.array(words, pa.string()))
        parts = self.t["inner"][raw]
        ends = offsets[1:] - 1
        parts[ends] = self.t["last"][raw[ends]]
        sizes = np.diff(offsets)
        if (parts < 0).any():  # bytes that the vocabulary does not know are dropped
            known = parts >= 0
            sizes = np.add.reduceat(known.astype(np.int64), offsets[:-1])
            parts = parts[known]
            offsets = np.concatenate(([0], np.cumsum(sizes)))
        low = 0
        for high in (*WIDTHS, SHORT):
            at = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(at):
                place = np.arange(high)
                inside = place < sizes[at][:, None]
                matrix = np.full((len(at), high), -1, np.int32)
                matrix[inside] = parts[(offsets[at][:, None] + place)[inside]]
                order, bounds, ids = self.merge_short(matrix)
                raw_ids, bounds = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
                for i, a, b in zip(at[order].tolist(), bounds[:-1], bounds[1:]):
                    self.words[words[i]] = raw_ids[a:b]
        for i in np.flatnonzero(sizes == 0).tolist():
            self.words[words[i]] = b""
        for i in np.flatnonzero(sizes > SHORT).tolist():
            ids = self.merge_long(parts[offsets[i]:offsets[i] + sizes[i]])
            self.words[words[i]] = ids.astype("<u4").tobytes()

    # -- texts --------------------------------------------------------------------------
    def learn_chunks(self, chunks: list[str]) -> None:
        """Put the ids of distinct new space-free chunks into the cache."""
        if len(self.words) > CACHE:
            self.words.clear()
        plain = chunks
        if self.special and any("<|" in c for c in chunks):
            plain = [c for c in chunks if not self.special.search(c)]
            for c in set(chunks).difference(plain):
                pieces = self.special.split(c)
                self.learn_missing([p for p in pieces if p and p not in self.t["special"]])
                self.chunks[c] = b"".join(
                    np.array([self.t["special"][p]], "<u4").tobytes() if p in self.t["special"]
                    else self.chunks[p] for p in pieces if p)
        joined = "\n".join(plain)
        if not joined.isascii():
            late = [c for c in set(joined) if c in self.t["different"] or unicodedata.category(c) == "Cn"]
            if late:  # other character tables than Python's: split by the library's own
                new_ones = regex.compile("[" + "".join(map(regex.escape, late)) + "]")
                for c in [c for c in plain if new_ones.search(c)]:
                    words = self.library_words(c)
                    self.learn([w for w in set(words) if w not in self.words])
                    self.chunks[c] = b"".join(self.words[w] for w in words)
                plain = [c for c in plain if not new_ones.search(c)]
                joined = "\n".join(plain)
        split = []
        for s in normal(joined).split("\n") if plain else ():
            if s.isalpha():
                split.append((s,))
            elif s[-1] in PUNCTUATION and s[:-1].isalpha():
                split.append((s[:-1], s[-1]))
            else:
                split.append(self.pattern.findall(s))
        words = self.words
        self.learn(list(set().union(*split).difference(words)))
        for c, s in zip(plain, split):
            self.chunks[c] = words[s[0]] if len(s) == 1 else b"".join([words[w] for w in s])

    def library_words(self, chunk: str) -> list[str]:
        """Words of a chunk with characters that Python's Unicode tables do not know or treat
        otherwise, by the normaliser and word splitter of the tokenizers library."""
        from tokenizers import Tokenizer
        whole = Tokenizer.from_str(self.t["spec"])
        text = whole.normalizer.normalize_str(chunk)
        return [text[a:b] for _, (a, b) in whole.pre_tokenizer.pre_tokenize_str(text)]

    def learn_missing(self, chunks) -> None:
        new = list(set(chunks).difference(self.chunks))
        if new:
            self.learn_chunks(new)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > CACHE:
            self.chunks.clear()
        get = self.chunks.get
        found, again = [], {}
        for i, t in enumerate(texts):
            chunks = self.split(t)
            parts = list(map(get, chunks))
            if None in parts:
                again[i] = chunks
            found.append(parts)
        if again:
            new: set[str] = set()
            for i, chunks in again.items():
                new.update([c for c, x in zip(chunks, found[i]) if x is None])
            self.learn_chunks(list(new))
            for i, chunks in again.items():
                found[i] = [x or get(c) for x, c in zip(found[i], chunks)]
        return [b"".join(parts) for parts in found]

    @staticmethod
    def split(text: str) -> list[str]:
        if any(c in text for c in SEPARATORS):
            return [c for c in SPACE.split(text) if c]
        return text.split()

    def decode(self, ids: bytes) -> str:
        """Token strings of the ids, joined by spaces; unknown ids are left out."""
        names = self.t["names"]
        numbers = np.frombuffer(ids, "<u4").tolist()
        if numbers and max(numbers) >= len(names):
            numbers = [i for i in numbers if i < len(names)]
        return " ".join(map(names.__getitem__, numbers))


def codec(tables: dict) -> WordBpe:
    """The worker's codec for broadcast tables; its caches outlive the task."""
    if "codec" not in tables:
        tables["codec"] = WordBpe(tables)
    return tables["codec"]


def share(spark, path: str | None):
    return spark.sparkContext.broadcast(load(path or default_vocabulary()))


def texts_of(rb: pa.RecordBatch):
    """(rows from, to, texts) over a batch whose second column is the text; null: empty."""
    _, offsets = flat(rb.column(1))
    for i, j in by_bytes(offsets, TEXT_BYTES):
        yield i, j, [t or "" for t in rb.column(1).slice(i, j - i).to_pylist()]


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of every whole text. A null text is empty and has no
    ids; repeated rows are encoded as they come; an empty table gives no rows; very long texts
    are encoded whole; other columns are not looked at. Special tokens written in a text become
    their ids, as the vocabulary's own library does it."""
    tables = share(docs.sparkSession, path)
    schema = pa.schema([("id", _arrow_id(docs, id_col)), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for rb in batches:
            for i, j, texts in texts_of(rb):
                out = [np.frombuffer(x, "<i4") for x in codec(tables.value).encode(texts)]
                yield batch(schema, rb.column(0).slice(i, j - i), out)

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>")
            .withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``: the token strings of ``ids_col`` (array<int>) joined by spaces,
    special tokens included. Null ids give the empty text, unknown ids are left out."""
    tables = share(encoded.sparkSession, path)
    schema = pa.schema([("id", _arrow_id(encoded, id_col)), ("text", pa.string())])

    def run(batches):
        for rb in batches:
            for k in range(0, rb.num_rows, 256):
                part = rb.slice(k, 256)
                out = [codec(tables.value).decode(np.array(x or [], "<u4").tobytes())
                       for x in part.column(1).to_pylist()]
                yield batch(schema, part.column(0), out)

    kind = encoded.schema[id_col].dataType.simpleString()
    return (encoded.select(id_col, ids_col).mapInArrow(run, f"id {kind}, text string")
            .withColumnRenamed("id", id_col))


def _arrow_id(df: DataFrame, id_col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[id_col].dataType)


def op10_bpe(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    tables = share(spark, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        for rb in batches:
            for i, j, texts in texts_of(rb):
                bpe = codec(tables.value)
                ids = bpe.encode(texts)
                yield batch(schema, rb.column(0).slice(i, j - i), [len(x) // 4 for x in ids],
                            [hashlib.sha256(x).hexdigest() for x in ids],
                            [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids])

    return docs.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
