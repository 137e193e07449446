"""Operator 13: SentencePiece encoding and decoding with a table of distinct chunks.

A chunk is a run of whitespace markers with the characters up to the next marker. No piece of the
vocabulary holds a marker behind another character (``load`` refuses a vocabulary that does), so
no merge crosses a chunk's start. Texts are cut into chunks, each distinct chunk is segmented once
and its ids are joined back by the chunk's position.

The table belongs to a worker: it is filled from the distinct chunks of each record batch and
emptied when it holds ``CACHE`` chunks. Encoding is thus map-only; one table for all of the corpus
would send every occurrence of every chunk through two shuffles to save a segmentation that the
table of a worker pays once.

Segments follow the vocabulary's own rule: of all adjacent parts whose concatenation is a piece,
the best-scored ones merge first, from the left among equals; characters that are no piece become
their UTF-8 bytes. All chunks of one width merge together as rows of a matrix, chunks of more than
``SHORT`` characters with a heap over a linked list.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vigil.llm.common import batch, by_bytes, documents, flat

VOCABULARY = "piece_bpe_32k.model"
MARKER = "▁"
# Rows of the merge matrices are padded to these widths; longer chunks use the heap.
WIDTHS, SHORT = (4, 6, 8, 10, 13, 18), 32
# Chunks that a worker's table may hold (about 150 bytes each), and bytes of text cut at once.
CACHE, TEXT_BYTES = 700_000, 4 << 20
NO_RANK = np.int32(2**31 - 1)
# A part that is a character without a piece: this plus its code point.
UNKNOWN = 1 << 24
# Kinds of pieces in a vocabulary file (fixed values of its format).
NORMAL, UNKNOWN_PIECE, CONTROL, BYTE = 1, 2, 3, 6


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def load(path: str) -> dict:
    """Tables of a vocabulary file, a few MB that the file fixes: the piece of each character, pairs
    of pieces with rank and result, the surface of each id, ids of bytes, begin and end."""
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, train = model.normalizer_spec, model.trainer_spec
    kinds = np.array([p.type for p in model.pieces], np.int8)
    pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
    fits = (train.model_type == 2 and not train.treat_whitespace_as_suffix and train.byte_fallback
            and not norm.precompiled_charsmap and norm.add_dummy_prefix
            and not norm.remove_extra_whitespaces and norm.escape_whitespaces
            and not model.denormalizer_spec.precompiled_charsmap
            and set(kinds.tolist()) <= {NORMAL, UNKNOWN_PIECE, CONTROL, BYTE})
    if not fits or any(MARKER in p.lstrip(MARKER) for p in pieces):
        raise ValueError("a BPE vocabulary with byte fallback, without a normaliser's table, and "
                         "without pieces across whitespace markers is needed")
    char = np.full(0x110000, -1, np.int32)
    keys, scores, made = [], [], []
    for text, i in pieces.items():
        if len(text) == 1:
            char[ord(text)] = i
        for k in range(1, len(text)):
            a, b = text[:k], text[k:]
            # a half is a piece, or a character that has none
            left = pieces.get(a, UNKNOWN + ord(a) if k == 1 else -1)
            right = pieces.get(b, UNKNOWN + ord(b) if len(b) == 1 else -1)
            if left >= 0 and right >= 0:
                keys.append(left << 32 | right)
                scores.append(model.pieces[i].score)
                made.append(i)
    char[ord(" ")] = char[ord(MARKER)]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    _, rank = np.unique(-np.array(scores, np.float64), return_inverse=True)  # equal scores tie
    surface = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL
               else train.unk_surface.encode() if p.type == UNKNOWN_PIECE
               else p.piece.replace(MARKER, " ").encode() for p in model.pieces]
    sizes = np.array([len(s) for s in surface], np.int64)
    return {"char": char, "key": np.array(keys, np.int64)[order],
            "rank": rank[order].astype(np.int32), "made": np.array(made, np.int32)[order],
            "kind": kinds, "byte": np.array([i for i, k in enumerate(kinds) if k == BYTE], np.int32),
            "surface": np.frombuffer(b"".join(surface), np.uint8), "size": sizes,
            "at": np.cumsum(sizes) - sizes, "names": surface,
            "begin": np.array([train.bos_id], "<u4").tobytes(),
            "end": np.array([train.eos_id], "<u4").tobytes()}


def take_slices(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[0]:+sizes[0]], values[starts[1]:+sizes[1]], ... as one array."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _each_byte(error: UnicodeDecodeError):
    """One replacement character for each byte that is part of no character."""
    return "�", error.start + 1


class PieceCodec:
    """Encoder and decoder over the tables of ``load``."""

    def __init__(self, tables: dict):
        self.t = tables
        self.chunks: dict[bytes, bytes] = {}

    # -- one chunk ----------------------------------------------------------------------
    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of parts (NO_RANK: no piece) and the piece that it makes."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.t["key"], key)
        at[at == len(self.t["key"])] = 0
        return (np.where(self.t["key"][at] == key, self.t["rank"][at], NO_RANK),
                self.t["made"][at])

    def merge_rows(self, parts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Merge all rows of a matrix (-1 behind a row's end) until no pair is left. Returns the
        row numbers and the rows, in groups that ended together."""
        rows = np.arange(len(parts))
        rank, made = self.pairs(parts[:, :-1], parts[:, 1:])
        ended_rows, ended = [], []
        while len(rows):
            every = np.arange(len(rows))
            at = rank.argmin(axis=1) if parts.shape[1] > 1 else None
            over = (rank[every, at] == NO_RANK) if at is not None else np.ones(len(rows), bool)
            if over.any():
                ended_rows.append(rows[over])
                ended.append(parts[over])
                going = ~over
                rows, parts, rank, made = rows[going], parts[going], rank[going], made[going]
                if not len(rows):
                    break
                at, every = at[going], np.arange(len(rows))
            n, width = parts.shape
            parts[every, at] = made[every, at]
            keep = np.ones((n, width), bool)
            keep[every, at + 1] = False
            parts = parts[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[every, at] = False
            rank, made = (x[keep].reshape(n, width - 2) for x in (rank, made))
            for i, left in ((np.flatnonzero(at > 0), -1), (np.flatnonzero(at < width - 2), 0)):
                j = at[i] + left
                rank[i, j], made[i, j] = self.pairs(parts[i, j], parts[i, j + 1])
        return ended_rows, ended

    def merge_long(self, parts: np.ndarray) -> np.ndarray:
        """The same for one chunk of any length: a heap of (rank, place) over a linked list."""
        ids, n = parts.tolist(), len(parts)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        rank, made = self.pairs(parts[:-1], parts[1:])
        heap = [(int(rank[i]), int(i), ids[i], ids[i + 1], int(made[i]))
                for i in np.flatnonzero(rank != NO_RANK)]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and after[i] < n:
                a, b = ids[i], ids[after[i]]
                r, m = self.pairs(np.array([a]), np.array([b]))
                if r[0] != NO_RANK:
                    heapq.heappush(heap, (int(r[0]), i, a, b, int(m[0])))

        while heap:
            _, i, a, b, piece = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = piece, True, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            push(before[i])
        return np.array([x for x, g in zip(ids, gone) if not g], np.int32)

    def in_bytes(self, parts: np.ndarray) -> np.ndarray:
        """Characters without a piece as the ids of their UTF-8 bytes."""
        if (parts < UNKNOWN).all():
            return parts
        out = []
        for p in parts.tolist():
            out += (self.t["byte"][list(chr(p - UNKNOWN).encode())].tolist() if p >= UNKNOWN
                    else [p])
        return np.array(out, np.int32)

    def learn(self, chunks: list[bytes]) -> None:
        """Segment distinct chunks and put their ids into the table."""
        points = np.frombuffer(b"".join(chunks).decode().encode("utf-32-le"), np.uint32)
        parts = self.t["char"][points]
        parts = np.where(parts < 0, UNKNOWN + points.astype(np.int32), parts)
        raw, offsets = flat(pa.array(chunks, pa.large_binary()))
        starts_char = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        offsets = starts_char[offsets]
        sizes, low = np.diff(offsets), 0
        for high in (*WIDTHS, SHORT):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if not len(rows):
                continue
            place = np.arange(high)
            inside = place < sizes[rows][:, None]
            matrix = np.full((len(rows), high), -1, np.int32)
            matrix[inside] = parts[(offsets[rows][:, None] + place)[inside]]
            for at, done in zip(*self.merge_rows(matrix)):
                live = done >= 0
                raw, ends = done[live].tobytes(), (4 * np.cumsum(live.sum(axis=1))).tolist()
                for i, a, b in zip(rows[at].tolist(), [0, *ends], ends):
                    self.chunks[chunks[i]] = raw[a:b]
                for k in np.flatnonzero((done >= UNKNOWN).any(axis=1)).tolist():
                    self.chunks[chunks[rows[at[k]]]] = self.in_bytes(done[k][live[k]]).tobytes()
        for i in np.flatnonzero(sizes > SHORT).tolist():
            ids = self.merge_long(parts[offsets[i]:offsets[i] + sizes[i]])
            self.chunks[chunks[i]] = self.in_bytes(ids).tobytes()

    # -- texts --------------------------------------------------------------------------
    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text's ids), without begin and end."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), MARKER, " ")
        texts = pc.if_else(pc.equal(texts, ""), texts,
                           pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts,
                                                       pa.scalar(" ", pa.large_string())))
        raw, offsets = flat(texts)
        blank = raw == 0x20
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(start)
        bounds = np.concatenate((starts, [len(raw)])).astype(np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
        table = chunks.dictionary_encode()
        distinct, where = table.dictionary.to_pylist(), table.indices.to_numpy()
        if len(self.chunks) > CACHE:
            self.chunks.clear()
        new = [c for c in distinct if c not in self.chunks]
        if new:
            self.learn(new)
        segments = [self.chunks[c] for c in distinct]
        sizes = np.fromiter(map(len, segments), np.int64, len(segments)) // 4
        ids = np.frombuffer(b"".join(segments), np.int32)
        ends = np.cumsum(sizes[where])
        every = take_slices(ids, (np.cumsum(sizes) - sizes)[where], sizes[where])
        of_text = np.searchsorted(starts, offsets)
        return every, np.concatenate(([0], ends))[of_text]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each run of ids: surfaces one after the other, bytes put together, begin
        and end left out, and without the marker that every text is given in front."""
        t = self.t
        known = (ids >= 0) & (ids < len(t["size"]))
        if not known.all():
            bounds = np.concatenate(([0], np.cumsum(known)))[bounds]
            ids = ids[known]
        ids = ids.astype(np.int64)
        sizes = t["size"][ids]
        raw = take_slices(t["surface"], t["at"][ids], sizes)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        control = np.concatenate(([0], np.cumsum(t["kind"][ids] == CONTROL)))
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            while a < b and control[a + 1] > control[a]:
                a += 1
            while a < b and control[b] > control[b - 1]:
                b -= 1
            skip = int(a < b and sizes[a] > 0 and raw[ends[a]] == 0x20
                       and t["kind"][ids[a]] == NORMAL)
            if control[b] > control[a]:  # begin or end in between part the bytes beside them
                cuts = [a, *(a + np.flatnonzero(t["kind"][ids[a:b]] == CONTROL)).tolist(), b]
                text = "".join(raw[ends[i]:ends[j]].tobytes().decode(errors="each byte")
                               for i, j in zip(cuts[:-1], cuts[1:]))
                out.append(text[skip:])
            else:
                out.append(raw[ends[a] + skip:ends[b]].tobytes().decode(errors="each byte"))
        return out


def codec(tables: dict) -> PieceCodec:
    """The worker's codec for broadcast tables; its table of chunks outlives the task."""
    if "codec" not in tables:
        codecs.register_error("each byte", _each_byte)
        tables["codec"] = PieceCodec(tables)
    return tables["codec"]


def share(spark, path: str | None):
    return spark.sparkContext.broadcast(load(path or default_vocabulary()))


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", ends: bool = True) -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of every whole text, with the begin and end id unless
    ``ends`` is false. A null text is empty: it has these two only. Repeated rows are encoded as
    they come; an empty table gives no rows; other columns are not looked at. Special pieces
    written in a text are ordinary characters."""
    tables = share(docs.sparkSession, path)
    schema = pa.schema([("id", _arrow_id(docs, id_col)), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for rb in batches:
            for i, j in by_bytes(flat(rb.column(1))[1], TEXT_BYTES):
                c = codec(tables.value)
                ids, bounds = c.encode(rb.column(1).slice(i, j - i))
                one = [np.frombuffer(c.t[k], np.int32) if ends else np.zeros(0, np.int32)
                       for k in ("begin", "end")]
                out = [np.concatenate((one[0], ids[a:b], one[1]))
                       for a, b in zip(bounds[:-1], bounds[1:])]
                yield batch(schema, rb.column(0).slice(i, j - i), out)

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>")
            .withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``: the text of ``ids_col`` (array<int>). Null ids give the empty text;
    null and unknown ids within are left out."""
    tables = share(encoded.sparkSession, path)
    schema = pa.schema([("id", _arrow_id(encoded, id_col)), ("text", pa.string())])

    def run(batches):
        for rb in batches:
            for k in range(0, rb.num_rows, 256):
                part = rb.slice(k, 256)
                lists = [np.array([x for x in v or () if x is not None], np.int64)
                         for v in part.column(1).to_pylist()]
                bounds = np.concatenate(([0], np.cumsum([len(v) for v in lists])))
                texts = codec(tables.value).decode(np.concatenate(lists), bounds)
                yield batch(schema, part.column(0), texts)

    kind = encoded.schema[id_col].dataType.simpleString()
    return (encoded.select(id_col, ids_col).mapInArrow(run, f"id {kind}, text string")
            .withColumnRenamed("id", id_col))


def _arrow_id(df: DataFrame, id_col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[id_col].dataType)


def op13_sentencepiece(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    tables = share(spark, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        for rb in batches:
            for i, j in by_bytes(flat(rb.column(1))[1], TEXT_BYTES):
                c = codec(tables.value)
                ids, bounds = c.encode(rb.column(1).slice(i, j - i))
                begin, end, raw = c.t["begin"], c.t["end"], ids.astype("<u4").tobytes()
                digests = [hashlib.sha256(begin + raw[4 * a:4 * b] + end).hexdigest()
                           for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                texts = [hashlib.sha256(t.encode()).hexdigest() for t in c.decode(ids, bounds)]
                yield batch(schema, rb.column(0).slice(i, j - i), np.diff(bounds) + 2, digests,
                            texts)

    return docs.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
