"""Operator 7: Jaccard similarity join on word n-grams with PartEnum signatures.

Sets fall into bands of sizes, and similar sets lie in one band or in neighbouring ones. For each
band the feature domain is partitioned, and every part again into three subparts, of which each
two make a signature (their numbers and features). Two sets of a similar pair differ in at most H
features, and a set signs so many parts that H differences cannot spoil all of its signatures;
those left are signed alike by the partner. Pairs that share a signature are candidates, and the
sets themselves decide.

Candidates never become rows. Sets that signatures connect make a group; what leaves a block, and
then a bucket of signatures, is one edge a node, and no link crosses groups. A group's texts are
sent once, to the task that finds its components: a set is tested against the partners that its
signatures name and that are in other components, first by bitmaps, which bound what two sets can
share, then by the sets, until no pair across components is untested.

Groups of more than GROUP_FEATURES are too large for a task. In these the smallest member of each
signature is paired with the others (first inside each task, then between tasks). Only members of
signatures that are then still in several components go on, with the next members as pivots, until
no pair across components is untested. The components are in both cases those of all links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import (block_count, by_bytes, deal, documents, flat, materialize, mix,
                              runs, text_bytes)
from vigil.llm.components import components
from vigil.llm.repeats import arrow_schema
from vigil.llm.superkmers import word_hashes, words_of

N_WORDS = 5
PERCENT = 80
BAND_RATIO = 1.5
# Sets up to this size always sign single features too.
SMALL = 32
# Larger ones: features of a part on average at the band's upper end, and the least to be signed.
PER_PART, LEAST = 6.5, 2
# A feature is frequent if at least so large a share of all sets holds it; there are at most
# (average set size / FREQUENT) of them, whatever the input.
FREQUENT = 0.002
BLOCK = 4 << 20
# Features of a group whose components are found by one task (8 bytes each); larger groups take
# rounds of pivots over all tasks.
GROUP_FEATURES = 4 << 20
# Pivots of a group's second round; a last round takes all others.
PIVOTS, EVERY_PIVOT = 8, 1 << 30
# Bits of a sketch for each feature of a set (rounded up to a power of two), and the least.
SKETCH_BITS, LEAST_BITS = 3, 256
PAIRS_AT_ONCE = 1 << 16

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingle_sets(column, n_words: int = N_WORDS):
    """Sorted distinct 64-bit hashes of the word n-grams of each text, in order. A text of fewer
    words is one feature, its whole sequence; a text without words has none."""
    raw, offsets = flat(column)
    for i, j in by_bytes(offsets):
        part = LOWER[raw[offsets[i]:offsets[j]]]
        starts, ends, bounds = words_of(part, offsets[i:j + 1] - offsets[i])
        h = word_hashes(part, starts, ends)
        g = np.zeros(max(len(h) - n_words + 1, 0), np.uint64)
        for k in range(n_words):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(g)]
        g = mix(g)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= n_words:
                yield np.unique(g[a:b - n_words + 1])
            elif b > a:
                short = np.array([b - a], np.uint64)
                for x in h[a:b]:
                    short = short * np.uint64(0xC2B2AE3D27D4EB4F) + x
                yield mix(short)
            else:
                yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def differ(size_a: int, size_b: int, percent: int) -> int:
    """Most features in which two sets of these sizes differ if they are similar."""
    # both >= p / (100 + p) * (a + b), so a + b - 2 * both <= (100 - p) / (100 + p) * (a + b)
    return (100 - percent) * (size_a + size_b) // (100 + percent)


def band_tops(largest: int, percent: int) -> np.ndarray:
    """Upper ends of the bands of sizes, up to one that holds ``largest``. A similar set lies in
    the same band or a neighbouring one."""
    ratio, tops = max(BAND_RATIO, 100 / percent), [1]
    while tops[-1] < largest:
        tops.append(int(tops[-1] * ratio) + 1)
    return np.array([*tops, int(tops[-1] * ratio) + 1], np.int64)


def signatures(sets: list[np.ndarray], percent: int = PERCENT,
               frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, signature) of all sets; ``frequent``: sorted features that alone make no
    signature (any choice gives the same links; it only keeps unlike sets apart). Sets that can
    only be similar to equal ones sign nothing: equal sets are known to be one class."""
    owners, marks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    sizes = np.array([len(s) for s in sets], np.int64)
    if not len(sets) or not sizes.any():
        return owners[0], marks[0]
    rare = [np.ones(len(s), bool) for s in sets]
    if frequent is not None and len(frequent):
        rare = [frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] != s
                for s in sets]
    tops = band_tops(int(sizes.max()), percent)
    band = np.searchsorted(tops, sizes)
    largest = 100 * sizes // percent  # of a similar set
    for step in (0, 1):  # a set signs for its band, and for the next if a partner may be there
        for b in np.unique(band[sizes > 0]):
            top = int(tops[b + step])
            own = np.flatnonzero((band == b) & (sizes > 0)
                                 & ((step == 0) | (largest > tops[b])))
            limit = (100 - percent) * (sizes[own] + np.minimum(largest[own], top)) // (100 + percent)
            own, limit = own[limit > 0], limit[limit > 0]
            if len(own):
                o, m = _sign([sets[i] for i in own], [rare[i] for i in own], limit, top,
                             percent)
                owners.append(own[o])
                marks.append(m)
    return np.concatenate(owners), np.concatenate(marks)


def _sign(sets: list[np.ndarray], rare: list[np.ndarray], limit: np.ndarray, top: int,
          percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets of one band; at most ``limit`` features of each may differ.

    Every part has three subparts and signs each two of them, if these hold a rare feature and
    LEAST at all. To spoil all signatures of a part, a difference in one subpart (in two, if all
    three pairs can be signed) is needed: its cost. Parts are signed in order until their costs
    exceed ``limit``, so that some signature of a similar pair is not spoilt. A set whose parts
    cannot cost so much signs all of them, and for its like also the single features of which a
    similar set must hold one: the first ones with the rare before the frequent.
    """
    n = len(sets)
    n_parts = max(2, round(top / PER_PART))
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    x, uncommon = np.concatenate(sets), np.concatenate(rare)
    salt = np.array([top], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    cell = (mix(x + salt) % np.uint64(n_parts * 3)).astype(np.int64)
    key = owner * (n_parts * 3) + cell
    order = np.argsort(key, kind="stable")
    key = key[order]
    s, e = runs(key)
    content = np.add.reduceat(mix(x ^ salt)[order], s)  # order of the features does not matter
    few = np.add.reduceat(uncommon[order].astype(np.int64), s)
    row, sub = np.divmod(key[s], 3)
    first, _ = runs(row)
    at = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(row))))

    def pairs(values):  # of subparts: the sum of all but one
        out = np.zeros((len(first), 3), values.dtype)
        out[at, sub] = values
        return out.sum(axis=1, keepdims=True, dtype=out.dtype) - out

    good = (pairs(e - s) >= LEAST) & (pairs(few) > 0)
    part_owner, part = np.divmod(row[first], n_parts)
    name = (part[:, None] * 3 + np.arange(3)).astype(np.uint64)
    mark = mix(pairs(content) + mix(name + salt))
    each = good.any(axis=1).astype(np.int64) + good.all(axis=1)
    start = np.searchsorted(part_owner, np.arange(n))
    sofar = np.cumsum(each) - each
    before = sofar - sofar[start][part_owner]
    poor = np.bincount(part_owner, each, n) <= limit
    poor |= sizes <= SMALL
    keep = good & ((poor[part_owner]) | (before <= limit[part_owner]))[:, None]
    # single features of the poor sets: as many as a similar set may lack, and one
    mine = np.flatnonzero(poor[owner])
    mine = mine[np.lexsort((x[mine], ~uncommon[mine], owner[mine]))]
    begin = np.searchsorted(owner[mine], np.arange(n))
    place = np.arange(len(mine)) - begin[owner[mine]]
    may_lack = sizes - -(-percent * sizes // 100)
    single = mine[place <= may_lack[owner[mine]]]
    return (np.concatenate((np.repeat(part_owner, keep.sum(axis=1)), owner[single])),
            np.concatenate((mark[keep], mix(mix(x[single]) + salt))))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def set_classes(docs: DataFrame, n_words: int = N_WORDS) -> DataFrame:
    """(id, n, key, common): size and key of each row's set. Every block adds one row of n = -1
    whose ``common`` packs the features that several of its sets hold, with their numbers."""
    ddl = "id long, n long, key binary, common binary"
    schema = arrow_schema(ddl)

    def block(seen: dict) -> pa.RecordBatch:
        h = np.sort(np.concatenate([np.zeros(0, np.uint64), *seen.values()]))
        s, e = runs(h)
        often = e - s >= max(3, FREQUENT * len(seen))
        packed = np.stack((h[s][often], (e - s)[often].astype(np.uint64)), 1).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((None, -1, None, packed), schema)], schema=schema)

    def run(batches):
        seen, size = {}, 0
        for rb in batches:
            n, keys = [], []
            for s in shingle_sets(rb.column(1), n_words):
                n.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                if len(s) and keys[-1] not in seen:
                    seen[keys[-1]] = s
                    size += s.nbytes
                if size >= 4 * BLOCK:
                    yield block(seen)
                    seen, size = {}, 0
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.nulls(len(n), pa.binary())], schema=schema)
        if seen:
            yield block(seen)

    return docs.mapInArrow(run, ddl)


def frequent_features(classes: DataFrame, n_sets: int) -> np.ndarray:
    """Sorted features that about FREQUENT of all sets hold, by the counts of the blocks. Their
    number is bounded by the average size of a set divided by FREQUENT."""
    schema = arrow_schema("feature long, n long")

    def run(batches):
        for rb in batches:
            for x in rb.column(0).to_pylist():
                pair = np.frombuffer(x, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1])], schema=schema)

    counts = (classes.filter("n = -1").select("common").mapInArrow(run, "feature long, n long")
              .groupBy("feature").agg(F.sum("n").alias("n"))
              .filter(F.col("n") >= FREQUENT * n_sets).select("feature"))
    return np.sort(counts.toArrow().column(0).to_numpy().view(np.uint64))


def connected(owner: np.ndarray, mark: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest of its component; the owners of a mark are connected."""
    order = np.argsort(mark, kind="stable")
    s, e = runs(mark[order])
    several = e - s > 1
    node = owner[order][np.repeat(several, e - s)]
    length = (e - s)[several]
    label = np.arange(n)
    if not len(node):
        return label
    start = np.cumsum(length) - length
    while True:
        low = np.repeat(np.minimum.reduceat(label[node], start), length)
        new = label.copy()
        np.minimum.at(new, label[node], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def candidate_groups(texts: DataFrame, n_buckets: int, frequent, n_words: int = N_WORDS,
                     percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) whose components are those that common signatures make; a node is the start of
    a set's key (``_short``; two keys that start alike only make a group larger). ``texts``: one
    column. A block connects its own sets and sends each signature once, named by its component's
    smallest node; so does a bucket with what comes from the blocks."""
    send_ddl = "bucket int, marks binary, nodes binary, edge_a binary, edge_b binary"
    send_schema = arrow_schema(send_ddl)
    edge_schema = arrow_schema("a long, b long")

    def block(keys: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        owner, mark = signatures(sets, percent, frequent.value)
        node = np.array(keys, np.int64)
        by_node = np.argsort(node, kind="stable")  # the smallest of a component names it
        place = np.empty(len(node), np.int64)
        place[by_node] = np.arange(len(node))
        node, owner = node[by_node], place[owner]
        root = connected(owner, mark, len(node))
        moved = np.flatnonzero(root != np.arange(len(node)))
        mark, first = np.unique(mark, return_index=True)
        name = root[owner[first]]
        by_id = np.argsort(name, kind="stable")  # runs of one node compress well
        mark, name = mark[by_id], name[by_id]
        order, at = deal(((mark >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64), n_buckets)
        e_order, e_at = deal(moved % n_buckets, n_buckets)
        low = (mark & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cols: list[list] = [[] for _ in range(5)]
        for b in np.flatnonzero((np.diff(at) > 0) | (np.diff(e_at) > 0)):
            i, m = order[at[b]:at[b + 1]], moved[e_order[e_at[b]:e_at[b + 1]]]
            for c, x in zip(cols, (b, low[i].tobytes(), node[name[i]].tobytes(),
                                   node[m].tobytes(), node[root[m]].tobytes())):
                c.append(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, send_schema)], schema=send_schema)

    def send(batches):
        keys, sets, seen, size = [], [], set(), 0
        for rb in batches:
            for s in shingle_sets(rb.column(0), n_words):
                if len(s) < 2:  # equal sets are one class already
                    continue
                key = set_key(s)
                if key in seen:
                    continue
                seen.add(key)
                keys.append(int.from_bytes(key[:8], "big") >> 4)  # as _short
                sets.append(s)
                size += s.nbytes
                if size >= BLOCK:
                    yield block(keys, sets)
                    keys, sets, seen, size = [], [], set(), 0
        if sets:
            yield block(keys, sets)

    def meet(t: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)
        node, owner = np.unique(joined("nodes", np.int64), return_inverse=True)
        root = connected(owner, joined("marks", np.uint32), len(node))
        moved = np.flatnonzero(root != np.arange(len(node)))
        return pa.Table.from_arrays(
            [pa.array(np.concatenate((node[moved], joined("edge_a", np.int64)))),
             pa.array(np.concatenate((node[root[moved]], joined("edge_b", np.int64))))],
            schema=edge_schema)

    return (texts.mapInArrow(send, send_ddl).groupBy("bucket")
            .applyInArrow(meet, "a long, b long").distinct())


class Sets:
    """Sets side by side, with their sketches: which of many one set is similar to."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.size = np.array([len(s) for s in sets], np.int64)
        self.features = np.concatenate([np.zeros(0, np.uint64), *sets])
        self.start = np.cumsum(self.size) - self.size
        self.wide = sketch_bytes(self.size)
        self.drawn = np.concatenate([np.zeros(0, np.uint8), *map(sketch, sets)])
        self.where = np.cumsum(self.wide) - self.wide

    def similar(self, p: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that are similar to ``p``."""
        size, found = self.size, []
        small, big = np.minimum(size[others], size[p]), np.maximum(size[others], size[p])
        others = others[100 * small >= self.percent * big]
        mine = self.features[self.start[p]:self.start[p] + size[p]]
        drawn = self.drawn[self.where[p]:self.where[p] + self.wide[p]][None]
        for w in np.unique(self.wide[others]):
            same = others[self.wide[others] == w]
            ends = np.concatenate(([0], np.cumsum(size[same])))
            for i, j in by_bytes(ends, PAIRS_AT_ONCE * 4):
                q = same[i:j]
                theirs = self.drawn[self.where[q][:, None] + np.arange(w)]
                q = q[may_be_similar(np.repeat(drawn, len(q), axis=0), theirs,
                                     np.repeat(size[p], len(q)), size[q], self.percent)]
                if not len(q):
                    continue
                begin = np.cumsum(size[q]) - size[q]
                x = self.features[np.arange(size[q].sum()) + np.repeat(self.start[q] - begin, size[q])]
                hit = mine[np.minimum(np.searchsorted(mine, x), len(mine) - 1)] == x
                shared = np.add.reduceat(hit.astype(np.int64), begin)
                found.append(q[100 * shared >= self.percent * (size[p] + size[q] - shared)])
        return np.concatenate([others[:0], *found])


def linked_sets(sets: list[np.ndarray], group: np.ndarray, frequent: np.ndarray | None = None,
                percent: int = PERCENT) -> np.ndarray:
    """A number for the component of each set, by all links between them. ``group`` (sorted) names
    groups that no signature crosses.

    Sets take turns. One is tested against all sets of its signatures that are in other components
    and had no turn, then it is done. Signatures of one component only have nothing left to test.
    First comes the set in most signatures: the text that others are copies of. Then those of small
    components: every untested pair has one outside the largest. More take their turn from round to
    round, as signatures are looked through anew."""
    n = len(sets)
    label, done, step = np.arange(n), np.zeros(n, bool), 1
    if n < 2:
        return label
    at = Sets(sets, percent)
    members, marks = [], []
    for i, j in by_bytes(8 * np.concatenate(([0], np.cumsum(at.size))), BLOCK):
        o, m = signatures(sets[i:j], percent, frequent)
        members.append(o + i)
        marks.append(m)
    member, mark = np.concatenate(members), np.concatenate(marks)
    order = np.argsort(mark, kind="stable")
    member, mark = member[order], mark[order]
    low, high = np.searchsorted(group, group), np.searchsorted(group, group, "right")
    while True:
        member, mark = member[~done[member]], mark[~done[member]]
        s, e = runs(mark)
        if len(s):
            of = label[member]
            live = np.repeat(np.minimum.reduceat(of, s) != np.maximum.reduceat(of, s), e - s)
            member, mark = member[live], mark[live]
            s, e = runs(mark)
        if not len(s):
            return label
        often = np.bincount(member, minlength=n)
        node = np.flatnonzero(often)
        width = np.bincount(label[node], minlength=n)[label[node]] if step > 1 else np.zeros(len(node))
        node = node[np.lexsort((-often[node], width, group[node]))]
        first, last = runs(group[node])
        turn = node[np.arange(len(node)) - np.repeat(first, last - first) < step]
        run = np.repeat(np.arange(len(s)), e - s)[np.argsort(member, kind="stable")]
        own = np.concatenate(([0], np.cumsum(often)))
        for p in turn.tolist():
            q = np.concatenate([member[s[r]:e[r]] for r in run[own[p]:own[p + 1]].tolist()])
            q = q[(label[q] != label[p]) & ~done[q]]
            done[p] = True
            if len(q):
                near = label[at.similar(p, np.unique(q))]
                part = label[low[p]:high[p]]  # links stay in the group
                part[np.isin(part, near)] = label[p]
        step *= 2


def group_links(texts: DataFrame, frequent, n_words: int = N_WORDS,
                percent: int = PERCENT) -> DataFrame:
    """(a, b): set keys and another one of their component, for all but that one. ``texts``: cell,
    grp, key, text; a group is in one cell. Texts whose set has another key are left out."""
    schema = arrow_schema("a binary, b binary")

    def run(t: pa.Table) -> pa.Table:
        found = {}
        for k, g, s in zip(t.column("key").to_pylist(), t.column("grp").to_pylist(),
                           shingle_sets(t.column("text"), n_words)):
            if k not in found and len(s) and set_key(s) == k:
                found[k] = (g, s)
        keys = sorted(found, key=lambda k: (found[k][0], k))
        label = linked_sets([found[k][1] for k in keys],
                            np.array([found[k][0] for k in keys], np.int64), frequent.value, percent)
        star = [(k, keys[r]) for i, (k, r) in enumerate(zip(keys, label.tolist())) if i != r]
        return pa.Table.from_arrays([pa.array([x[c] for x in star], pa.binary()) for c in (0, 1)],
                                    schema=schema)

    return texts.groupBy("cell").applyInArrow(run, "a binary, b binary")


def candidates(docs: DataFrame, n_buckets: int, frequent, n_words: int = N_WORDS,
               percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of ids, smallest member and another one, of every signature's group.
    ``frequent``: broadcast sorted features."""
    send_ddl = "bucket int, marks binary, ids binary, pair_a binary, pair_b binary"
    send_schema = arrow_schema(send_ddl)
    pair_schema = arrow_schema("a long, b long")

    def block(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        owner, mark = signatures(sets, percent, frequent.value)
        ids_ = np.array(ids, np.int64)
        # one entry of a signature leaves the block; the others are paired with it here
        order = np.lexsort((ids_[owner], mark))
        mark, node = mark[order], ids_[owner][order]
        s, e = runs(mark)
        hub = np.repeat(node[s], e - s)
        pairs = np.unique(np.stack((hub, node), 1)[hub != node], axis=0)
        mark, node = mark[s], node[s]
        bucket = (mark >> np.uint64(32)) % np.uint64(n_buckets)
        by_id = np.argsort(node, kind="stable")  # runs of one id compress well
        mark, node, bucket = mark[by_id], node[by_id], bucket[by_id]
        order, at = deal(bucket.astype(np.int64), n_buckets)
        p_order, p_at = deal(np.arange(len(pairs)) % n_buckets, n_buckets)
        full = np.flatnonzero((np.diff(at) > 0) | (np.diff(p_at) > 0))
        low = (mark & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cols: list[list] = [[] for _ in range(5)]
        for b in full:
            i, p = order[at[b]:at[b + 1]], pairs[p_order[p_at[b]:p_at[b + 1]]]
            for c, x in zip(cols, (b, low[i].tobytes(), node[i].tobytes(), p[:, 0].tobytes(),
                                   p[:, 1].tobytes())):
                c.append(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, send_schema)], schema=send_schema)

    def send(batches):
        ids, sets, seen, size = [], [], set(), 0
        for rb in batches:
            for i, s in zip(rb.column(0).to_pylist(), shingle_sets(rb.column(1), n_words)):
                key = s.tobytes()
                if i is None or key in seen or len(s) < 2:  # equal sets are one class already
                    continue
                seen.add(key)
                ids.append(i)
                sets.append(s)
                size += len(key)
                if size >= BLOCK:
                    yield block(ids, sets)
                    ids, sets, seen, size = [], [], set(), 0
        if ids:
            yield block(ids, sets)

    def meet(t: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)
        mark, node = joined("marks", np.uint32), joined("ids", np.int64)
        order = np.lexsort((node, mark))
        mark, node = mark[order], node[order]
        s, e = runs(mark)
        hub = np.repeat(node[s], e - s) if len(s) else node
        pairs = np.concatenate((
            np.stack((hub, node), 1)[hub != node],
            np.stack((joined("pair_a", np.int64), joined("pair_b", np.int64)), 1)))
        pairs = np.unique(pairs, axis=0)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                    schema=pair_schema)

    return (docs.mapInArrow(send, send_ddl).groupBy("bucket")
            .applyInArrow(meet, "a long, b long"))


def links(pairs: DataFrame, texts: DataFrame, side: int, n_words: int = N_WORDS,
          percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of set keys that are similar; ``texts``: key, text.

    Pairs are dealt to a grid of ``side`` by ``side`` cells by the hashes of both keys. A text
    goes once to each cell that has a pair of it, so at most 2 * ``side`` times however many
    pairs it is in, and a hub's pairs are spread over a row of cells."""
    schema = arrow_schema("a binary, b binary")

    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(side))

    dealt = pairs.withColumn("cell", (place("a") * side + place("b")).cast("int"))
    needs = dealt.select(F.col("a").alias("key"), "cell").union(dealt.select("b", "cell")).distinct()
    sent = needs.join(texts, "key").select(F.col("cell").alias("to"), "key", "text")

    def run(p: pa.Table, t: pa.Table) -> pa.Table:
        if not p.num_rows or not t.num_rows:
            return schema.empty_table()
        sets = dict(zip(t.column("key").to_pylist(), shingle_sets(t.column("text"), n_words)))
        keep = []
        for a, b in zip(p.column("a").to_pylist(), p.column("b").to_pylist()):
            left, right = sets[a], sets[b]
            low, high = sorted((len(left), len(right)))
            if 100 * low < percent * high:
                keep.append(False)
                continue
            both = np.sort(np.concatenate((left, right)))
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(both) - shared))
        mask = pa.array(keep, pa.bool_())
        return pa.Table.from_arrays([p.column("a").filter(mask), p.column("b").filter(mask)],
                                    schema=schema)

    return dealt.groupBy("cell").cogroup(sent.groupBy("to")).applyInArrow(
        run, "a binary, b binary")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 n_words: int = N_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``id``, ``n_shingles`` and ``component_id``, the smallest id
    reachable over links (sets whose Jaccard similarity is ``percent`` / 100 or more).

    Texts are lower-cased in A-Z; words are runs of bytes other than space and 0x09-0x0D. Null,
    empty and blank texts have no features and link with nothing. Rows of one id are one
    document, linked with each other. Rows of a null id get a null component and link nothing.
    Other columns are not looked at; an empty table gives no rows.
    """
    rows = _read(docs, id_col, text_col)
    n_buckets = block_count(text_bytes(docs, text_col))
    classes_ = materialize(set_classes(rows, n_words), "sets")
    members = classes_.filter("n >= 0").select("id", "n", "key")
    frequent = docs.sparkSession.sparkContext.broadcast(
        frequent_features(classes_, members.count()))
    named = members.filter("id is not null and key is not null").select("id", "n", "key")
    classes = named.groupBy("key").agg(F.min("id").alias("rep"), F.max("n").alias("n"))

    joined = components(candidate_groups(rows.filter("id is not null").select("text"), n_buckets,
                                         frequent, n_words, percent))
    groups = joined.union(joined.select("label", "label").distinct())
    # the classes that may have links, with their groups; each is read by one of its texts
    grouped = materialize(classes.withColumn("node", _short("key")).join(groups, "node").select(
        F.col("rep").alias("id"), "key", "n", F.col("label").alias("grp")), "groups")
    large = materialize(grouped.groupBy("grp").agg(F.sum("n").alias("n"))
                        .filter(F.col("n") > GROUP_FEATURES).select("grp"), "large")
    n_cells = block_count(8 * int(grouped.agg(F.sum("n")).first()[0] or 0))
    few = grouped.join(F.broadcast(large), "grp", "left_anti")
    cell = F.pmod(F.xxhash64("grp"), F.lit(n_cells)).cast("int").alias("cell")
    # (dealt by id at any size, so that what small tables show of disk holds for large ones)
    texts = rows.join(few.hint("merge"), "id").select(cell, "grp", "key", "text")
    edges = group_links(texts, frequent, n_words, percent)
    if not large.isEmpty():
        many = grouped.join(F.broadcast(large), "grp", "left_semi").select("id", "key")
        edges = edges.union(_large_groups(rows, many, n_buckets, frequent, n_words, percent))
    same_id = (named.groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("b"))
               .filter("a <> b").select("a", "id")
               .join(named, "id").select("a", F.col("key").alias("b")))
    edges, same_id = materialize(edges, "links"), materialize(same_id, "same")
    # (the links are stars already, one or more a group)
    labels = (edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if same_id.isEmpty()
              else components(edges.union(same_id)))

    # the label is a set key; the component's name is its smallest id
    key_label = classes.join(labels, classes["key"] == labels["node"], "left").select(
        "key", "rep", F.coalesce("label", "key").alias("label"))
    smallest = key_label.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_key = key_label.join(smallest, "label").select("key", "component_id")
    out = members.join(by_key, "key", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(
        F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def _large_groups(rows: DataFrame, named: DataFrame, n_buckets: int, frequent, n_words: int,
                  percent: int) -> DataFrame:
    """(node, label) of the components by all links of the classes ``named`` (id, key), by pivots of
    their signatures; ``rows``: id, text."""
    texts = materialize(_texts(rows.join(named, "id"), n_words), "texts")
    known = texts.join(named, "key").select("id", "text")
    found = candidates(known, n_buckets, frequent, n_words, percent)
    pairs = materialize(_as_classes(found, named), "pairs")
    # cells hold a bounded share of all candidates' texts (each at most twice per row of cells)
    side = max(8, -(-2 * text_bytes(texts, "text") // BLOCK))
    labels = components(links(pairs, texts, side, n_words, percent))
    return _further(pairs, texts, labels, frequent, side, n_buckets, n_words, percent)


def _as_classes(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs of ids as distinct pairs of their set keys; equal sets need no test."""
    a = named.select(F.col("id").alias("a"), F.col("key").alias("key_a"))
    b = named.select(F.col("id").alias("b"), F.col("key").alias("key_b"))
    return (pairs.distinct().join(a, "a").join(b, "b").filter("key_a <> key_b")
            .select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
            .distinct())


def _texts(rows: DataFrame, n_words: int) -> DataFrame:
    """(key, text) of the rows (id, text, key) whose text has that set; a key has one row."""
    schema = arrow_schema("key binary, text string")

    def run(batches):
        for rb in batches:
            keys = rb.column(1).to_pylist()
            mask = pa.array([len(s) > 0 and set_key(s) == k for s, k in
                             zip(shingle_sets(rb.column(0), n_words), keys)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [rb.column(1).filter(mask), rb.column(0).filter(mask)], schema=schema)

    return (rows.select("text", "key").mapInArrow(run, "key binary, text string")
            .dropDuplicates(["key"]))


def _further(tested: DataFrame, texts: DataFrame, labels: DataFrame, frequent, side: int,
             n_buckets: int, n_words: int, percent: int) -> DataFrame:
    """Test what the first round left: pairs of one signature in different components of which
    neither is the signature's first pivot. Only components that a failed pair touches can have
    such pairs."""
    ends = _labelled(tested, labels, "a").withColumnRenamed("label", "label_a")
    failed = _labelled(ends, labels, "b").filter("label <> label_a")
    failed = materialize(failed.select("label", "label_a"), "failed")
    if failed.isEmpty():
        return labels
    touched = failed.select("label").union(failed.select("label_a")).distinct()
    left = materialize(_labelled(texts, labels, "key").join(touched, "label", "left_semi")
                       .select("text", _short("key").alias("node"), _short("label").alias("label"),
                               "key"), "touched")
    names = left.select("node", "key")
    first, last, longest = 0, PIVOTS, PIVOTS + 1
    while first < longest - 1:
        found = materialize(_across(left, first, last, n_buckets, frequent, n_words, percent), "across")
        longest = found.agg(F.max("longest")).first()[0] or 0
        pairs = (found.filter("a is not null").select("a", "b").distinct()
                 .join(names.select(F.col("node").alias("a"), F.col("key").alias("key_a")), "a")
                 .join(names.select(F.col("node").alias("b"), F.col("key").alias("key_b")), "b")
                 .select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
                 .distinct().join(tested, ["a", "b"], "left_anti"))
        if first:  # labels have changed since the texts were labelled
            now = _labelled(pairs, labels, "a").withColumnRenamed("label", "label_a")
            pairs = _labelled(now, labels, "b").filter("label <> label_a").select("a", "b")
        pairs = materialize(pairs, "pairs")
        new = materialize(links(pairs, texts, side, n_words, percent), "links")
        if not new.isEmpty():
            # the components so far, as stars, and the new links
            labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
                                .union(new))
        tested = tested.union(pairs)
        first, last = last, EVERY_PIVOT
    return labels


def _short(c: str):
    """The first eight bytes of a key as a number."""
    return F.conv(F.substring(F.hex(c), 1, 15), 16, 10).cast("long")


def sketch_bytes(sizes: np.ndarray) -> np.ndarray:
    """Bytes of the sketches of sets of these sizes: powers of two."""
    bits = np.maximum(SKETCH_BITS * np.asarray(sizes, np.int64), LEAST_BITS)
    return 1 << (np.ceil(np.log2(bits)).astype(np.int64) - 3)


def sketch(s: np.ndarray) -> np.ndarray:
    """Bitmap of the cells that the set's features fall into. A sketch folded in half (one half
    or-ed with the other) is the sketch of half the length."""
    bits = 8 * int(sketch_bytes(np.array([len(s)]))[0])
    out = np.zeros(bits, np.uint8)
    out[(s % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little")


def may_be_similar(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
                   percent: int) -> np.ndarray:
    """Mask of the rows whose sets may be similar, by sketches (rows of bytes). A cell that only
    one of two sets falls into holds a feature that the other lacks, so no similar pair is lost."""
    width = min(a.shape[1], b.shape[1])
    a, b = (np.bitwise_or.reduce(x.reshape(len(x), -1, width), axis=1) for x in (a, b))
    words = np.uint64 if width % 8 == 0 else np.uint8
    a, b = np.ascontiguousarray(a).view(words), np.ascontiguousarray(b).view(words)
    only_a, only_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a & ~b, b & ~a))
    shared = np.minimum(size_a - only_a, size_b - only_b)  # at most
    return 100 * shared >= percent * (size_a + size_b - shared)


def _pivot_pairs(starts: np.ndarray, ends: np.ndarray, first: int, last: int):
    """Positions (pivot, later member) of the groups [start, end): of the pivots ``first`` to
    ``last`` of each, in portions of about PAIRS_AT_ONCE."""
    for k in range(first, min(last, int((ends - starts).max(initial=1)) - 1)):
        live = ends - starts > k + 1
        pivot, rest = starts[live] + k, (ends - starts)[live] - k - 1
        at = np.concatenate(([0], np.cumsum(rest)))
        for i, j in by_bytes(at, PAIRS_AT_ONCE):
            n = rest[i:j]
            place = np.arange(n.sum()) - np.repeat(at[i:j] - at[i], n)
            p = np.repeat(pivot[i:j], n)
            yield p, p + 1 + place


def _across(left: DataFrame, first: int, last: int, n_buckets: int, frequent, n_words: int,
            percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of one signature and unlike components, which by their sizes and
    sketches may be similar, with one among the group's pivots ``first`` to ``last``; in
    ``longest`` the size of the largest group of several components. ``left``: text, node, label.
    A bucket gets a node once, with its label, size and sketch, and its signatures packed. Pivots
    come in the order of how many such groups of the bucket a node is in: the text that others are
    copies of is in most, and as an early pivot it joins them."""
    send_ddl = ("bucket int, marks binary, places binary, nodes binary, labels binary, "
                "sizes binary, sketches binary")
    send_schema = arrow_schema(send_ddl)
    out_schema = arrow_schema("a long, b long, longest long")

    def block(nodes, labels, sets):
        owner, mark = signatures(sets, percent, frequent.value)
        order, at = deal(((mark >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64), n_buckets)
        low = (mark & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        node, label = np.array(nodes, np.int64), np.array(labels, np.int64)
        size = np.array([len(s) for s in sets], np.int32)
        drawn = [sketch(s).tobytes() for s in sets]
        for b in np.flatnonzero(np.diff(at)):
            mine = order[at[b]:at[b + 1]]
            own, place = np.unique(owner[mine], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(
                    (b, low[mine].tobytes(), place.astype(np.int32).tobytes(), node[own].tobytes(),
                     label[own].tobytes(), size[own].tobytes(), b"".join(drawn[i] for i in own)),
                    send_schema)], schema=send_schema)

    def send(batches):
        nodes, labels, sets, size = [], [], [], 0
        for rb in batches:
            for s, n, l in zip(shingle_sets(rb.column(0), n_words), rb.column(1).to_pylist(),
                               rb.column(2).to_pylist()):
                nodes.append(n)
                labels.append(l)
                sets.append(s)
                size += s.nbytes
                if size >= BLOCK:
                    yield from block(nodes, labels, sets)
                    nodes, labels, sets, size = [], [], [], 0
        if sets:
            yield from block(nodes, labels, sets)

    def meet(t: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)
        node, label, size = (joined(n, k) for n, k in (
            ("nodes", np.int64), ("labels", np.int64), ("sizes", np.int32)))
        size, drawn = size.astype(np.int64), joined("sketches", np.uint8)
        wide = sketch_bytes(size)
        where = np.cumsum(wide) - wide
        shift = np.cumsum([0] + [len(x) // 8 for x in t.column("nodes").to_pylist()])
        mark = joined("marks", np.uint32)
        member = np.concatenate([np.frombuffer(x, np.int32) + n for x, n in zip(
            t.column("places").to_pylist(), shift)])
        order = np.lexsort((label[member], mark))
        s, e = runs(mark[order])
        live = label[member[order[s]]] != label[member[order[e - 1]]]
        keep = order[np.repeat(live, e - s)]
        mark, member = mark[keep], member[keep]
        often = np.bincount(member, minlength=len(node))
        order = np.lexsort((node[member], -often[member], mark))
        mark, member = mark[order], member[order]
        s, e = runs(mark)
        found = [np.zeros((0, 2), np.int64)]
        for p, q in _pivot_pairs(s, e, first, last):
            p, q = member[p], member[q]
            small, big = np.minimum(size[p], size[q]), np.maximum(size[p], size[q])
            may = (label[p] != label[q]) & (100 * small >= percent * big)
            pair = np.unique(np.stack((np.minimum(p, q), np.maximum(p, q)), 1)[may], axis=0)
            for shape in np.unique(wide[pair], axis=0):
                same = pair[(wide[pair] == shape).all(axis=1)]
                for i in range(0, len(same), PAIRS_AT_ONCE // 16):
                    part = same[i:i + PAIRS_AT_ONCE // 16]
                    a, b = (drawn[where[part[:, c], None] + np.arange(shape[c])] for c in (0, 1))
                    found.append(part[may_be_similar(a, b, size[part[:, 0]], size[part[:, 1]],
                                                     percent)])
        pairs = np.unique(np.sort(node[np.concatenate(found)], axis=1), axis=0)
        longest = int((e - s).max(initial=0))
        return pa.Table.from_arrays(
            [pa.array([*pairs[:, 0].tolist(), None], pa.int64()),
             pa.array([*pairs[:, 1].tolist(), None], pa.int64()),
             pa.array([None] * len(pairs) + [longest], pa.int64())], schema=out_schema)

    return (left.select("text", "node", "label").mapInArrow(send, send_ddl).groupBy("bucket")
            .applyInArrow(meet, "a long, b long, longest long"))


def _labelled(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``df`` with the component ``label`` of the set key in ``column``."""
    known = labels.select(F.col("node").alias(column), F.col("label").alias("_l"))
    return df.join(known, column, "left").withColumn(
        "label", F.coalesce("_l", column)).drop("_l")


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
