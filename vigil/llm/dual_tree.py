"""Operator 5: exact top-k inner-product search by dual trees.

Queries and data are indexed together: all vectors are dealt to cells around the same pivots, and
each block of a cell becomes a cover tree (every child ball covers its points, and the radii
shrink by a constant factor from level to level; centres of one level are further apart than
their radius). Two trees are searched as one: a pair of nodes is skipped when the best product
that their balls allow, <q, r> + |q| R(r) + |r| R(q) + R(q) R(r), is below the worst k-th score in
the query node. Blocks meet first with the most promising block, then with every block whose
roots that bound cannot rule out; nothing is approximated. Bounds are taken in floats and raised
by more than their rounding; scores are whole numbers of any size.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import batch, materialize
from vigil.llm.repeats import arrow_schema

TOP, EVERY, SCALE = 20, 20, 64
# Vectors of a data block and of a query block.
DATA_BLOCK, QUERY_BLOCK = 4096, 512
# Pivots at most (the upper level that queries and data share) and the sample they come from.
PIVOTS, PIVOT_SAMPLE = 256, 4096
LEAF, BASE, FAN_OUT = 64, 1.3, 48
# Bounds are floats: they are raised by a half and by this share of the balls' extents for each
# component, which covers their rounding. Scores are whole numbers and exact.
SLACK, ROUNDING = 0.5, 2.0 ** -48
# Scores are clamped to (NONE, MOST]; NONE stands for no score.
NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
# Scaled components beyond this do not take part.
LARGEST = 2.0 ** 62


# -- one tree ---------------------------------------------------------------------------------
def farthest_first(points: np.ndarray, start: int, reach: float, limit: int
                   ) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres chosen farthest first until all points are within ``reach`` of one, or ``limit``
    centres; with each point's centre and distance."""
    centres = [start]
    near = np.linalg.norm(points - points[start], axis=1)
    owner = np.zeros(len(points), np.int64)
    while len(centres) < limit:
        far = int(near.argmax())
        if near[far] <= reach:
            break
        d = np.linalg.norm(points - points[far], axis=1)
        closer = d < near
        owner[closer] = len(centres)
        near[closer] = d[closer]
        centres.append(far)
    return centres, owner, near


def build(points: np.ndarray, ids: np.ndarray) -> dict:
    """Cover tree over points (rows). Nodes are rows of ``nodes``: first point, end, first child,
    number of children; ``centre`` and ``radius`` are theirs; points are stored in node order. A
    node is a leaf if it has few points, or FAN_OUT balls of a smaller radius cannot cover them."""
    exact, points = points.astype(np.int64), points.astype(np.float64)
    order: list[np.ndarray] = []
    rows: list[list] = []
    rows.append([0, 0, 0, 0])
    centre, radius = [points[0]], [0.0]
    queue = [(0, np.arange(len(points)), 0)]
    leaves: dict[int, np.ndarray] = {}
    for node, own, start in queue:  # grows while it is walked: breadth first
        sub = points[own]
        reach = float(np.linalg.norm(sub - sub[start], axis=1).max())
        centre[node], radius[node] = sub[start], reach
        if len(own) <= LEAF or reach == 0:
            leaves[node] = own
            continue
        centres, owner, near = farthest_first(sub, start, reach / BASE, FAN_OUT)
        if near.max() > reach / BASE:  # points too scattered for smaller balls to tell them apart
            leaves[node] = own
            continue
        rows[node][2:] = [len(rows), len(centres)]
        for c, at in enumerate(centres):
            members = np.flatnonzero(owner == c)
            rows.append([0, 0, 0, 0])
            centre.append(sub[at])
            radius.append(0.0)
            queue.append((len(rows) - 1, own[members], int(np.searchsorted(members, at))))
    at, stack = 0, [0]  # points in depth-first order, so those under a node lie together
    while stack:
        node = stack.pop()
        if node in leaves:
            order.append(leaves[node])
            rows[node][:2] = [at, at + len(leaves[node])]
            at += len(leaves[node])
        stack += range(rows[node][2], rows[node][2] + rows[node][3])
    order_ = np.concatenate(order)
    return {"points": exact[order_], "ids": ids[order_], "nodes": np.array(rows, np.int64),
            "centre": np.array(centre), "radius": np.array(radius),
            "norm": np.linalg.norm(np.array(centre), axis=1)}


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two integer matrices, exact; clamped to what a long holds."""
    largest = (max(1, int(a.max(initial=0)), -int(a.min(initial=0)))
               * max(1, int(b.max(initial=0)), -int(b.min(initial=0))) * a.shape[1])
    if largest < 2 ** 53:  # every partial sum is exact
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest < 2 ** 63:
        return a @ b.T
    out = a.astype(object) @ b.astype(object).T  # Python's integers
    return np.clip(out, NONE + 1, MOST).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        n = len(query_ids)
        self.score = np.full((n, k), NONE)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.worst = np.full(n, NONE)

    def offer(self, a: int, b: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the queries a to b with the vectors of these ids."""
        hit = scores >= self.worst[a:b, None]
        hit &= self.query_ids[a:b, None] != ids[None, :]
        q, c = np.nonzero(hit)
        if not len(q):
            return
        touched = np.unique(q)
        width = np.bincount(q, minlength=b - a)[touched].max()
        new_s = np.full((len(touched), width), NONE)
        new_i = np.full((len(touched), width), np.iinfo(np.int64).max)
        first = np.searchsorted(q, touched)
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        row = np.searchsorted(touched, q)
        new_s[row, place], new_i[row, place] = scores[q, c], ids[c]
        at = touched + a
        s = np.concatenate((self.score[at], new_s), 1)
        i = np.concatenate((self.id[at], new_i), 1)
        order = np.lexsort((i, ~s), axis=1)[:, :self.k]  # ~s falls as s rises, without overflow
        self.score[at] = np.take_along_axis(s, order, 1)
        self.id[at] = np.take_along_axis(i, order, 1)
        self.worst[at] = np.maximum(self.worst[at], self.score[at, -1])


def bound(centre, radius, norm, other, other_radius, other_norm):
    """Largest inner product that two balls allow (arrays over the first ball's nodes), raised by
    what rounding may take away."""
    extent = (norm + radius) * (other_norm + other_radius)
    most = (centre @ other + norm * other_radius + other_norm * radius + radius * other_radius
            + SLACK + ROUNDING * len(other) * extent)
    return np.maximum(most, float(NONE))  # as clamped as scores are


def search(queries: dict, data: dict, best: Best) -> int:
    """Dual-tree search of all queries; returns the number of node pairs whose points met."""
    met, stack = 0, [(0, 0, np.inf)]
    q_nodes, r_nodes = queries["nodes"], data["nodes"]
    span = _spans(q_nodes)

    def bounds(q, r):
        return bound(data["centre"][r], data["radius"][r], data["norm"][r],
                     queries["centre"][q], queries["radius"][q], queries["norm"][q])

    while stack:
        q, r, most = stack.pop()
        a, b = span[q]
        if most < float(best.worst[a:b].min()):
            continue
        q_kids, r_kids = q_nodes[q, 3], r_nodes[r, 3]
        if not q_kids and not r_kids:
            c, d = r_nodes[r, :2]
            best.offer(a, b, products(queries["points"][a:b], data["points"][c:d]),
                       data["ids"][c:d])
            met += 1
        elif r_kids and (not q_kids or data["radius"][r] >= queries["radius"][q]):
            kids = np.arange(r_nodes[r, 2], r_nodes[r, 2] + r_kids)
            value = bounds(q, kids)
            stack += [(q, int(kids[i]), value[i]) for i in np.argsort(value)]  # best on top
        else:
            for kid in range(q_nodes[q, 2], q_nodes[q, 2] + q_kids):
                stack.append((kid, r, float(bounds(kid, np.array([r]))[0])))
    return met


def _spans(nodes: np.ndarray) -> np.ndarray:
    """Range of points under each node."""
    span = nodes[:, :2].copy()
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i, 3]:
            kids = slice(nodes[i, 2], nodes[i, 2] + nodes[i, 3])
            span[i] = span[kids, 0].min(), span[kids, 1].max()
    return span


# -- on Spark ---------------------------------------------------------------------------------
def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component, as 64-bit integers in bytes. Rows with a null
    id, or a vector that is null, empty or holds a null or non-finite component, or one beyond
    LARGEST when scaled, are left out."""
    schema = arrow_schema("id long, v binary")

    def run(batches):
        for rb in batches:
            for k in range(0, rb.num_rows, 1024):
                part = rb.slice(k, 1024)
                ids, out = [], []
                for i, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if i is None or not v or any(x is None for x in v):
                        continue
                    with np.errstate(over="ignore"):
                        x = np.floor(scale * np.array(v, np.float64))
                    if (np.abs(x) <= LARGEST).all():  # also false for what is not a number
                        ids.append(i)
                        out.append(x.astype("<i8").tobytes())
                yield batch(schema, ids, out)

    return vectors.select(F.col(id_col).cast("long"), vector_col).mapInArrow(run, "id long, v binary")


def top_k(vectors: DataFrame, every: int = EVERY, k: int = TOP, scale: int = SCALE,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for every row whose id is divisible by ``every``, the ``k``
    highest inner products of the scaled vectors with any other row, ties to the smaller id; all,
    if there are fewer.

    Rows that ``scaled`` leaves out take no part. Vectors meet only vectors of their own length.
    Scores are exact; those beyond what a long holds count as the largest (least) that it does.
    Repeated rows of one id and vector count once; rows that share an id are never each other's
    neighbours. Other columns are not looked at; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(scaled(vectors, id_col, vector_col, scale).distinct(), "vectors")
    # Of equal vectors a query can only want the k smallest ids besides its own.
    order = Window.partitionBy("v").orderBy("id")
    data = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r")
    queries = rows.filter(F.col("id") % every == 0)
    sample = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(PIVOT_SAMPLE)
    shared = spark.sparkContext.broadcast(_pivots([r[0] for r in sample.collect()]))
    packed_r = materialize(_blocks(data, shared, DATA_BLOCK), "data-blocks")
    packed_q = materialize(_blocks(queries, shared, QUERY_BLOCK), "query-blocks")

    # First meeting: the data block whose ball allows the highest product, for each query block.
    q, r = (_summary(p, x) for p, x in ((packed_q, "q"), (packed_r, "r")))
    dot = F.aggregate(F.zip_with("q_centre", "r_centre", lambda a, b: a * b), F.lit(0.0),
                      lambda s, x: s + x)
    extent = (F.col("q_norm") + F.col("q_radius")) * (F.col("r_norm") + F.col("r_radius"))
    most = (dot + F.col("q_norm") * F.col("r_radius") + F.col("r_norm") * F.col("q_radius")
            + F.col("q_radius") * F.col("r_radius") + F.lit(SLACK)
            + F.lit(ROUNDING) * F.size("q_centre") * extent)
    most = F.greatest(F.lit(float(NONE)), most)
    # summaries only: the blocks of a stated query set against all blocks
    pairs = materialize(q.join(r, "size").withColumn("most", most)
                        .select("q_block", "r_block", "most"), "block-pairs")
    best_first = Window.partitionBy("q_block").orderBy(F.desc("most"), "r_block")
    ranked = pairs.withColumn("turn", F.row_number().over(best_first))
    first = materialize(_meet(ranked.filter("turn = 1"), packed_q, packed_r, None, k), "first")
    kth = (first.groupBy("q_block", "query_id").agg(
        F.when(F.count("id") >= k, F.min("score")).alias("kth")))
    worst = kth.groupBy("q_block").agg(F.min(F.coalesce("kth", F.lit(int(NONE)))).alias("worst"))
    held = kth.groupBy("q_block").agg(F.collect_list(F.struct("query_id", "kth")).alias("held"))
    rest = (ranked.filter("turn > 1").join(worst, "q_block", "left")
            .filter("worst is null or most >= double(worst)").drop("worst"))
    later = _meet(rest, packed_q, packed_r, held, k)
    found = first.union(later).filter("id is not null").select("query_id", "id", "score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.distinct().withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")


def _pivots(sample: list[bytes]) -> dict:
    """At most PIVOTS centres of each vector length, farthest first."""
    out = {}
    for size in {len(v) for v in sample}:
        x = np.stack([np.frombuffer(v, "<i8") for v in sample if len(v) == size]).astype(float)
        centres, *_ = farthest_first(x, 0, 0.0, min(PIVOTS, 1 + len(x) // 64))
        out[size] = x[centres]
    return out


def _blocks(rows: DataFrame, shared, block_rows: int) -> DataFrame:
    """(size, block, centre, radius, norm, tree): cover trees of at most about ``block_rows``
    vectors, all of one cell. Cells of more vectors are split by the hash of the vector and id."""
    cell_schema = arrow_schema("size int, cell int, id long, v binary")

    def cells(batches):
        for rb in batches:
            v = rb.column(1).to_pylist()
            size = np.array([len(x) for x in v], np.int64)
            cell = np.zeros(len(v), np.int64)
            for n in np.unique(size):
                centres = shared.value.get(int(n))
                at = np.flatnonzero(size == n)
                if centres is not None:
                    x = np.stack([np.frombuffer(v[i], "<i8") for i in at]).astype(float)
                    far = (centres ** 2).sum(1)[None, :] - 2 * x @ centres.T
                    cell[at] = far.argmin(axis=1)
            yield batch(cell_schema, size, cell, rb.column(0), rb.column(1))

    dealt = rows.select("id", "v").mapInArrow(cells, "size int, cell int, id long, v binary")
    counts = dealt.groupBy("size", "cell").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("n"))
    salted = dealt.join(counts, ["size", "cell"]).withColumn(
        "salt", F.pmod(F.xxhash64("v", "id"), F.col("n")).cast("int"))
    ddl = "size int, block string, centre array<double>, radius double, norm double, tree binary"
    schema = arrow_schema(ddl)

    def index(t: pa.Table) -> pa.Table:
        x = np.stack([np.frombuffer(v, "<i8") for v in t.column("v").to_pylist()])
        tree = build(x, t.column("id").to_numpy())
        size, cell, salt = (t.column(c)[0].as_py() for c in ("size", "cell", "salt"))
        return pa.Table.from_arrays(
            [pa.array([c], f.type) for c, f in zip(
                (size, f"{size}-{cell}-{salt}", tree["centre"][0].tolist(),
                 float(tree["radius"][0]), float(tree["norm"][0]), pickle.dumps(tree)), schema)],
            schema=schema)

    return salted.groupBy("size", "cell", "salt").applyInArrow(index, ddl)


def _summary(packed: DataFrame, side: str) -> DataFrame:
    return packed.select("size", *(F.col(c).alias(f"{side}_{c}")
                                   for c in ("block", "centre", "radius", "norm")))


def _meet(pairs: DataFrame, packed_q: DataFrame, packed_r: DataFrame, held: DataFrame | None,
          k: int) -> DataFrame:
    """(q_block, query_id, id, score): the k best of each query in each pair of blocks, those
    below a known k-th score left out. A query without any gives one row of nulls."""
    ddl = "q_block string, query_id long, id long, score long"
    schema = arrow_schema(ddl)
    both = (pairs.select("q_block", "r_block")
            .join(packed_q.select(F.col("block").alias("q_block"), F.col("tree").alias("q_tree")),
                  "q_block")
            .join(packed_r.select(F.col("block").alias("r_block"), F.col("tree").alias("r_tree")),
                  "r_block"))
    both = (both.join(held, "q_block", "left") if held is not None else both.withColumn(
        "held", F.lit(None).cast("array<struct<query_id:long,kth:long>>")))

    def run(batches):
        for rb in batches:
            for i in range(rb.num_rows):
                name, q, r, known = (rb.column(c)[i].as_py() for c in range(4))
                q, r = pickle.loads(q), pickle.loads(r)
                best = Best(q["ids"], k)
                if known:
                    kth = {x["query_id"]: x["kth"] for x in known if x["kth"] is not None}
                    best.worst = np.array([kth.get(x, NONE) for x in q["ids"].tolist()], np.int64)
                search(q, r, best)
                row, place = np.nonzero(best.score > NONE)
                none = np.setdiff1d(np.arange(len(q["ids"])), row)
                score = pa.array(best.score[row, place])
                empty = pa.nulls(len(none), pa.int64())
                yield batch(schema, [name] * (len(row) + len(none)),
                            q["ids"][np.concatenate((row, none))],
                            pa.concat_arrays([pa.array(best.id[row, place]), empty]),
                            pa.concat_arrays([score, empty]))

    return both.select("q_block", "q_tree", "r_tree", "held").mapInArrow(run, ddl)


def op5_dual_tree_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % {EVERY} = 0),
t AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM p)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= {TOP}
"""
