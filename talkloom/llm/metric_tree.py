"""Exact top-k by inner product: best-first search of a paged M-tree.

Vectors become integers, which doubles hold exactly at any size. One more component, sqrt(M - |x|^2) with M the largest
squared norm, puts all rows on a sphere, where the highest inner product is the smallest Euclidean distance:
d(q, x)^2 = |q|^2 + M - 2 q.x. The sphere is scaled by a power of two to a radius between a half and one, so that no
square leaves a double, and every comparison of distances allows for their rounding (see slack). Scores are exact integers of any
size: products are taken in doubles or 64-bit integers where these hold them, and elsewhere in Python's integers of those
rows alone that rounding doesn't prove worse.

The tree is built by closeness, level by level. Its upper entries are routing vectors fitted on a sample of at most ``TOPS``
vectors; each row goes to the nearest. What falls under one of them is split among routing vectors drawn from its own
rows, as many as its capacity asks for, and what then still exceeds the capacity (equal vectors above all) is cut in
order of distance. This gives the nodes. A node is one record: a routing vector, its covering radius and its distance to
the entry above (the parent distance), and leaf pages of about ``PAGE`` vectors, each again with routing vector, covering
radius and parent distance, and with each vector's distance to it.

All queries are searched together in rounds. The first round sends a query to its nearest node, the second to the next
``SECOND`` by bound, the last to all others whose bound the k-th distance by then allows; upper entries and nodes are
dropped by radii and parent distances alone. A query meets a node as a row only if it must be searched there. In a node,
leaves come in order of distance; leaves and vectors whose stored distances prove them worse than the k-th best so far,
which falls from leaf to leaf, are skipped and their distances not computed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import cut, type_of

#: Production parameters. TOPS is also the bound of the sample that the upper entries are fitted on.
K = 5
SCALE = 256
QUERY_EVERY = 50
TOPS = 256
PAGE = 128
#: Bytes of vectors in a node, nodes of the second round, queries that meet a node in one task.
NODE_BYTES = 8 << 20
SECOND = 3
QUERIES = 1 << 15
#: Relative slack for rounding in distances.
EPS = 1e-9
ROUNDING = float(np.finfo(np.float64).eps)


def whole(vectors: list, scale: int = SCALE) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers of the usable vectors and their components as floor(scale * x), integers in doubles."""
    keep = [i for i, v in enumerate(vectors) if v is not None and None not in v]
    if not keep:
        return np.zeros(0, int), []
    with np.errstate(over="ignore"):
        if len({len(vectors[i]) for i in keep}) == 1:
            found = np.floor(scale * np.array([vectors[i] for i in keep], np.float64))
            good = np.isfinite(found).all(axis=1)
            return np.array(keep)[good], list(found[good])
        arrays = [(i, np.floor(scale * np.asarray(vectors[i], np.float64))) for i in keep]
    arrays = [(i, x) for i, x in arrays if np.isfinite(x).all()]
    return np.array([i for i, _ in arrays], int), [x for _, x in arrays]


def length_of(vector: np.ndarray) -> tuple[int, float]:
    """(exponent, fraction) of an upper bound of a vector's length, the fraction from a half to one; (0, 0.0) for zero."""
    top = int(np.frexp(np.abs(vector).max(initial=0.0))[1])
    fraction, exponent = math.frexp(float(np.linalg.norm(np.ldexp(vector, -top))) * (1 + 8 * ROUNDING * (len(vector) + 1)))
    return (exponent + top, fraction) if fraction else (0, 0.0)


def scaled(score: int, exponent: int) -> float:
    """A score in the sphere's scale."""
    extra = max(0, score.bit_length() - 900)
    return math.ldexp(float(score >> extra), extra - 2 * exponent)


def slack(dims: int, norm: float) -> float:
    """What distances on the sphere can be off by: a difference of squares of that size, under the root."""
    return 8 * math.sqrt(ROUNDING * (dims + 8) * norm)


def order_key(score: int) -> bytes:
    """Bytes that compare as scores do."""
    size = (score.bit_length() + 8) // 8
    body = size.to_bytes(2, "big") + abs(score).to_bytes(size, "big")
    return b"\1" + body if score >= 0 else b"\0" + bytes(255 - x for x in body)


def lift(vectors: np.ndarray, norm: float, exponent: int = 0) -> np.ndarray:
    """The rows on the sphere of squared radius norm, scaled down by 2 to the exponent."""
    near = np.ldexp(vectors, -exponent)
    return np.column_stack([near, np.sqrt(np.maximum(0, norm - np.einsum("ij,ij->i", near, near)))])


def flat(vectors: np.ndarray, exponent: int = 0) -> np.ndarray:
    """Queries beside lifted rows."""
    return np.column_stack([np.ldexp(vectors, -exponent), np.zeros(len(vectors))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(d, 0))


def nearest(rows: np.ndarray, centres: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest centre (the first, if several are) and its distance."""
    at, far = np.zeros(len(rows), np.int32), np.zeros(len(rows))
    for i in range(0, len(rows), step):
        d = distances(rows[i : i + step], centres)
        at[i : i + step] = d.argmin(axis=1)
        far[i : i + step] = d[np.arange(len(d)), at[i : i + step]]
    return at, far


def vectors_of(raw: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(-1, dims)


class Node:
    """Leaf pages of one node. Vectors lie page by page; leaves are numbered from 0."""

    def __init__(
        self,
        ids: list,
        vectors: np.ndarray,
        starts: np.ndarray,
        centres: np.ndarray,
        radii: np.ndarray,
        parents: np.ndarray,
        inner: np.ndarray,
        centre: int,
        radius: float,
        exponent: int = 0,
    ):
        self.ids, self.vectors, self.starts, self.centres, self.radii = ids, vectors, starts, centres, radii
        self.parents, self.inner, self.centre, self.radius, self.exponent = parents, inner, centre, radius, exponent

    @classmethod
    def build(cls, ids: list, vectors: np.ndarray, norm: float, page: int = PAGE, exponent: int = 0) -> Node:
        lifted = lift(vectors, norm, exponent)
        n = len(vectors)
        drawn = np.unique(np.linspace(0, n - 1, max(1, math.ceil(n / page))).astype(int))
        at, _ = nearest(lifted, lifted[drawn])
        order = np.argsort(at, kind="stable")
        bounds = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
        starts = np.array(sorted({s for a, b in zip(bounds, np.r_[bounds[1:], n]) for s in range(a, b, 2 * page)}), np.int32)
        ids, vectors, lifted = [ids[i] for i in order], vectors[order], lifted[order]
        middle = int(distances(lifted, lifted.mean(axis=0)[None])[:, 0].argmin())
        ends = np.r_[starts[1:], n]
        centres, radii, inner = np.zeros(len(starts), np.int32), np.zeros(len(starts)), np.zeros(n)
        for i, (a, b) in enumerate(zip(starts, ends)):
            centres[i] = a + distances(lifted[a:b], lifted[a:b].mean(axis=0)[None])[:, 0].argmin()
            inner[a:b] = distances(lifted[a:b], lifted[[centres[i]]])[:, 0]
            radii[i] = inner[a:b].max()
        parents = distances(lifted[centres], lifted[[middle]])[:, 0]
        return cls(ids, vectors, starts, centres, radii, parents, inner, middle, float(distances(lifted, lifted[[middle]]).max()), exponent)

    def search(self, queries: np.ndarray, own: list, bound: np.ndarray, norm: float, k: int, computed: list[int] | None = None) -> list[tuple[int, int, int]]:
        """(query's place, row's place, score) of at most k rows for each query: its best here, less those surely beyond bound.

        ``bound`` is each query's k-th distance so far. Rows whose id is the query's own are left out. ``computed``
        receives the number of pairs of query and vector whose product was computed.
        """
        lifted_centre = lift(self.vectors[[self.centre]], norm, self.exponent)
        q = flat(queries, self.exponent)
        to_node = distances(q, lifted_centre)[:, 0]
        tiny = slack(self.vectors.shape[1], norm)
        reach = bound * (1 + EPS) + tiny
        alive = np.flatnonzero(to_node - self.radius <= reach)
        if not len(alive):
            return []
        ids = np.array(self.ids)
        largest = int(np.abs(self.vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * self.vectors.shape[1]
        # Doubles hold the products exactly as long as none can exceed 2**53; they are far quicker than integers. Beyond
        # 2**62 products are taken in the sphere's scale first, and exactly where rounding leaves a row in question.
        exact = np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 62 else None
        if exact is None:
            q_length, x_length = np.linalg.norm(q, axis=1), np.linalg.norm(np.ldexp(self.vectors, -self.exponent), axis=1)
        squares = np.einsum("ij,ij->i", q, q)
        best: list[list[tuple[int, int, int]]] = [[] for _ in range(len(queries))]  # (-score, id, place), sorted
        leaves = lift(self.vectors[self.centres], norm, self.exponent)
        ends = np.r_[self.starts[1:], len(self.vectors)]
        # Parent distances: what is proved too far by them needs no distance of its own.
        allowed = np.abs(to_node[alive, None] - self.parents[None]) - self.radii[None] <= reach[alive, None]
        from_leaf = np.full((len(alive), len(ends)), np.inf)
        for j in np.flatnonzero(allowed.any(axis=0)):
            rows = np.flatnonzero(allowed[:, j])
            from_leaf[rows, j] = distances(q[alive[rows]], leaves[[j]])[:, 0]
        for j in np.argsort(
            np.where(np.isinf(from_leaf), np.nan, from_leaf - self.radii[None]).min(axis=0, initial=np.inf, where=~np.isinf(from_leaf)),
            kind="stable",
        ):
            here = np.flatnonzero(from_leaf[:, j] - self.radii[j] <= reach[alive])
            if not len(here):
                continue
            a, b = self.starts[j], ends[j]
            may = np.abs(self.inner[None, a:b] - from_leaf[here, j][:, None]) <= reach[alive[here], None]
            columns = np.flatnonzero(may.any(axis=0))
            rows = here[may.any(axis=1)]
            if not len(columns):
                continue
            if exact is None:
                scores = q[alive[rows], :-1] @ np.ldexp(self.vectors[a + columns], -self.exponent).T
                off = 4 * ROUNDING * (self.vectors.shape[1] + 8) * (q_length[alive[rows], None] * x_length[None, a + columns] + ROUNDING * norm)
            else:
                scores = queries[alive[rows]].astype(exact) @ self.vectors[a + columns].T.astype(exact)
                off = None
            if computed is not None:
                computed.append(scores.size)
            for n, (r, row) in enumerate(zip(rows, scores)):
                i = alive[r]
                low, high = (row, row) if off is None else (row - off[n], row + off[n])
                least = None
                if len(best[i]) == k:
                    least = -best[i][-1][0] if off is None else scaled(-best[i][-1][0], self.exponent) - 4 * ROUNDING * norm
                near = np.flatnonzero(high >= least) if least is not None else np.arange(len(row))
                if len(near) > 4 * k:  # everything that may tie with the k-th stays, so that ties go to the smaller id
                    near = near[high[near] >= np.sort(low[near])[-2 * k]]

                def ranked(places: np.ndarray) -> list[tuple[int, int, int]]:
                    out = []
                    for c in places:
                        at = a + columns[c]
                        if ids[at] != own[i]:
                            score = int(row[c]) if off is None else sum(int(x) * int(y) for x, y in zip(queries[i].tolist(), self.vectors[at].tolist()))
                            out.append((-score, ids[at].item(), int(at)))
                    return out

                found = ranked(near)
                if len(found) < min(len(near), k) and len(near) < len(row):  # own rows were among the best
                    found = ranked(np.arange(len(row)))
                if found:
                    best[i] = sorted(best[i] + found)[:k]
                    if len(best[i]) == k:
                        kth = scaled(-best[i][-1][0], self.exponent)
                        reach[i] = min(reach[i], math.sqrt(max(0.0, squares[i] + norm - 2 * kth)) * (1 + EPS) + tiny)
        return [(i, place, -score) for i, found in enumerate(best) for score, _, place in found]


def top_k(
    rows: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = K,
    scale: int = SCALE,
    tops: int = TOPS,
    page: int = PAGE,
    node_bytes: int = NODE_BYTES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where is_query(id column) holds, its k best other rows (all, if fewer).

    Vectors that are null or hold a null or non-finite component take no part (also if scale makes it so), nor do rows with a
    null id. Vectors meet those of their own dimension; empty ones meet each other, with score 0. Ranks are by exact integers
    of any size; a score that is no 64-bit integer is null, its rank and vector are given. Ties in score go to the smaller id. Repeated rows are candidates as often
    as they come, but never of a query of their own id; a query that is repeated with its vector is asked once, and
    queries of one id and different vectors each have ranks of their own. No query, or no other row, gives no row. Columns
    other than the two named are ignored.
    """
    spark, kind = rows.sparkSession, type_of(rows, id_col)

    def ints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = whole(batch.column(1).to_pylist(), scale)
            lengths, dims = [length_of(x) for x in found], [len(x) for x in found]
            raw = pa.array([(x if len(x) else np.zeros(1)).astype("<f8").tobytes() for x in found], pa.binary())
            lengths = [pa.array([x[0] for x in lengths], pa.int32()), pa.array([x[1] for x in lengths], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), raw, *lengths, pa.array(dims, pa.int32())],
                names=["id", "raw", "exponent", "fraction", "dims"],
            )

    used = rows.where(F.col(id_col).isNotNull()).select(id_col, vector_col)
    used = cut(used.mapInArrow(ints, f"id {kind}, raw binary, exponent int, fraction double, dims int"), "vectors")
    length = F.when(F.col("fraction") > 0, F.struct("exponent", "fraction"))
    kinds = used.groupBy("dims").agg(F.count("*").alias("n"), F.max(length).alias("longest")).orderBy("dims").collect()  # a row for each dimension
    found = []
    for r in kinds:
        exponent, fraction = r["longest"] or (0, 0.0)
        mine = used.where(F.col("dims") == r["dims"])
        found.append(_top_k(mine, is_query, max(1, r["dims"]), r["n"], fraction * fraction, exponent, k, tops, page, node_bytes, kind))
    if not found:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    return reduce(DataFrame.unionByName, found)


def build(
    used: DataFrame, dims: int, n: int, norm: float, exponent: int, tops: int, page: int, node_bytes: int, kind: str
) -> tuple[np.ndarray, DataFrame]:
    """The routing vectors of the upper entries, lifted, and the nodes: a table of one record each."""
    capacity = max(page, node_bytes // (8 * dims))
    wanted = max(1, min(tops, math.ceil(2 * n / capacity)))
    sample = used.select("raw").distinct().orderBy(F.xxhash64("raw"), "raw").limit(wanted).collect()
    upper = lift(vectors_of([bytes(r["raw"]) for r in sample], dims), norm, exponent)

    def to_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, _ = nearest(lift(vectors_of(batch.column(1).to_pylist(), dims), norm, exponent), upper)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at)], names=["id", "raw", "top"])

    placed = cut(used.select("id", "raw").mapInArrow(to_top, f"id {kind}, raw binary, top int"), "placed")
    # Routing vectors of the next level: of each upper entry's different rows, twice as many as its rows fill nodes.
    sizes = placed.groupBy("top").agg(F.count("*").alias("n")).withColumn("m", F.ceil(2 * F.col("n") / capacity).cast("int"))
    sizes = cut(sizes, "sizes")
    drawn = placed.select("top", "raw").distinct().join(sizes.where(F.col("n") > capacity), "top").select("top", "m", "raw", F.xxhash64("raw").alias("h"))
    first = Window.partitionBy("top").orderBy("h", "raw")
    least = drawn.withColumn("nth", F.row_number().over(first)).where((F.col("nth") <= F.col("m")) & (F.col("nth") <= tops))
    least = cut(least.select("top", "raw"), "routing")
    slices = F.ceil(F.col("n") / capacity).cast("int")
    split = placed.join(sizes.select("top", "n"), "top").withColumn("slice", F.pmod(F.xxhash64("id", "raw"), slices).cast("int"))
    every = sizes.select("top", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    routing = least.join(every, "top")

    def to_node(left: pa.Table, right: pa.Table) -> pa.Table:
        at, far = np.zeros(left.num_rows, np.int32), np.zeros(left.num_rows)
        if left.num_rows and right.num_rows:
            centres = lift(vectors_of(sorted(right.column("raw").to_pylist()), dims), norm, exponent)
            at, far = nearest(lift(vectors_of(left.column("raw").to_pylist(), dims), norm, exponent), centres)
        elif left.num_rows:
            far = nearest(lift(vectors_of(left.column("raw").to_pylist(), dims), norm, exponent), upper[left.column("top").to_numpy()[:1]])[1]
        return pa.table([left.column("id"), left.column("raw"), left.column("top"), pa.array(at), pa.array(far)], names=["id", "raw", "top", "node", "far"])

    assigned = split.select("id", "raw", "top", "slice").groupBy("top", "slice").cogroup(routing.groupBy("top", "slice"))
    assigned = assigned.applyInArrow(to_node, f"id {kind}, raw binary, top int, node int, far double")
    parts = max(1, math.ceil(2 * n / capacity))
    in_order = assigned.repartitionByRange(parts, "top", "node", "far", "id").sortWithinPartitions("top", "node", "far", "id")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of node and distance; nodes are cut at the capacity and where a partition ends."""
        held: list[pa.Table] = []

        def record(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            made = Node.build(t.column("id").to_pylist(), vectors_of(t.column("raw").to_pylist(), dims), norm, page, exponent)
            top = t.column("top")[0].as_py()
            parent = float(distances(lift(made.vectors[[made.centre]], norm, exponent), upper[[top]])[0, 0])
            raws = [made.vectors.astype("<f8"), made.starts.astype("<i4"), made.centres.astype("<i4"), made.radii, made.parents, made.inner]
            arrays = [
                pa.array([top], pa.int32()),
                pa.array([parent]),
                pa.array([made.radius]),
                pa.array([made.centre], pa.int32()),
                pa.array([made.ids], pa.list_(t.schema.field("id").type)),
            ]
            return pa.RecordBatch.from_arrays([*arrays, *(pa.array([x.tobytes()], pa.binary()) for x in raws)], names=list(_NODE))

        def key(t: pa.Table, i: int) -> tuple:
            return t.column("top")[i].as_py(), t.column("node")[i].as_py()

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.concat_tables([*held, pa.Table.from_batches([batch])])
            edges = np.flatnonzero((np.diff(t.column("top").to_numpy()) != 0) | (np.diff(t.column("node").to_numpy()) != 0)) + 1
            starts = [0, *edges.tolist(), t.num_rows]
            held = []
            for a, b in zip(starts, starts[1:]):
                while b - a > capacity or (b < t.num_rows and b > a):
                    yield record(t.slice(a, min(capacity, b - a)))
                    a += min(capacity, b - a)
                if b == t.num_rows and b > a:
                    held = [t.slice(a, b - a).combine_chunks()]
        if held:
            yield record(held[0])

    schema = f"top int, parent double, radius double, centre int, ids array<{kind}>, vectors binary, starts binary, centres binary, radii binary, parents binary, inner binary"
    nodes = in_order.mapInArrow(packed, schema)
    return upper, cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


_NODE = ("top", "parent", "radius", "centre", "ids", "vectors", "starts", "centres", "radii", "parents", "inner")


def _top_k(
    used: DataFrame,
    is_query: Callable[[Column], Column],
    dims: int,
    n: int,
    norm: float,
    exponent: int,
    k: int,
    tops: int,
    page: int,
    node_bytes: int,
    kind: str,
) -> DataFrame:
    upper, nodes = build(used, dims, n, norm, exponent, tops, page, node_bytes, kind)
    catalog = cut(nodes.select("node", "top", "parent", "radius"), "catalog")
    radii = {r["top"]: r["r"] for r in catalog.groupBy("top").agg(F.max(F.col("parent") + F.col("radius")).alias("r")).collect()}  # at most ``tops``
    radius = np.array([radii.get(i, -np.inf) for i in range(len(upper))])
    queries = used.where(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("raw").alias("query"), "exponent", "fraction").distinct()
    queries = cut(queries.withColumn("h", F.xxhash64("query")), "queries")
    chunks = max(1, math.ceil(queries.count() / QUERIES))
    query = ["query_id", "h"]
    tiny = slack(dims, norm)
    wide = exponent > 31  # a product can leave a 64-bit integer: scores are ordered by their bytes
    order, columns = ("key", "key binary, score long, near double") if wide else ("score", "score long, near double")

    def route(nearest_only: bool) -> Callable:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 4096):
                    part = batch.slice(start, 4096)
                    d = distances(flat(vectors_of(part.column(2).to_pylist(), dims), exponent), upper)
                    if nearest_only:
                        rows, at = np.arange(len(d)), d.argmin(axis=1)
                    else:
                        limit = part.column(3).to_numpy()[:, None]
                        rows, at = np.nonzero(d - radius[None] <= limit * (1 + EPS) + tiny)
                    take = pa.array(rows)
                    columns = [
                        part.column(0).take(take),
                        part.column(1).take(take),
                        pa.array(at.astype(np.int32)),
                        pa.array(d[rows, at]),
                        part.column(3).take(take),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[*query, "top", "d", "limit"])

        return each

    def routed(limited: DataFrame, nearest_only: bool) -> DataFrame:
        """query_id, h, node, bound, limit: nodes that radii and parent distances do not rule out."""
        pairs = limited.select(*query, "query", "limit").mapInArrow(route(nearest_only), f"query_id {kind}, h long, top int, d double, limit double")
        bound = F.greatest(F.lit(0.0), F.abs(F.col("d") - F.col("parent")) - F.col("radius"))
        pairs = pairs.join(catalog, "top").select(*query, "node", bound.alias("bound"), "limit")
        return pairs.where(F.col("bound") <= F.col("limit") * (1 + EPS) + tiny)

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        for i in range(left.num_rows if right.num_rows else 0):
            at = {c: left.column(c)[i].as_py() for c in _NODE}
            numbers = (np.frombuffer(at[c], t) for c, t in (("starts", "<i4"), ("centres", "<i4"), ("radii", "<f8"), ("parents", "<f8"), ("inner", "<f8")))
            node = Node(at["ids"], vectors_of([at["vectors"]], dims), *numbers, at["centre"], at["radius"], exponent)
            found = node.search(
                vectors_of(right.column("query").to_pylist(), dims),
                right.column("query_id").to_pylist(),
                right.column("limit").to_numpy(),
                norm,
                k,
            )
            of = pa.array([f[0] for f in found], pa.int64())
            ids = pa.array([at["ids"][f[1]] for f in found], left.schema.field("ids").type.value_type)
            scores = [f[2] for f in found]
            fits = pa.array([x if -(1 << 63) <= x < 1 << 63 else None for x in scores], pa.int64())
            near = pa.array([scaled(x, exponent) for x in scores], pa.float64())
            keys = [pa.array([order_key(x) for x in scores], pa.binary())] if wide else []
            out.append(pa.table([right.column("query_id").take(of), right.column("h").take(of), ids, *keys, fits, near], names=names))
        t = right.schema.field("query_id").type
        none = [t, pa.int64(), t, *([pa.binary()] if wide else []), pa.int64(), pa.float64()]
        return pa.concat_tables(out) if out else pa.table([pa.array([], x) for x in none], names=names)

    names = [*query, "vec_id", *(x.split()[0] for x in columns.split(", "))]

    def search(wanted: DataFrame) -> DataFrame:
        """The best of each query in each of its nodes; a node is shipped once for up to QUERIES queries."""
        wanted = wanted.join(queries.select(*query, "query"), query).withColumn("chunk", F.pmod(F.xxhash64(*query), F.lit(chunks)).cast("int"))
        needed = wanted.select(F.col("node").alias("of_node"), F.col("chunk").alias("of_chunk")).distinct()
        needed = needed.join(nodes, F.col("of_node") == F.col("node")).drop("node")
        cells = needed.groupBy("of_node", "of_chunk").cogroup(wanted.select("node", "chunk", *query, "query", "limit").groupBy("node", "chunk"))
        return cells.applyInArrow(searched, f"query_id {kind}, h long, vec_id {kind}, {columns}")

    by_score = Window.partitionBy(*query).orderBy(F.desc(order), "vec_id")

    def limits(best: DataFrame) -> DataFrame:
        """Queries with the distance of their k-th best so far; open while a query has fewer than k."""
        kth = best.groupBy(*query).agg(F.count("*").alias("n"), F.min("near").alias("kth"))
        length = F.col("fraction") * F.pow(F.lit(2.0), F.col("exponent") - F.lit(exponent))
        far = F.sqrt(F.greatest(F.lit(0.0), length * length + norm - 2 * F.col("kth")))
        return queries.join(kth, query, "left").withColumn("limit", F.when(F.col("n") >= k, far).otherwise(float("inf")))

    open_end = queries.withColumn("limit", F.lit(float("inf")))
    home = routed(open_end, True).groupBy(*query).agg(F.min_by("node", F.struct("bound", "node")).alias("node"))
    done = cut(home.withColumn("limit", F.lit(float("inf"))), "visited")
    best = cut(_best(search(done), by_score, k), "best")
    for share in (SECOND, None):
        left = routed(limits(best), False).join(done.select(*query, "node"), [*query, "node"], "left_anti")
        if share:
            nth = F.row_number().over(Window.partitionBy(*query).orderBy("bound", "node"))
            left = left.withColumn("nth", nth).where(F.col("nth") <= share)
        left = cut(left.select(*query, "node", "limit"), "visited")
        best = cut(_best(best.unionByName(search(left)), by_score, k), "best")
        done = done.unionByName(left)
    return best.withColumn("rank", F.row_number().over(by_score)).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, by_score, k: int) -> DataFrame:
    return found.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= k).drop("nth")
