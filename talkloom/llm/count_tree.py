"""N-gram Jaccard join by R-trees over count vectors.

A document is the set of its distinct three-word shingles. Shingles are hashed into ``GROUPS`` groups, and the document is the
point of its group counts. Two documents have no more shingles in common than the sum, over all groups, of the smaller count;
a page of an R-tree has for each group a largest count, which bounds the overlap of a point with all of the page's points
alike. Pairs whose bound reaches the threshold are verified on the sets themselves.

The differences of a pair at 0.9 are spread over all groups, so that one tree over the whole corpus spares next to nothing. The
trees are therefore small ones. A pair at 0.9 differs in at most a ninth of the smaller set's shingles. So where shingles are
dealt by hash into more bands than that, the two agree in all of some band, and so do the counts of that band's ``BAND_GROUPS``
groups. Documents meet in one tree if they have such a band's count vector in common (in bands made for their size; the sizes
of a link differ by a ninth at most), and no link is lost. Equal sets are one node throughout.

Trees of more than ``CELL`` nodes are dealt into cells, each of which holds two slices. A tree gives a spanning forest of the
pairs that pass its bound, not all of them. Where every edge of a forest proves a link, the links among its nodes add nothing
to the components. Trees with a failing edge are searched again for all pairs that pass between nodes which are not connected yet.

Counts alone let through what differs by twice the threshold and more, and in a large group of such near copies that is the square
of its size. So a pair must also pass by parities: of shingles dealt into ``PARITIES`` groups, a set knows which groups hold an odd
number. Two sets differ in at least as many shingles as parities, and in hardly more while these are few beside the groups.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import cut, type_of, utf8
from talkloom.llm.graph import connected_components

#: Words in a shingle; least similarity, as a fraction of integers.
SHINGLE, LEAST = 3, (9, 10)
#: Coordinates of a point, groups of a band, points on a page of a tree.
GROUPS, BAND_GROUPS, PAGE = 64, 256, 64
#: Parities of a set, 32 to a number; as many numbers as a point has. Sets of up to some thousand shingles are told apart by them.
PARITIES = 32 * GROUPS
#: Nodes of a tree from which it is dealt into cells; one of SAMPLED nodes tells which trees are as large (the results do not depend on it).
CELL, SAMPLED = 8192, 64
#: Trees of at most so many nodes hand on their pairs as they are: at most 28.
SMALL = 8
#: Distinct words whose hashes a task keeps at once.
WORDS = 500_000
#: From this set size on two different sets can link. Size classes start here, and the next at three times the widest ratio of a link.
SMALLEST, WIDTH = 9, 3

_U = np.uint64


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * _U(0xD6E8FEB86659FD93)
        h = (h ^ h >> _U(32)) * _U(0xD6E8FEB86659FD93)
        return h ^ h >> _U(32)


class _Words(dict):
    """Hashes of words, kept while they are at most WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 42)
        return h


def shingles(text: bytes | None, known: dict[bytes, int] | None = None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; none without words."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    known = _Words() if known is None else known
    own = np.array([known[w] for w in words], np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    h = np.full(n, min(len(words), SHINGLE), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(len(words), SHINGLE)):
            h = _mix(h * _U(31) + own[k : k + n], k + 1)
    return np.unique(h)


def _starts() -> list[int]:
    """Where size classes start; a class's links reach no farther than the next."""
    out = [SMALLEST]
    while out[-1] < 1 << 40:
        end = out[-1]
        for _ in range(WIDTH):
            end = end * LEAST[1] // LEAST[0] + 1
        out.append(end)
    return out


STARTS = _starts()
_WEIGHTS = _mix(np.arange(BAND_GROUPS, dtype=np.uint64), 77)


def bands_of(size_class: int) -> int:
    """One more than the most shingles by which a link differs whose larger set is of the class."""
    most = STARTS[size_class + 1] - 1
    return most * (LEAST[1] - LEAST[0]) // LEAST[0] + 1


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for the count vector of each band: of the set's own size class, and of the next where links reach it."""
    size = len(hashes)
    if size < SMALLEST:
        return np.zeros(0, np.int64)
    own = bisect_right(STARTS, size) - 1
    keys = []
    for c in (own, own + 1) if size * LEAST[1] // LEAST[0] >= STARTS[own + 1] else (own,):
        n = bands_of(c)
        band = ((hashes >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)
        counts = np.zeros(n, np.uint64)  # the counts of a band's groups, each times a number of its group's own
        with np.errstate(over="ignore"):
            np.add.at(counts, band, _WEIGHTS[(hashes & _U(BAND_GROUPS - 1)).astype(np.int64)])
            keys.append(_mix(counts + _mix(np.arange(n, dtype=np.uint64), c + 1000), 5))
    return np.concatenate(keys).view(np.int64)


def point(hashes: np.ndarray) -> np.ndarray:
    return np.bincount((hashes >> _U(16) & _U(GROUPS - 1)).astype(np.int64), minlength=GROUPS).astype(np.int32)


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether the shingles of each group are odd in number, as bits."""
    counts = np.bincount((hashes >> _U(40) & _U(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int32)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, place, text): id, place, set size, the set's key, its point, its parities and its band keys."""
    known = _Words()
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            sets = [shingles(text, known) for text in utf8(part.column(2))]
            keys = [band_keys(h) for h in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(h) for h in sets], pa.int64()),
                    pa.array([_key(h) for h in sets], pa.binary()),
                    pa.array([point(h).tobytes() if len(h) >= SMALLEST else b"" for h in sets], pa.binary()),
                    pa.array([parities(h).tobytes() if len(h) >= SMALLEST else b"" for h in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]).astype(np.int32)), pa.array(np.concatenate(keys))),
                ],
                names=["id", "place", "n", "own", "point", "odd", "bands"],
            )


def _key(hashes: np.ndarray) -> bytes:
    """128 bits that name a set; empty for the empty set."""
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else b""


def _runs(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[np.ndarray]]:
    """Rows come sorted by their first ``by`` columns, which are numbers: the columns of each run of whole groups."""
    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = []
        for c in range(batch.num_columns):
            column = batch.column(c)
            if pa.types.is_binary(column.type):
                rows.append(np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(batch.num_rows, GROUPS))
            else:
                rows.append(column.to_numpy(zero_copy_only=False))
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        last = np.logical_and.reduce([x == x[-1] for x in rows[:by]])
        rest = int(np.argmax(last))
        if rest:
            yield [x[:rest] for x in rows]
        held = [x[rest:].copy() for x in rows]
    if held:
        yield held


def _bounds(rows: list[np.ndarray], by: int) -> list[tuple[int, int]]:
    new = np.logical_or.reduce([x[1:] != x[:-1] for x in rows[:by]])
    first = np.flatnonzero(np.r_[True, new])
    return list(zip(first.tolist(), [*first[1:].tolist(), len(rows[0])]))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, cell, node) in order: pairs of small trees (tree null), and of larger ones rows (node, null, tree), named by their nodes."""
    for rows in _runs(batches, 2):
        node, spans = rows[2], np.array(_bounds(rows, 2), np.int64)
        size = spans[:, 1] - spans[:, 0]
        us, vs, trees, members = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        for n in range(2, SMALL + 1):
            first = spans[size == n, 0]
            for i in range(n):
                for j in range(i + 1, n):
                    us.append(node[first + i])
                    vs.append(node[first + j])
        for i, j in spans[size > SMALL]:
            mine = np.unique(node[i:j])
            members.append(mine)
            trees.append(np.full(len(mine), xxhash.xxh64_intdigest(mine.tobytes(), 42), np.uint64).view(np.int64))
        u, v = np.concatenate(us), np.concatenate(vs)
        order = np.lexsort((v, u))
        u, v = u[order], v[order]
        new = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])][: len(u)] & (u != v)  # two bands of a node may have one key
        u, v = u[new], v[new]
        of_pair = np.r_[np.ones(len(u), bool), np.zeros(sum(map(len, members)), bool)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([u, *members])),
                pa.array(np.r_[v, np.zeros(len(of_pair) - len(v), np.int64)], mask=~of_pair),
                pa.array(np.concatenate([np.zeros(len(u), np.int64), *trees]), mask=of_pair),
            ],
            names=["u", "v", "tree"],
        )


def enough(overlap, size_a, size_b):
    """Whether sets of these sizes, with so many shingles in common, link."""
    return (LEAST[0] + LEAST[1]) * overlap >= LEAST[0] * (size_a + size_b)


def close(differing, size_a, size_b):
    """Whether sets of these sizes that differ in no more shingles than this may link: sizes less twice the overlap are what differs."""
    return (LEAST[0] + LEAST[1]) * differing <= (LEAST[1] - LEAST[0]) * (size_a + size_b)


class Tree:
    """An R-tree of points, packed by size and then along the coordinates that vary most; pages have largest counts and a least size."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray, odd: np.ndarray | None = None):
        order, wide = np.argsort(sizes, kind="stable"), np.argsort(-points.var(axis=0), kind="stable")
        parts = [order]
        for c in wide[:12]:
            if all(len(p) <= PAGE for p in parts):
                break
            parts = [q for p in parts for q in (np.array_split(p[np.argsort(points[p, c], kind="stable")], 2) if len(p) > PAGE else [p])]
        pages = [q for p in parts for q in np.array_split(p, -(-len(p) // PAGE))]
        self.order = np.concatenate(pages)
        self.starts = np.cumsum([0, *map(len, pages)])
        self.sizes, self.points = sizes[self.order], points[self.order]
        self.odd = None if odd is None else odd[self.order].view(np.uint32)
        self.top = np.maximum.reduceat(self.points, self.starts[:-1], axis=0)
        self.least = np.minimum.reduceat(self.sizes, self.starts[:-1])
        self.left = np.ones(len(order), bool)
        self.more = len(order)

    def take(self, places: np.ndarray) -> None:
        """These are not left any more."""
        self.left[places] = False
        self.more -= len(places)

    def near(self, place: int) -> np.ndarray:
        """Places of the points still left whose bounds let them link with the point at a place."""
        if not self.more:
            return np.zeros(0, np.int64)
        size, at = self.sizes[place], self.points[place]
        pages = np.flatnonzero(enough(np.minimum(self.top, at).sum(axis=1), size, self.least))
        if not len(pages):
            return pages
        some = np.concatenate([np.arange(self.starts[p], self.starts[p + 1]) for p in pages]) if len(pages) < len(self.least) else np.arange(len(self.sizes))
        some = some[self.left[some]]
        some = some[enough(np.minimum(self.points[some], at).sum(axis=1), size, self.sizes[some])]
        if self.odd is None:
            return some
        differing = np.bitwise_count(self.odd[some] ^ self.odd[place]).sum(axis=1, dtype=np.int64)
        return some[close(differing, size, self.sizes[some])]


def forest(nodes: np.ndarray, sizes: np.ndarray, points: np.ndarray, odd: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that pass the bounds."""
    tree, out = Tree(sizes, points, odd), []
    for seed in range(len(nodes)):
        if not tree.left[seed]:
            continue
        tree.take([seed])
        queue = [seed]
        while queue:
            at = queue.pop()
            found = tree.near(at)
            tree.take(found)
            queue += found.tolist()
            out += [(int(nodes[tree.order[at]]), int(nodes[tree.order[x]])) for x in found]
    return out


def across(nodes: np.ndarray, sizes: np.ndarray, labels: np.ndarray, points: np.ndarray, odd: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs that pass the bounds and have different labels, some thousands at a time."""
    tree, us, vs, held = Tree(sizes, points, odd), [], [], 0
    for at in range(len(nodes)):
        tree.take([at])
        found = tree.order[tree.near(at)]
        found = found[labels[found] != labels[tree.order[at]]]
        us.append(np.full(len(found), nodes[tree.order[at]]))
        vs.append(nodes[found])
        held += len(found)
        if held > 65536:
            yield np.concatenate(us), np.concatenate(vs)
            us, vs, held = [], [], 0
    if held:
        yield np.concatenate(us), np.concatenate(vs)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (tree, node, n, point, odd) in order: the edges (u, v, tree) of each tree's forest."""
    for rows in _runs(batches, 1):
        for i, j in _bounds(rows, 1):
            edges = np.array(forest(*(x[i:j] for x in rows[1:])), np.int64).reshape(-1, 2)
            edges.sort(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (edges[:, 0], edges[:, 1], np.full(len(edges), rows[0][i]))], names=["u", "v", "tree"])


def _acrosses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (tree, node, n, label, point, odd) in order: all pairs (u, v) of different labels that pass the bounds."""
    for rows in _runs(batches, 1):
        for i, j in _bounds(rows, 1):
            for u, v in across(*(x[i:j] for x in rows[1:])):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (u, v, n_u, p_u, n_v, p_v): the pairs whose summed smaller counts reach the threshold."""
    for batch in batches:
        at = {c: batch.column(c) for c in batch.schema.names}
        points = [np.frombuffer(b"".join(at[c].to_pylist()), np.int32).reshape(batch.num_rows, GROUPS) for c in ("p_u", "p_v")]
        sizes = [at[c].to_numpy(zero_copy_only=False) for c in ("n_u", "n_v")]
        mine = pa.array(np.flatnonzero(enough(np.minimum(*points).sum(axis=1), *sizes)))
        yield pa.RecordBatch.from_arrays([at["u"].take(mine), at["v"].take(mine)], names=["u", "v"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (node, own, text): the set of each text that is the node's."""
    known = _Words()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            sets = [shingles(x, known) for x in utf8(part.column(2))]
            mine = [i for i, (h, own) in enumerate(zip(sets, part.column(1).to_pylist())) if _key(h) == own]
            ends = np.cumsum([0, *(len(sets[i]) for i in mine)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in mine)]).view(np.int64)
            taken = [part.column(0).take(pa.array(mine, pa.int64())), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(taken, names=["node", "shingles"])


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Add to pairs (u, v) whether the nodes' sets link; sets are made again of one text (place, text) of each node."""
    asked = pairs.select("u").union(pairs.select("v")).distinct().toDF("node")
    of_node = texts.join(nodes.select("node", "place", "own").join(asked, "node", "left_semi"), "place").dropDuplicates(["place", "node"])
    sets = cut(of_node.select("node", "own", "text").mapInArrow(_sets, "node long, shingles array<long>"), "sets")
    both = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v")
    links = enough(F.size(F.array_intersect("a", "b")), F.size("a"), F.size("b"))
    return cut(both.select("u", "v", links.alias("links")), "verified")


def _trees(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of nodes (node, n, point, bands): pairs (u, v) of small trees that pass the bound; rows (tree, node, n, point, odd) of larger ones.

    A key's nodes are dealt by hash into k slices, and each pair of slices meets in a cell; k is 1 but for keys of many nodes.
    """
    entries = nodes.select(F.explode("bands").alias("key"), "node")
    some = entries.where(F.pmod(F.hash("node"), F.lit(SAMPLED)) == 0).groupBy("key").agg(F.count("*").alias("m"))
    hot = cut(some.where(F.col("m") > CELL // SAMPLED).select("key", F.ceil(F.col("m") * SAMPLED * 2 / CELL).cast("long").alias("k")), "hot_keys")
    k = F.coalesce(F.col("k"), F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("node"), k)
    cells = F.transform(F.sequence(F.lit(0).cast("long"), k - 1), lambda j: F.least(own, j) * k + F.greatest(own, j))
    dealt = entries.join(hot, "key", "left").select("key", F.explode(cells).alias("cell"), "node")
    in_order = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "node")
    met = cut(in_order.mapInArrow(_met, "u long, v long, tree long"), "met")
    about = nodes.select("node", "n", "point")
    pairs = met.where("tree is null").select("u", "v").distinct().join(about.toDF("u", "n_u", "p_u"), "u").join(about.toDF("v", "n_v", "p_v"), "v")
    members = met.where("tree is not null").select("tree", F.col("u").alias("node")).distinct()
    about = nodes.select("node", "n", "point", "odd")
    return pairs.mapInArrow(_bounded, "u long, v long"), members.join(about, "node").select("tree", "node", "n", "point", "odd")


def _by_tree(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(columns).repartition("tree").sortWithinPartitions("tree", "node")


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_shingles and component_id, the smallest id reachable over links, the row's own included.

    Rows whose sets are equal link unless the sets are empty: null texts and texts without a word link with nothing. Rows with a
    null id take part and get the component of their set (null if nobody in it has an id). Repeated rows are returned as often as
    they come; ties do not arise; an empty table gives an empty result. Columns other than the two named are ignored. Shingles
    are compared by 64-bit hashes.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("place"), F.col(text_col).alias("text"))
    described = texts.mapInArrow(_described, f"id {type_of(docs, id_col)}, place long, n long, own binary, point binary, odd binary, bands array<long>")
    described = cut(described, "described")
    of_set = described.where("n > 0").groupBy("own").agg(
        F.min("id").alias("least"), *(F.first(c).alias(c) for c in ("place", "n", "point", "odd", "bands"))
    )
    nodes = cut(of_set.withColumn("node", F.monotonically_increasing_id()), "nodes")
    large = nodes.where(F.col("n") >= SMALLEST)
    sure, members = _trees(large)
    members = cut(members, "members")
    edges = cut(_by_tree(members, ["tree", "node", "n", "point", "odd"]).mapInArrow(_forests, "u long, v long, tree long"), "edges")
    pairs = cut(sure.union(edges.select("u", "v")).distinct(), "pairs")
    known = _verified(pairs, nodes, texts.select("place", "text"))
    links = known.where("links").select("u", "v")
    doubtful = cut(edges.join(known.where("not links"), ["u", "v"]).select("tree").distinct(), "doubtful")
    member = connected_components(links)
    if not doubtful.isEmpty():
        rows = members.join(doubtful, "tree", "left_semi").join(member, "node", "left")
        rows = rows.withColumn("label", F.coalesce("root", "node"))
        more = _by_tree(rows, ["tree", "node", "n", "label", "point", "odd"]).mapInArrow(_acrosses, "u long, v long").distinct()
        more = cut(more.join(known, ["u", "v"], "left_anti"), "more_pairs")
        if not more.isEmpty():
            links = links.union(_verified(more, nodes, texts.select("place", "text")).where("links").select("u", "v"))
            member = connected_components(links)
    labelled = nodes.join(member, "node", "left").select("own", "least", F.coalesce("root", "node").alias("root"))
    component = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(component, "root").select("own", "component_id")
    found = described.select("id", "n", "own").join(named, "own", "left")
    own_id = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own_id.alias("component_id"))
