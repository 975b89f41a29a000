"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at ``THRESHOLD`` = 3 or fewer differing bits. Two such fingerprints differ in
at most one bit on at least one of their 32-bit halves, so the covering code lives on a half, where the
remaining threshold is t = 1: the perfect Hamming(31, 26) code with one free bit appended has 2**27 words
and covering radius R = 1. Every fingerprint is replicated to all anchors within R + t = 2 of each half
(at most 17 a half). If a half of x is at most one bit from that of y, then y reaches the anchor nearest
to x, so comparing those at home at an anchor with all that reached it loses no link. (Anchors over all
64 bits would need R + 3: over a thousand replicas for any radius that keeps anchors selective.)

Anchors with more members than ``CELL`` are dealt into a grid of cells; each cell compares one slice of the
fingerprints at home with one slice of all. Cells emit a spanning set of links for each group that they connect,
never all pairs. Where a link counts only once it is verified, a spanning set could be spanned by links that fail; there
nodes that may link are blocks instead (see band_blocks), and links span a block only over pairs that pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import cut, fresh_name, mark, release, type_of, utf8, word_count
from talkloom.llm.graph import connected_components

SHINGLE = 3
THRESHOLD = 3
SEED = 42
#: Members of an anchor that one task compares at once.
CELL = 4096


def fingerprint(text: bytes | None) -> int:
    """The 64 bits, unsigned; 0 for null and for texts without a word."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    ends = [x - 1 for x in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(x + 1 for x in ends[:-1])]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[i:j], SEED) for i, j in zip(starts[:n], ends[-n:])])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, fp long) for each row of docs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x) for x in utf8(batch.column(1))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {type_of(docs, id_col)}, fp long")


def _code() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of each byte at each of four places of a 31-bit word; for each syndrome the 15 two-bit flips that lead to a code word."""
    of_byte = np.zeros((4, 256), np.int64)
    for place in range(4):
        for byte in range(256):
            for bit in range(8):
                if byte >> bit & 1 and 8 * place + bit < 31:
                    of_byte[place, byte] ^= 8 * place + bit + 1
    flips = np.zeros((32, 15), np.int64)
    for s in range(1, 32):
        flips[s] = [1 << i - 1 | 1 << (i ^ s) - 1 for i in range(1, 32) if i < i ^ s]
    return of_byte, flips


_SYNDROME, _FLIPS = _code()


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For unsigned fingerprints: row numbers, anchor keys and whether the anchor is the row's home on that half."""
    rows, keys, home = [], [], []
    every = np.arange(len(fps))
    for half in range(2):
        x = (fps >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        word, free = x & 0x7FFFFFFF, x >> 31
        s = np.bitwise_xor.reduce([_SYNDROME[p][word >> 8 * p & 255] for p in range(4)])
        centre = np.where(s > 0, word ^ (np.int64(1) << np.maximum(s - 1, 0)), word)
        key = lambda code, bit: code | bit << 31 | np.int64(half) << 32
        off = every[s > 0]
        far = word[off, None] ^ _FLIPS[s[off]]
        rows += [every, every, np.repeat(off, 15)]
        keys += [key(centre, free), key(centre, 1 - free), key(far, free[off, None]).ravel()]
        home += [np.ones(len(fps), bool), np.zeros(len(fps) + 15 * len(off), bool)]
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (node, fps): a row for each anchor of each table's fingerprint; tables do not share anchors."""
    for batch in batches:
        for start in range(0, batch.num_rows, 8192):
            part = batch.slice(start, 8192)
            nodes = part.column(0).to_numpy(zero_copy_only=False)
            tables = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(nodes), -1)
            for i in range(tables.shape[1]):
                fps = np.ascontiguousarray(tables[:, i])
                rows, keys, home = anchors(fps.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys | np.int64(i) << 33), pa.array(fps[rows]), pa.array(nodes[rows]), pa.array(home.astype(np.int8))],
                    names=["anchor", "fp", "node", "role"],
                )


#: Roles within a cell: only compared with, at home and compared with, or (in grids) only at home.
MEMBER, BOTH, HOME = 0, 1, 2


def link_group(fps: np.ndarray, nodes: np.ndarray, role: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Links (node, node) within the threshold that connect whatever links connect in the group, and no more of them."""
    names, first, at = np.unique(nodes, return_index=True, return_inverse=True)
    if len(names) < 2:
        return []
    own = fps[first]
    homes, others = np.unique(at[role >= BOTH]), np.unique(at[role <= BOTH])
    there, label, out = own[others], np.arange(len(names)), []
    for h in homes:
        bits = np.bitwise_count(there ^ own[h])
        close = np.flatnonzero((bits <= threshold) & (label[others] != label[h]))
        if len(close):
            close = close[np.argsort(bits[close], kind="stable")]  # of each group met, its nearest member
            met, which = np.unique(label[others[close]], return_index=True)
            out += [(int(names[others[close[i]]]), int(names[h])) for i in which]
            met = np.append(met, label[h])
            label[np.isin(label, met)] = met.min()
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (anchor, cell); groups may run over from one batch to the next."""

    def links(anchor: np.ndarray, cell: np.ndarray, fps: np.ndarray, nodes: np.ndarray, role: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])]) if len(anchor) else np.zeros(0, int)
        size = np.diff(np.r_[first, len(anchor)])
        found = []
        for i, n in zip(first[size > 1], size[size > 1]):
            if (role[i : i + n] >= BOTH).any():
                found += link_group(fps[i : i + n], nodes[i : i + n], role[i : i + n])
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    held: tuple = ()
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        rows[2] = rows[2].view(np.uint64)
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        rest = int(np.argmax((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])))
        yield links(*(x[:rest] for x in rows))
        held = tuple(x[rest:] for x in rows)
    if held:
        yield links(*held)


def link_nodes(sketches: DataFrame, cell: int = CELL) -> DataFrame:
    """Of rows (node, fps): links (u, v), enough of them to connect all nodes that a fingerprint of one place in fps links."""
    spread = sketches.select("node", "fps").mapInArrow(_replicate, "anchor long, fp long, node long, role byte")
    hot = cut(spread.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > cell), "hot_anchors")
    k = F.ceil(F.col("n") * 2 / cell).cast("int")
    dealt = spread.join(hot, "anchor", "left").withColumn("k", F.coalesce(k, F.lit(1)))
    own, other = F.pmod(F.xxhash64("node"), F.col("k")).cast("int"), F.pmod(F.hash("node"), F.col("k"))
    steps = F.sequence(F.lit(0), F.col("k") - 1)
    part = lambda cells, role: F.transform(cells, lambda c: F.struct(c.cast("int").alias("cell"), F.lit(role).cast("byte").alias("role")))
    across = part(F.transform(steps, lambda i: i * F.col("k") + other), MEMBER)
    along = part(F.transform(steps, lambda j: own * F.col("k") + j), HOME)
    single = F.array(F.struct(F.lit(0).alias("cell"), F.col("role")))
    cells = F.when(F.col("k") == 1, single).when(F.col("role") == BOTH, F.concat(across, along)).otherwise(across)
    dealt = dealt.select("anchor", "fp", "node", F.inline(cells))
    in_order = dealt.select("anchor", "cell", "fp", "node", "role").repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    return in_order.mapInArrow(_compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest id reachable over links, the row's own included. Null and empty texts have
    fingerprint zero and link as any other. Rows with a null id take part and get the component of their
    fingerprint (null if nobody in it has an id). Repeated rows are returned as often as they come; ties do
    not arise; an empty table gives an empty result. Columns other than the two named are ignored.
    """
    signed = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    named = fingerprint_components(signed, id_col)
    return signed.join(named, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def fingerprint_components(signed: DataFrame, id_col: str) -> DataFrame:
    """fp and component_id for each fingerprint of a table (id, fp)."""
    classes = cut(signed.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprint_classes")
    member = connected_components(link_nodes(classes.select(F.col("fp").alias("node"), F.array("fp").alias("fps"))))
    linked = cut(classes.join(member, F.col("fp") == F.col("node")).select("fp", "root", "least"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    component = linked.join(least, "root").select("fp", "component")
    return classes.join(component, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))


# For corpora whose near copies differ by more than three bits of the fingerprint above -----------------------------

#: Production parameters: fingerprints of the words by count, each with hashes of its own, that sketch() gives by itself beside
#: the one of shingles; words in a verified shingle, least estimated similarity, and slots of the sketch that estimates it.
TABLES = 3
VERIFIED_SHINGLE = 5
SIMILARITY = 0.8
SLOTS = 256
EMPTY = 0xFF
NOTHING = np.uint64(2**64 - 1)


def _mixed(h: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        for _ in range(2):
            h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(32)


def _hashes(pieces: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(x, SEED) for x in pieces]), ">u8").astype(np.uint64)


def node_of(text: bytes | None) -> int:
    """One number for texts of the same lower-cased words in the same order."""
    return xxhash.xxh64_intdigest(b" ".join(text.lower().split()) if text else b"", SEED)


def band_width(least: float) -> int:
    """Slots in a band. Sketches similar by ``least`` (above 0) differ in at most 1 - ``least`` of the slots that either fills; these
    slots stand in more bands than that, so that at least one filled band is the same in both."""
    return SLOTS if least >= 1 else max(1, int((1 - 1e-9) / (1 - least)))


def bands(low: np.ndarray, width: int) -> np.ndarray:
    """A key for each band of slots that holds something, of its place and the whole hashes in it."""
    rows = np.pad(low, (0, -len(low) % width), constant_values=NOTHING).reshape(-1, width)
    keys = np.arange(len(rows), dtype=np.uint64)
    for column in rows.T:
        keys = _mixed(keys ^ column, 0)
    return keys[(rows != NOTHING).any(axis=1)]


def sketch(text: bytes | None, tables: int = TABLES, width: int = band_width(SIMILARITY)) -> tuple[int, list[int], bytes, np.ndarray]:
    """Of a text: its node, its fingerprints (that of shingles first), a one-permutation MinHash of its five-word shingles
    in SLOTS slots of 8 bits, and the keys of the MinHash's bands.

    The other fingerprints are of words, each weighing 1 + ln(its count), in whole sixteenths so that sums are exact.
    """
    words = text.lower().split() if text else []
    low = np.full(SLOTS, NOTHING, np.uint64)
    if not words:
        return node_of(text), [0] * (1 + tables), np.full(SLOTS, EMPTY, np.uint8).tobytes(), bands(low, width)
    place: dict[bytes, int] = {}
    at = np.array([place.setdefault(w, len(place)) for w in words])
    own = _hashes(list(place))
    weights = np.round(16 * (1 + np.log(np.bincount(at)))).astype(np.int64)
    fps = [fingerprint(text)]
    for n in range(1, tables + 1):
        bits = np.unpackbits(_mixed(own, n).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes = (weights.astype(np.float64) @ bits).astype(np.int64)  # whole numbers far below 2**53
        fps.append(int.from_bytes(np.packbits(2 * votes > weights.sum()).tobytes(), "big"))
    n = max(1, len(words) - VERIFIED_SHINGLE + 1)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(VERIFIED_SHINGLE, len(words))):
            h = _mixed(h + own[at[k : k + n]], k)
    h = np.sort(h)[::-1]  # of each slot the least hash is written last
    low[(h & np.uint64(SLOTS - 1)).astype(int)] = h
    slots = np.where(low == NOTHING, np.uint64(EMPTY), np.minimum(low >> np.uint64(16) & np.uint64(0xFF), np.uint64(EMPTY - 1))).astype(np.uint8)
    return node_of(text), fps, slots.tobytes(), bands(low, width)


def estimated(a: bytes, b: bytes) -> float:
    """The similarity of two sketches: equal slots among those that either fills."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    some = (x != EMPTY) | (y != EMPTY)
    return float((x == y)[some].mean()) if some.any() else 1.0


def verified_links(nodes: np.ndarray, slots: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Of a block: links that connect whatever is connected by pairs of an estimated similarity of at least ``least``.
    slots: a sketch for each node."""
    label, filled, out = np.arange(len(nodes)), slots != EMPTY, []
    for h in range(len(nodes) - 1):
        rest = h + 1 + np.flatnonzero(label[h + 1 :] != label[h])
        for start in range(0, len(rest), 1024):
            close = rest[start : start + 1024]
            some = filled[close] | filled[h]
            of = some.sum(axis=1)
            same = ((slots[close] == slots[h]) & some).sum(axis=1)
            close = close[np.where(of > 0, same / np.maximum(of, 1), 1.0) >= least]
            if len(close):
                met, which = np.unique(label[close], return_index=True)
                out += [(int(nodes[close[i]]), int(nodes[h])) for i in which]
                met = np.append(met, label[h])
                label[np.isin(label, met)] = met.min()
    return out


def _signed(docs: DataFrame, what, name: str, id_col: str, text_col: str) -> DataFrame:
    """id, ``name`` (the unsigned 64-bit number that ``what`` makes of the text) and size (words) for each row of docs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            made = np.array([what(x) for x in texts], np.uint64).view(np.int64)
            sizes = pa.array([len(x.split()) if x else 0 for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made), sizes], names=["id", name, "size"])

    return docs.select(id_col, text_col).mapInArrow(each, f"id {type_of(docs, id_col)}, {name} long, size long")


def _sketched(texts: DataFrame, least: float) -> DataFrame:
    """node, fps (the fingerprint of shingles), slots and bands for each row of a table of texts."""
    width = band_width(least)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(x, 0, width) for x in utf8(batch.column(0))]
            nodes = np.array([x[0] for x in found], np.uint64).view(np.int64)
            fps = np.array([x[1] for x in found], np.uint64).reshape(-1, 1).view(np.int64).tolist()
            keys = [x[3].view(np.int64) for x in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(fps, pa.list_(pa.int64())), pa.array([x[2] for x in found], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["node", "fps", "slots", "bands"],
            )

    return texts.mapInArrow(each, "node long, fps array<long>, slots binary, bands array<long>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, node) from rows sorted by (band, cell, node), for bands of two nodes and more; a block is named by its nodes, so
    equal ones of other bands are one. Groups may run over from one batch to the next."""

    def grouped(band: np.ndarray, cell: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (cell[1:] != cell[:-1])]) if len(band) else np.zeros(0, int)
        size = np.diff(np.r_[first, len(band)])
        first, size = first[size > 1], size[size > 1]
        names = np.array([xxhash.xxh64_intdigest(nodes[i : i + n].tobytes(), SEED) for i, n in zip(first, size)], np.uint64).view(np.int64)
        mine = [nodes[i : i + n] for i, n in zip(first, size)]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(names, size)), pa.array(np.concatenate([nodes[:0], *mine]))], names=["block", "node"])

    held: tuple = ()
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        rest = int(np.argmax((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])))
        yield grouped(*(x[:rest] for x in rows))
        held = tuple(x[rest:] for x in rows)
    if held:
        yield grouped(*held)


def band_blocks(sketches: DataFrame, cell: int = CELL) -> DataFrame:
    """Of rows (node, bands): nodes of blocks. Two nodes that have a band in common have a block in common.

    Bands of more nodes than ``cell`` are dealt into slices, and any two slices make a block.
    """
    spread = sketches.select("node", F.explode("bands").alias("band"))
    hot = cut(spread.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > cell), "hot_bands")
    dealt = spread.join(hot, "band", "left").withColumn("k", F.coalesce(F.ceil(F.col("n") * 2 / cell).cast("int"), F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.least(own, j) * F.col("k") + F.greatest(own, j))
    dealt = dealt.select("band", F.explode(cells).alias("cell"), "node")
    in_order = dealt.repartition("band", "cell").sortWithinPartitions("band", "cell", "node")
    return in_order.mapInArrow(_blocks, "block long, node long").distinct()


def similar_groups(
    docs: DataFrame,
    among: DataFrame | None = None,
    least: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, component_id and size (words) for each row of docs: groups as near_duplicates gives them, with more links.

    Texts link if their shingle fingerprints differ in three or fewer bits, and also if their five-word shingles are similar
    by at least ``least`` (estimated by SLOTS slots; the standard error is 0.026 at 0.8). All pairs that the estimate makes
    alike share a band of slots (see band_width) and are compared. Texts of the same words in order are one node, however
    often they come. Where ``among`` (a table of one column, id) is given, only rows with such an id take part and are returned.

    Null and empty texts are one node and so one group. Rows with a null id take part and have the component of their
    node, null if nobody in it has an id. Repeated rows are returned as often as they come; rows of one id and different
    texts are different documents; an empty table gives an empty result. Columns other than the two named are ignored.
    """
    signed = _signed(docs, node_of, "node", id_col, text_col)
    signed = cut(signed if among is None else signed.join(among.toDF("id"), "id", "left_semi"), "signed")
    # A sketch is a function of the node: any row's will do, and copies are combined before the shuffle.
    nodes = _sketched(docs.select(text_col), least).groupBy("node").agg(*(F.first(x).alias(x) for x in ("fps", "slots", "bands")))
    nodes = cut(nodes if among is None else nodes.join(signed.select("node").distinct(), "node", "left_semi"), "nodes")
    found = cut(band_blocks(nodes), "blocks")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block; blocks may run over from one batch to the next."""

        def links(block: np.ndarray, node: np.ndarray, slots: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, int)
            pairs = []
            for i, j in zip(first, np.r_[first[1:], len(block)]):
                pairs += verified_links(node[i:j], slots[i:j], least)
            pairs = np.array(pairs, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        held: tuple = ()
        for batch in batches:
            if not batch.num_rows:
                continue
            slots = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, SLOTS)
            rows = [batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), slots]
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            rest = int(np.argmax(rows[0] == rows[0][-1]))
            yield links(*(x[:rest] for x in rows))
            held = tuple(x[rest:].copy() for x in rows)
        if held:
            yield links(*held)

    blocks = found.join(nodes.select("node", "slots"), "node").select("block", "node", "slots")
    in_order = blocks.repartition("block").sortWithinPartitions("block", "node")
    member = connected_components(in_order.mapInArrow(verify, "u long, v long").unionByName(link_nodes(nodes)))
    of_node = cut(
        signed.groupBy("node").agg(F.min("id").alias("least")).join(member, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")),
        "linked",
    )
    of_root = of_node.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_node.join(of_root, "root").select("node", "component_id")
    return signed.join(named, "node").select(F.col("id").alias(id_col), "component_id", "size")


def keep_one(docs: DataFrame, earlier: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay when of each group of near-duplicates (see similar_groups) one document stays.

    A stage that takes shared lines out of texts leaves of copies little that is alike. ``earlier`` (id, text) holds the
    texts as they were before: groups are those of the earlier texts, and of each group the document that has lost fewest
    words stays (of these the one of smallest id), so that what the group shares stays too. What then stays is grouped
    again, in the same way, by its texts as they are, and the smallest id of each group stays. Ids that earlier lacks are
    grouped by their texts as they are. Without ``earlier`` the smallest id of each group stays.

    Rows without an id are kept: nothing tells which of them to keep. Of rows repeated under one id one stays. Null and
    empty texts are one group. Rows and columns that stay are unchanged, whatever the columns' names; an empty table gives
    an empty result.
    """
    left, since = None, mark()
    if earlier is not None:
        own = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(word_count(F.col(text_col))).alias("now"))
        now = cut(own, "own")
        ids, earlier = now.select("id"), earlier.select(id_col, text_col)
        strangers = cut(ids.join(earlier.select(F.col(id_col).alias("id")), "id", "left_anti"), "strangers")
        if not strangers.isEmpty():
            alike = docs.join(strangers, F.col(id_col) == F.col("id"), "left_semi").select(id_col, text_col)
            earlier = earlier.unionByName(alike)
        was = similar_groups(earlier, ids, id_col=id_col, text_col=text_col)
        was = was.groupBy(F.col(id_col).alias("id")).agg(F.max("size").alias("was"), F.min("component_id").alias("component_id"))
        lost = F.greatest(F.lit(0).cast("long"), F.col("was") - F.col("now"))
        best = was.join(now, "id").groupBy("component_id").agg(F.min(F.struct(lost.alias("lost"), F.col("id"))).alias("best"))
        left = cut(best.select("best.id"), "left")
        release(docs.sparkSession, since, keep=left)
    groups = similar_groups(docs, left, id_col=id_col, text_col=text_col)
    kept = groups.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__kept_id")).distinct()
    nth, columns = fresh_name(docs, "__nth"), docs.columns
    first = F.row_number().over(Window.partitionBy(id_col).orderBy(id_col))
    kept = kept.toDF(kept_id := fresh_name(docs, "__kept_id"))
    one = docs.join(kept, F.col(id_col) == F.col(kept_id), "left_semi").withColumn(nth, first).where(F.col(nth) == 1).select(columns)
    return one.unionByName(docs.where(F.col(id_col).isNull()).select(columns))
