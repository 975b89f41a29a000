"""Best-fit packing of documents into sequences of several permitted lengths.

Sizes are words. A bin opens at the permitted length that costs least for each word which the sizes still to come can fill
it with, and in the end shrinks to the shortest permitted length that holds its contents. Each group of about ``GROUP``
items, dealt by a hash of the item, is packed on its own, so tasks stay small and the loss is at most a few
half-empty bins in a group; texts never move, only ids and sizes do.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import cut, type_of, word_count

#: Production parameters.
LENGTHS = (512, 1024, 2048, 4096, 8192)
GROUP = 2000
#: Words' worth of handling that any sequence costs, however short.
OVERHEAD = 32


def cost(length: int, longest: int) -> float:
    """Of computing one sequence: linear layers, attention that grows with the square, handling."""
    return OVERHEAD + length * (1 + length / (4 * longest))


def best_fill(left: list[int], length: int) -> int:
    """Words that a bin of this length takes of the sizes still to come (sorted), each time the largest that fits."""
    fill, end = 0, len(left)
    while end := bisect_right(left, length - fill, 0, end):
        end -= 1
        if not left[end]:
            break
        fill += left[end]
    return fill


def pack_once(sizes: list[int], lengths: list[int], opens: int | None) -> tuple[list[int], list[int], list[int]]:
    """Pack sizes, given largest first: the bin of each item, each item's offset, and each bin's fill.

    An item goes to the open bin in which it leaves the least room. Where there is none a bin opens. Without ``opens`` its
    length is chosen for it alone: of all permitted ones that hold the item, the length that costs least for each word which the
    sizes still to come can fill it with. With ``opens`` it is that length or, for larger items, the shortest that holds the item;
    once what is left would not fill it, the length of least cost for each word still to come.
    """
    longest, left = lengths[-1], sum(sizes)
    room: list[tuple[int, int]] = []  # of open bins, sorted
    fill: list[int] = []
    bins, offsets, coming = [], [], sorted(sizes)
    for size in sizes:
        coming.pop()  # sizes come largest first
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fits = [c for c in lengths if c >= size]
            if opens is None:
                held = {c: size + best_fill(coming, c - size) for c in fits}
                # What a length holds may fit a shorter one, which the bin shrinks to in the end.
                free = min(fits, key=lambda c: (cost(lengths[bisect_left(lengths, held[c])], longest) / max(1, held[c]), c))
            elif (free := max(opens, fits[0])) > left:
                free = min(fits, key=lambda c: cost(c, longest) / max(1, min(c, left)))
            b = len(fill)
            fill.append(0)
        bins.append(b)
        offsets.append(fill[b])
        fill[b] += size
        left -= size
        if free > size:
            insort(room, (free - size, b))
    return bins, offsets, fill


def pack_sizes(sizes: list[int], lengths: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """The cheapest of packing with lengths chosen bin by bin, and with each length as the one that bins open at: bins, offsets,
    fills, final lengths."""
    best = None
    for opens in (None, *lengths):
        bins, offsets, fill = pack_once(sizes, lengths, opens)
        final = [lengths[bisect_left(lengths, x)] for x in fill]
        total = sum(cost(c, lengths[-1]) for c in final)
        if best is None or total < best[0]:
            best = (total, bins, offsets, fill, final)
    return best[1:]


def pack(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of each document: id, copy, piece, start, length, bin_id, bin_length, bin_offset, bin_fill.

    A document longer than the longest permitted length is cut into pieces of that length and a rest, each
    placed on its own; others are one piece. Null and empty texts are one piece of length 0. Rows repeated
    under one id and size are its copies 0, 1, ...; a null id is an id like any other. Items of equal size are
    placed in order of id, copy and piece. An empty table gives an empty result. Columns other than the two
    named are ignored. Raises ValueError unless lengths are positive.
    """
    lengths = sorted(set(lengths))
    if not lengths or lengths[0] < 1:
        raise ValueError("permitted lengths must be positive")
    longest = lengths[-1]
    kind = type_of(docs, id_col)
    sized = docs.select(id_col, word_count(F.col(text_col)).alias("size"))
    sized = cut(sized.groupBy(id_col, "size").agg(F.count("*").alias("copies")), "sizes")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("size") / longest)).cast("long")
    n = sized.agg(F.sum(F.col("copies") * pieces)).first()[0] or 0
    groups = max(1, math.ceil(n / group))
    items = sized.select(id_col, "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    items = items.select(id_col, "size", "copy", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
    items = items.select(
        id_col,
        "copy",
        "piece",
        (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest), F.col("size") - F.col("piece") * longest).cast("long").alias("length"),
        F.pmod(F.xxhash64(id_col, "size", "copy", "piece"), F.lit(groups)).alias("pack_group"),
    )

    def packed(t: pa.Table) -> pa.Table:
        t = t.append_column("less", pc.negate(t.column("length")))
        t = t.take(pc.sort_indices(t, [(x, "ascending") for x in ("less", id_col, "start", "copy", "piece")]))
        bins, offsets, fill, final = pack_sizes(t.column("length").to_pylist(), lengths)
        bins = np.array(bins, np.int64)
        out = {
            "bin_id": pc.add(pc.multiply(t.column("pack_group"), pa.scalar(1 << 24, pa.int64())), pa.array(bins)),
            "bin_length": pa.array(np.array(final, np.int32)[bins]),
            "bin_offset": pa.array(np.array(offsets, np.int32)),
            "bin_fill": pa.array(np.array(fill, np.int32)[bins]),
        }
        return pa.table(
            [*(t.column(c) for c in (id_col, "copy", "piece", "start", "length")), *out.values()],
            names=[id_col, "copy", "piece", "start", "length", *out],
        )

    schema = f"`{id_col}` {kind}, copy long, piece long, start long, length long, bin_id long, bin_length int, bin_offset int, bin_fill int"
    return items.groupBy("pack_group").applyInArrow(packed, schema)
