"""Best-fit packing of documents into sequences of several permitted lengths.

Items go longest first into the open bin with the least room that still takes them. Without one, a bin is
opened, of the length that costs least per token: for every permitted length, the items still to come are laid into such a bin,
largest first, and the cost of the shrunk bin is divided by what it holds. At last every bin shrinks to the
shortest permitted length that holds its contents. As bins opened one by one can be worse together, the batch is also packed
with bins of one smallest length, for each of them, and the cheapest packing is kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Permitted sequence lengths.
LENGTHS = (512, 1024, 2048, 4096, 8192)
# What a sequence costs beyond its tokens, in tokens: of bins with equal padding the longer ones are cheaper.
PER_BIN = 16.0
# Items packed together: enough for every bin to fill, few enough for a task's memory.
BATCH_ITEMS = 65_536


def bin_cost(length: int, per_bin: float = 0.0) -> float:
    """What a sequence costs: its tokens, padding included, and `per_bin`."""
    return length + per_bin


class Opener:
    """Chooses the length of every new bin by its least cost per token."""

    def __init__(self, sizes: Sequence[int], lengths: Sequence[int], per_bin: float) -> None:
        self.lengths, self.per_bin = lengths, per_bin
        self.left = Counter(sizes)  # items still to come, by size
        self.some = sum(1 << size for size in self.left)  # bit s: there is an item of size s to come

    def take(self, size: int) -> None:
        """An item was placed."""
        self.left[size] -= 1
        if not self.left[size]:
            self.some ^= 1 << size

    def filled(self, room: int) -> int:
        """How much of `room` the items to come fill, largest first."""
        start, largest = room, room
        while fitting := self.some & ((2 << min(room, largest)) - 1):
            size = fitting.bit_length() - 1
            room -= size * min(self.left[size], room // size)
            largest = size - 1
        return start - room

    def length(self, size: int) -> int:
        """The length to open for an item of `size` that was taken; the shorter one of equals."""
        best = None
        for n in self.lengths[bisect_left(self.lengths, size) :]:
            contents = size + self.filled(n - size)
            cost = bin_cost(self.lengths[bisect_left(self.lengths, contents)], self.per_bin) / contents
            if best is None or cost < best[0]:
                best = cost, n
        return best[1]


def best_fit(
    sizes: Sequence[int], lengths: Sequence[int], smallest: int | None = None, per_bin: float = 0.0
) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each item (descending sizes), and the contents of each bin.

    Bins open at the shortest permitted length that is at least `smallest` and takes the item; without `smallest`, at the length
    of the least cost.
    """
    opener = Opener(sizes, lengths, per_bin) if smallest is None else None
    bins, places, contents, rooms = [], [], [], []
    waiting: dict[int, list[int]] = {}  # bins by room
    some = 0  # bit r: there is a bin with room r
    for size in sizes:
        if opener:
            opener.take(size)
        fits = some >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            stack = waiting[room]
            b = stack.pop()
            if not stack:
                some &= ~(1 << room)
        else:
            b = len(contents)
            room = opener.length(size) if opener else next(n for n in lengths if n >= smallest and n >= size)
            contents.append(0)
            rooms.append(room)
        bins.append(b)
        places.append(contents[b])
        contents[b] += size
        room -= size
        if room:
            stack = waiting.setdefault(room, [])
            if not stack:
                some |= 1 << room
            stack.append(b)
    return bins, places, contents


def shrunk(contents: Sequence[int], lengths: Sequence[int]) -> list[int]:
    """The shortest permitted length for each bin's contents."""
    at = np.searchsorted(np.asarray(lengths), np.asarray(contents, dtype=np.int64))
    return np.asarray(lengths)[at].tolist()


def pack_batch(sizes: Sequence[int], lengths: Sequence[int], per_bin: float = 0.0) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each item (descending sizes from 1 to the longest length), and the length of each bin.

    The cheapest after shrinking: with every bin's length chosen by itself, or one smallest length for all; the first of equals.
    """
    best = None
    for smallest in (None, *lengths):
        bins, places, contents = best_fit(sizes, lengths, smallest, per_bin)
        final = shrunk(contents, lengths)
        cost = sum(bin_cost(n, per_bin) for n in final)
        if best is None or cost < best[0]:
            best = cost, bins, places, final
    return best[1:]


def pack(
    items: DataFrame, size_col: str, id_col: str = "doc_id", lengths: Sequence[int] = LENGTHS,
    per_bin: float = PER_BIN, batch_items: int = BATCH_ITEMS,
) -> DataFrame:
    """Per piece: the id, ``piece`` (from 0), ``start`` and ``size`` in the document, ``bin``, ``bin_length``, ``bin_start``.

    An item longer than the longest permitted length is cut into pieces of that length and a rest;
    nothing is dropped. Items of size null, 0 or less are empty: one piece of size 0, in no bin (bin,
    bin_length and bin_start null). Repeated rows and null ids are items like others. Other columns
    go; an empty table gives an empty one.

    Pieces are dealt out evenly, whatever their ids, and packed in batches of at most `batch_items`,
    so that a task's memory is bounded. Only ids and sizes are shuffled. A bin's number is unique in the
    result.
    """
    lengths = sorted(set(int(n) for n in lengths))
    longest = lengths[-1]
    size = F.greatest(F.coalesce(F.col("size"), F.lit(0)), F.lit(0))
    whole = items.select(items[id_col].alias("id"), items[size_col].cast("long").alias("size")).withColumn("size", size)
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / longest) - 1)
    pieces = whole.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))).select(
        "id", "piece", (F.col("piece") * longest).alias("start"),
        F.least(F.col("size") - F.col("piece") * longest, F.lit(longest)).alias("size"),
    )
    parts = max(1, -(-whole.count() // batch_items))
    dealt = pieces.repartition(parts)
    id_type = items.schema[id_col].dataType.simpleString()

    def packed(rows: pa.Table, first_bin: int) -> tuple[pa.RecordBatch, int]:
        sizes = rows["size"].to_numpy()
        order = np.lexsort((rows["piece"].to_numpy(), -sizes))
        filled = int(np.count_nonzero(sizes))
        bins, places, final = pack_batch(sizes[order[:filled]].tolist(), lengths, per_bin)
        nothing = [None] * (len(sizes) - filled)
        rows = rows.take(pa.array(order))
        columns = [rows[c].combine_chunks() for c in ("id", "piece", "start", "size")]
        columns += [
            pa.array([first_bin + b for b in bins] + nothing, pa.int64()),
            pa.array([final[b] for b in bins] + nothing, pa.int64()),
            pa.array(places + nothing, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(
            columns, names=["id", "piece", "start", "size", "bin", "bin_length", "bin_start"]
        ), first_bin + len(final)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        next_bin = TaskContext.get().partitionId() << 40
        held, count = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, batch_items):
                piece = batch.slice(start, batch_items)
                if held and count + piece.num_rows > batch_items:
                    out, next_bin = packed(pa.Table.from_batches(held), next_bin)
                    yield out
                    held, count = [], 0
                if piece.num_rows:
                    held.append(piece)
                    count += piece.num_rows
        if held:
            yield packed(pa.Table.from_batches(held), next_bin)[0]

    schema = f"id {id_type}, piece long, start long, size long, bin long, bin_length long, bin_start long"
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_col)
