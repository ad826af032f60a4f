"""Exact top-k search by inner product with a bit-sliced index.

The index holds vectors in blocks. Within a block every attribute is cut to its highest SLICES bits,
and each of those bits is a bitmap over the block's rows. A query's quantised scores come out of
bitmap arithmetic: the slices of each attribute, complemented for negative weights, are added once
for every set bit of the weight, by carry-save adders, into the slices of the sum. Going from the
most significant slice of the sum downward selects the best rows; rows that could still belong to
them, given what was cut off, are resolved with their exact values.

O'Neil and Quass, "Improved Query Performance with Variant Indexes", 1997; Guzun et al., "A
Two-Phase Bit-Sliced Index for Top-k", 2016.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits kept of every attribute.
SLICES = 6
# Rows of a block of the index, and queries that meet a block at once.
BLOCK_ROWS = 4096
CHUNK_QUERIES = 512
# Queries whose sums are formed together in a task.
_TOGETHER = 64
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def _bitmaps(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 as rows of 64-bit words."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


class Block:
    """Bit-sliced attributes of some vectors of equal dimension, with the exact values behind them."""

    def __init__(self, values: np.ndarray) -> None:
        """`values`: integers, one row a vector, at least one."""
        self.values = values
        self.low = int(values.min(initial=0))
        span = int(values.max(initial=0)) - self.low
        self.cut = max(0, span.bit_length() - SLICES)
        high = (values - self.low) >> self.cut
        self.words = -(-len(values) // 64)
        padded = np.zeros((values.shape[1], self.words * 64), dtype=np.int64)
        padded[:, : len(values)] = high.T
        self.slices = _bitmaps((padded[:, None, :] >> np.arange(SLICES)[:, None] & 1).astype(np.uint8))
        self.valid = _bitmaps((np.arange(self.words * 64) < len(values)).astype(np.uint8))
        # What is cut off differs from its middle by at most this length, in any row.
        middle = ((1 << self.cut) - 1) / 2
        cut_off = (values - self.low - (high << self.cut)) - middle
        self.reach = float(np.sqrt((cut_off * cut_off).sum(axis=1).max(initial=0)))

    def sums(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices (least first; queries x words) of the sums of |weight| * quantised attribute.

        Attributes of negative weights are complemented, which shifts a query's sums by a constant.
        """
        size = np.abs(weights)
        sign = np.where(weights < 0, _ONES, np.uint64(0))
        pending: list[list[np.ndarray]] = []

        def push(level: int, bitmap: np.ndarray) -> None:
            while True:
                while len(pending) <= level:
                    pending.append([])
                pending[level].append(bitmap)
                if len(pending[level]) < 3:
                    return
                a, b, c = pending[level]
                one = a ^ b
                pending[level] = [one ^ c]
                bitmap = (a & b) | (one & c)
                level += 1

        for j in range(weights.shape[1]):
            attribute = self.slices[j][:, None, :] ^ sign[None, :, j, None]
            for bit in range(int(size[:, j].max(initial=0)).bit_length()):
                chosen = np.where(size[:, j] >> bit & 1 > 0, _ONES, np.uint64(0))
                for level in range(SLICES):
                    push(bit + level, attribute[level] & chosen[:, None])
        out, level = [], 0
        nothing = np.zeros((len(weights), self.words), dtype=np.uint64)
        carry = nothing
        while level < len(pending) or carry.any():
            a, b = ((pending[level] if level < len(pending) else []) + [nothing, nothing])[:2]
            out.append(a ^ b ^ carry)
            carry = (a & b) | (carry & (a ^ b))
            level += 1
        return out

    def best(self, sums: list[np.ndarray], k: int, margin: np.ndarray) -> np.ndarray:
        """Rows (queries x rows, bool) whose sum is at most `margin` below the k-th largest of their query."""
        queries = len(margin)
        above = np.zeros((queries, self.words), dtype=np.uint64)
        equal = np.broadcast_to(self.valid, (queries, self.words)).copy()
        kth = np.zeros(queries, dtype=object)
        for level in range(len(sums) - 1, -1, -1):
            taken = above | (equal & sums[level])
            enough = np.bitwise_count(taken).sum(axis=1) >= k
            equal = np.where(enough[:, None], equal & sums[level], equal & ~sums[level])
            above = np.where(enough[:, None], above, taken)
            kth = kth + enough.astype(object) * (1 << level)
        # Sums of at least k-th - margin, compared with that bound from the highest slice down.
        bound = [max(0, int(t) - int(m)) for t, m in zip(kth, margin)]
        above = np.zeros((queries, self.words), dtype=np.uint64)
        equal = np.broadcast_to(self.valid, (queries, self.words)).copy()
        for level in range(len(sums) - 1, -1, -1):
            has = np.array([_ONES if b >> level & 1 else np.uint64(0) for b in bound], dtype=np.uint64)[:, None]
            above |= equal & sums[level] & ~has
            equal &= ~(sums[level] ^ has)
        rows = np.unpackbits((above | equal).view(np.uint8), axis=1, bitorder="little")
        return rows[:, : len(self.values)].astype(bool)

    def search(self, weights: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (rows, scores): the k largest scores and all that equal the last of them."""
        out = []
        exact = float(np.abs(weights).max(initial=0)) * float(np.abs(self.values).max(initial=0)) * max(1, weights.shape[1])
        # Doubles hold such scores exactly, and so do 64-bit integers up to their range; beyond, Python's.
        kind = np.float64 if exact < 2**53 else np.int64 if exact < 2**62 else object
        values = self.values.astype(kind)
        for start in range(0, len(weights), _TOGETHER):
            some = weights[start : start + _TOGETHER]
            length = np.sqrt((some.astype(np.float64) ** 2).sum(axis=1))
            margin = np.ceil(2 * (length * self.reach * (1 + 1e-9) + 1e-6) / 2**self.cut) if self.cut else np.zeros(len(some))
            for weight, near in zip(some, self.best(self.sums(some), k, margin)):
                rows = np.flatnonzero(near)
                scores = values[rows] @ weight.astype(kind)
                if len(rows) > k:
                    last = np.sort(scores)[-k]
                    rows, scores = rows[scores >= last], scores[scores >= last]
                out.append((rows, scores))
        return out


def quantised(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component as double; null for a vector that is null or has a null or non-finite one."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(wide, lambda x: F.floor(x * F.lit(float(factor)))))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, factor: int = 256, id_col: str = "vec_id",
    vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """Per query and rank (from 1): query_id, rank, the found row's id, and score, exactly.

    Queries are the rows for which `is_query` (over the columns of `vectors`) holds; candidates all rows
    of another id and the same dimension. The score is the inner product of the components, each
    floor(factor * x); ties go to the smaller id. Fewer candidates than `k` give fewer rows. Rows with a null id, or a
    vector that is null or holds null or non-finite components, take no part. A repeated row is a
    candidate each time, and as a query it gives its result each time. Other columns go; an empty table gives an empty one. Scores
    beyond 64 bits are an error.

    Rows are dealt to blocks of about `block_rows`, queries to chunks of about `chunk_queries`; every
    block meets every chunk in a group of its own, and keeps k rows a query (all that tie for the last place) of it. So a
    task holds one block and one chunk, however many rows are alike.
    """
    bare = vectors.select(
        vectors[id_col].cast("long").alias("id"), quantised(vectors[vector_col], factor).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    n, asking = bare.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-asking // chunk_queries))
    row = F.monotonically_increasing_id()
    numbered = bare.withColumn("row", row).withColumn("dim", F.size("v"))
    deal = F.xxhash64("row")
    keys = ["dim", "block", "chunk"]
    left = numbered.select(
        "dim", F.pmod(deal, F.lit(blocks)).alias("block"), "id", "v",
        F.explode(F.expr(f"sequence(0L, {chunks - 1}L)")).alias("chunk"),
    )
    right = numbered.filter("asks").select(
        "dim", F.pmod(deal, F.lit(chunks)).alias("chunk"), "row", "id", "v",
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
    )

    def meet(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = {"row": [], "query_id": [], "id": [], "score": []}
        if len(rows) and len(queries):
            ids = rows["id"].to_numpy()
            own = np.array(rows["v"].tolist(), dtype=np.int64).reshape(len(rows), -1)
            weights = np.array(queries["v"].tolist(), dtype=np.int64).reshape(len(queries), -1)
            # A query's own rows are left out after the search, which looks for as many more.
            repeated = pd.Series(ids).value_counts()
            more = int(repeated.reindex(queries["id"].unique()).fillna(0).max())
            found = Block(own).search(weights, k + more)
            for row_, query, (at, scores) in zip(queries["row"], queries["id"], found):
                others = ids[at] != query
                at, scores = ids[at][others], scores[others]
                order = np.lexsort((at, -scores))[:k]
                columns["row"] += [row_] * len(order)
                columns["query_id"] += [query] * len(order)
                columns["id"] += at[order].tolist()
                columns["score"] += [int(s) for s in scores[order]]
        return pd.DataFrame(columns)

    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        meet, "row long, query_id long, id long, score long"
    )
    ranked = met.withColumn(
        "rank", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "id"))
    ).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
