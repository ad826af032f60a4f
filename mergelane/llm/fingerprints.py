"""Document fingerprints: quartile bucket digests (Oliver et al., "TLSH", 2013), compared by a bounded difference.

Every run of three bytes of a text is hashed to a bucket. A bucket is coded by the quartile of the
bucket counts that its own count falls in, two bits each; the digest is that code behind one byte for
the length. Small edits move few buckets over a quartile.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelane.llm.arrow import steps, texts

BUCKETS = 256
# Steps of the length byte per factor e.
LENGTH_STEPS = 16
# Differences from here on count as nothing in common.
MAX_DIFFERENCE = 300
# Bytes of texts that one slice of the sorted corpus should hold.
SLICE_BYTES = 8 << 20

_SPREAD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def digest(data: bytes) -> bytes:
    """The digest of a text: one byte for its length, then two bits for each bucket.

    Texts under three bytes have no triplet and count their bytes padded with zeros; an empty one
    has all zeros.
    """
    if not data:
        return bytes(1 + BUCKETS // 4)
    padded = np.frombuffer(data.ljust(3, b"\0"), dtype=np.uint8)
    b = padded.astype(np.uint32)
    mixed = b[:-2] * _SPREAD[0] ^ b[1:-1] * _SPREAD[1] ^ b[2:] * _SPREAD[2]
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    counts = np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    ranked = np.sort(counts)
    quartiles = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = np.searchsorted(quartiles, counts, side="left").astype(np.uint8)
    packed = code[0::4] << 6 | code[1::4] << 4 | code[2::4] << 2 | code[3::4]
    length = min(255, 1 + int(LENGTH_STEPS * np.log(len(data))))
    return bytes([length]) + packed.tobytes()


# For two bytes of packed codes, the sum of the differences of their four codes; opposite quartiles count double.
def _byte_differences() -> np.ndarray:
    codes = np.arange(256)[:, None] >> np.array([6, 4, 2, 0]) & 3
    apart = np.abs(codes[:, None, :] - codes[None, :, :])
    return np.where(apart == 3, 6, apart).sum(axis=2)


_APART = _byte_differences()


def difference(a: bytes, b: bytes) -> int:
    """Difference of two digests: that of their buckets, and the steps in length beyond one."""
    x, y = (np.frombuffer(d, dtype=np.uint8) for d in (a, b))
    return int(_APART[x[1:], y[1:]].sum()) + max(0, abs(int(x[0]) - int(y[0])) - 1)


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 from MAX_DIFFERENCE on."""
    return 1.0 - min(difference(a, b), MAX_DIFFERENCE) / MAX_DIFFERENCE


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and ``fingerprint`` (hex). One pass, no shuffle.

    A null text is an empty one, whose fingerprint is all zeros. Rows stay as they are, repeated ones
    and null ids included; other columns go; an empty table gives an empty one. Equal texts have
    equal fingerprints.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            prints = [digest(t.encode()).hex() for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["id", "fingerprint"])

    frame = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return frame.mapInArrow(run, f"id {id_type}, fingerprint string").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """`text` with its last third (of code points, rounded down) replaced by as many first ones of `following`."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _slices(docs: DataFrame, slice_bytes: int) -> list[int]:
    """Ids at which the sorted corpus is cut, so that a slice holds about `slice_bytes`; one job over sizes, one over ids.

    Few, as each stands for many documents. Where they lie decides the balance of the slices, never the result.
    """
    size, least, most = docs.agg(F.sum("size"), F.min("id"), F.max("id")).first()
    n = int((size or 0) // slice_bytes) + 1
    if n == 1 or least is None:
        return []
    return sorted(set(docs.approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n))))


def _slice_of(ids: pa.Array, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slice of each id, the ids, and which are null. Slices count down, as ids do; null ids are in one behind all others."""
    empty = ids.is_null().to_numpy(zero_copy_only=False)
    plain = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    slices = np.where(empty, len(cuts) + 1, len(cuts) - np.searchsorted(cuts, plain, side="right"))
    return slices, plain, empty


def _firsts(ids: DataFrame, cuts: np.ndarray) -> dict[int, int | None]:
    """The largest id of every slice that has rows: one row a slice comes to the driver."""

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slices, plain, empty = _slice_of(batch.column(0), cuts)
            order = np.lexsort((plain, slices))
            last = order[np.append(slices[order][1:] != slices[order][:-1], True)] if len(order) else order
            yield pa.RecordBatch.from_arrays(
                [pa.array(slices[last].astype(np.int32)), pa.array(plain[last], mask=empty[last])], names=["slice", "top"]
            )

    tops = ids.mapInArrow(largest, "slice int, top long").groupBy("slice").agg(F.max("top").alias("top"))
    return {r["slice"]: r["top"] for r in tops.collect()}


def edit_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Fingerprints of every text, of its `edited` form with the next text, and their likeness.

    Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one that follows by descending id; the last one is followed by the
    first. Rows of equal id follow by their text, null ids come last; a single row follows itself.
    Null texts are empty. Other columns go; an empty table gives an empty one.

    The corpus is sorted in slices of ids, whose number comes from the bytes of all texts, or from `size_col` if that is given
    (a column known to hold the texts' sizes). Ids are cast to long.
    The first row of every slice is also sent to the slice before it, so that one shuffle
    brings every row together with the next one, and no task sees more than its slices.
    """
    size = F.coalesce(docs[size_col] if size_col else F.octet_length(docs[text_col]), F.lit(0)).cast("long")
    bare = docs.select(docs[id_col].cast("long").alias("id"), size.alias("size"))
    frame = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    cuts = np.array(_slices(bare, slice_bytes), dtype=np.int64)
    firsts = _firsts(bare.select("id"), cuts)
    filled = sorted(firsts)
    # The first row of a slice also goes to the filled slice before it, that of the first to the last.
    before = np.zeros(len(cuts) + 2, dtype=np.int32)
    top = np.zeros(len(cuts) + 2, dtype=np.int64)
    for i, s in enumerate(filled):
        before[s] = filled[i - 1]
        top[s] = firsts[s] or 0
    first = filled[0] if filled else 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            slices, ids, empty = _slice_of(batch.column(0), cuts)
            tops = np.flatnonzero(empty | (ids == top[slices]))
            # Copies stand behind the slice's own rows; those of the whole corpus' first row behind all.
            for rows, to, copy in (
                (np.arange(batch.num_rows), slices, np.zeros(batch.num_rows, dtype=np.int32)),
                (tops, before[slices[tops]], np.where(slices[tops] == first, 2, 1).astype(np.int32)),
            ):
                own = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to.astype(np.int32)), pa.array(copy), *own.columns], names=["slice", "copy", "id", "text"]
                )

    ordered = (
        frame.mapInArrow(deal, "slice int, copy int, id long, text string")
        .repartition(max(1, len(filled)), "slice")
        .sortWithinPartitions("slice", "copy", F.desc_nulls_last("id"), "text")
    )

    def row(id_: int | None, text: str, own_print: bytes, following: str, next_print: bytes) -> tuple:
        changed = edited(text, following).encode()
        edit_print = digest(changed)
        return (
            id_, len(text), hashlib.sha256(changed).hexdigest(), own_print.hex(), edit_print.hex(),
            likeness(own_print, edit_print), likeness(own_print, next_print),
        )

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (slice, id, text, digest) of a row whose next one is still to come
        for batch in steps(batches):
            rows = []
            for slice_, copy, id_, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                own_print = digest(text.encode())
                if waiting and waiting[0] == slice_:
                    rows.append(row(*waiting[1:], text, own_print))
                waiting = None if copy else (slice_, id_, text, own_print)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )

    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    out = ordered.mapInArrow(run, schema)
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
