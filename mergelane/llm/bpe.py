"""Byte-level BPE encoding and decoding with DuckDB queries inside every partition.

A text is cut into pieces by a pattern, and every distinct piece of a partition is encoded once: a
recursive query unnests the pieces to token positions, joins neighbouring tokens with the merge
table, and contracts each piece's leftmost pair of minimum rank until no pair of any piece is in the
table. Decoding joins ids with the vocabulary and aggregates the bytes in order.

Two tokens merge if their bytes together are a token, whose id is the rank, as in the tiktoken
library. Nothing is shuffled; a task holds a bounded cache of pieces and a DuckDB of bounded memory.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mergelane.llm.arrow import steps, texts

# Texts and pieces kept in each of two generations of a task's cache.
CACHE_ENTRIES = 120_000
# Pieces from this many bytes on contract all places of a minimum-rank pair in one round.
LONG_PIECE = 200
DUCKDB_MEMORY = "300MB"
# Texts encoded at once: enough to keep the queries' fixed cost low.
TEXTS_AT_ONCE = 1024

_SHORT = """
WITH RECURSIVE t AS (
  SELECT w, ids, false AS done FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT w, unnest(ids[:-2]) AS a, unnest(ids[2:]) AS b, unnest(range(1, len(ids))) AS i FROM t WHERE NOT done),
   best AS (SELECT w, min(id << 32 | i) AS best FROM pairs JOIN merges ON pair = (a << 20 | b) GROUP BY w)
   SELECT t.w,
     CASE WHEN best IS NULL THEN ids
          ELSE ids[:(best & 4294967295) - 1] || [best >> 32] || ids[(best & 4294967295) + 2:] END,
     best IS NULL
   FROM t LEFT JOIN best USING (w) WHERE NOT done)
)
SELECT w, ids FROM t WHERE done
"""

# One row per token. All places of the minimum-rank pair go at once, from the left and without overlap, if the
# new token begins and ends no token of a lower rank; then nothing that arises could have gone first.
_LONG = """
WITH RECURSIVE t AS (
  SELECT w, unnest(ids) AS id, unnest(range(1, len(ids) + 1)) AS i, false AS done FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT w, i, id, id << 20 | lead(id) OVER (PARTITION BY w ORDER BY i) AS pair FROM t WHERE NOT done),
   ranked AS (
     SELECT w, i, pairs.id, merges.id AS new, safe, min(merges.id) OVER (PARTITION BY w) AS low
     FROM pairs LEFT JOIN merges USING (pair)),
   hits AS (
     SELECT *, coalesce(new = low, false) AS hit, min(CASE WHEN new = low THEN i END) OVER (PARTITION BY w) AS first,
       i - row_number() OVER (PARTITION BY w, coalesce(new = low, false) ORDER BY i) AS run
     FROM ranked),
   taken AS (
     SELECT *, hit AND CASE WHEN safe
       THEN row_number() OVER (PARTITION BY w, hit, run ORDER BY i) % 2 = 1 ELSE i = first END AS take
     FROM hits),
   kept AS (SELECT *, lag(take, 1, false) OVER (PARTITION BY w ORDER BY i) AS gone FROM taken)
   SELECT w, CASE WHEN take THEN new ELSE id END, row_number() OVER (PARTITION BY w ORDER BY i), low IS NULL
   FROM kept WHERE NOT gone)
)
SELECT w, list(id ORDER BY i) AS ids FROM t WHERE done GROUP BY w
"""

_DECODE = """
SELECT w, unhex(coalesce(string_agg(hex, '' ORDER BY i), '')) AS bytes
FROM (SELECT w, unnest(ids) AS id, unnest(range(1, len(ids) + 1)) AS i FROM coded) LEFT JOIN vocabulary USING (id)
GROUP BY w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file (base64 token, blank, id per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Coder:
    """Encodes and decodes pieces with a DuckDB of its own."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import duckdb

        self.ranks = ranks
        self.bytes_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        left, right, new = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), new.append(rank)
        ends = np.array([left, right, new], dtype=np.int64)
        unsafe = np.unique(np.concatenate([side[side > ends[2]] for side in ends[:2]]))
        self.con = duckdb.connect(
            config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": tempfile.gettempdir()}
        )
        self.con.register("m", pa.table({"pair": ends[0] << 20 | ends[1], "id": ends[2], "safe": ~np.isin(ends[2], unsafe)}))
        self.con.execute("CREATE TABLE merges AS SELECT DISTINCT * FROM m")
        self.con.register("v", pa.table({"id": list(ranks.values()), "hex": [t.hex() for t in ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM v")

    def _lists(self, name: str, values: np.ndarray, sizes: np.ndarray, sql: str) -> pa.Table:
        """The rows of `sql` over a table (w, ids) of consecutive lists, in order of w."""
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int64)))
        self.con.register(name, pa.table({"w": pa.array(np.arange(len(sizes))), "ids": ids}))
        found = self.con.sql(f"SELECT * FROM ({sql}) ORDER BY w").to_arrow_table().combine_chunks()
        self.con.unregister(name)
        return found

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers. A piece that is a token is that token."""
        ranks = self.ranks
        out: list = [r.to_bytes(4, "little") if (r := ranks.get(p)) is not None else b"" for p in pieces]
        for sql, chosen in (
            (_SHORT, [i for i, p in enumerate(pieces) if not out[i] and 0 < len(p) < LONG_PIECE]),
            (_LONG, [i for i, p in enumerate(pieces) if not out[i] and len(p) >= LONG_PIECE]),
        ):
            if chosen:
                data = np.frombuffer(b"".join([pieces[i] for i in chosen]), dtype=np.uint8)
                sizes = np.fromiter((len(pieces[i]) for i in chosen), dtype=np.int64, count=len(chosen))
                ids = self._lists("start", self.bytes_ids[data], sizes, sql)["ids"].chunk(0)
                packed = np.asarray(ids.values).astype("<u4").tobytes()
                ends = (4 * np.asarray(ids.offsets, dtype=np.int64)).tolist()
                for i, start, end in zip(chosen, ends, ends[1:]):
                    out[i] = packed[start:end]
        return out

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids, packed as by `encode`."""
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        found = self._lists("coded", np.frombuffer(b"".join(packed), dtype="<u4"), sizes, _DECODE) if len(packed) else None
        out = [b""] * len(packed)
        if found is not None and found.num_rows:
            for w, own in zip(found["w"].to_pylist(), found["bytes"].to_pylist()):
                out[w] = own
        return out


class _Cache:
    """What is known by text, in two generations: the older one goes as a whole when the newer is full.

    `ids` holds ids and `back` decoded bytes, or `ids` both as a pair, which costs one access for both.
    """

    def __init__(self, entries: int) -> None:
        self.entries = entries
        self.ids: dict = {}
        self.back: dict = {}
        self.old: tuple[dict, dict] = {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys without an entry. The entries of the others stay until the next call."""
        if len(self.ids) > self.entries:
            self.old = self.ids, self.back
            self.ids, self.back = {}, {}
        keys = keys - self.ids.keys()
        again = keys & self.old[0].keys()
        for own, old in zip((self.ids, self.back), self.old):
            if old:
                own.update(zip(again, map(old.__getitem__, again)))
        return list(keys - again)


# A blank between two other characters that are no white space starts a piece of the usual patterns.
_WORD_START = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Encodes texts; keeps words (stretches from one single blank to the next) and pieces it has seen."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, blank_starts: bool) -> None:
        import regex

        self.coder = Coder(ranks)
        self.pieces_of = regex.compile(pattern).findall
        self.blank_starts = blank_starts
        self.words, self.pieces = _Cache(CACHE_ENTRIES), _Cache(CACHE_ENTRIES)

    def __call__(self, batch: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, bytes decoded from them) of each text."""
        # Nothing here refers to itself: looking for cycles among the kept pairs would cost a seventh of the time.
        collected = gc.isenabled()
        gc.disable()
        try:
            return self._coded(batch)
        finally:
            if collected:
                gc.enable()

    def _coded(self, batch: list[str]) -> list[tuple[bytes, bytes]]:
        cut = [_WORD_START.split(text) if self.blank_starts else [text] for text in batch]
        for words in cut:
            # Words are kept without the blank before them, and never start with one. The first has none before it.
            words[0] = " " + words[0]
        self._learn(set().union(*cut))
        known = self.words.ids.__getitem__
        return [tuple(map(b"".join, zip(*map(known, words)))) for words in cut]

    def _learn(self, words: set[str]) -> None:
        missing = self.words.missing(words)
        split = [self.pieces_of(w[1:] if w[:1] == " " else " " + w) for w in missing]
        unknown = self.pieces.missing(set().union(*split))
        packed = self.coder.encode([piece.encode() for piece in unknown])
        self.pieces.ids.update(zip(unknown, zip(packed, self.coder.decode(packed))))
        known = self.pieces.ids
        # A word of one piece shares its pair.
        self.words.ids.update(
            (w, known[own[0]] if len(own) == 1 else tuple(map(b"".join, zip(*map(known.__getitem__, own)))) or (b"", b""))
            for w, own in zip(missing, split)
        )


# One per Python worker: a worker runs many tasks.
_WORKER: dict = {}


def _of_worker(key: tuple, make):
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]


def _digest(ranks: dict[bytes, int]) -> str:
    return hashlib.sha256(repr(sorted(ranks.items(), key=lambda x: x[1])).encode()).hexdigest()


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
    blank_starts: bool = True,
) -> DataFrame:
    """Per row: its id, ``ids`` (binary: little-endian unsigned 32-bit integers), ``decoded`` (binary: from the ids).

    Each match of `pattern` (syntax of the regex library) is encoded on its own; special tokens are
    ordinary text. `blank_starts`: the pattern begins a new match at every blank that stands between
    two characters other than white space, as the usual patterns do; then texts may be cut there
    first. Texts are encoded whole. Null is an empty text, which has no ids. Rows stay as they are,
    repeated ones and null ids included; other columns go, whatever their names; an empty table gives
    an empty one. `ranks` must hold all 256 bytes, below 2^20 tokens; it travels to the tasks.
    """
    key = (_digest(ranks), pattern, blank_starts)
    packed = (list(ranks), list(ranks.values()))
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _of_worker(key, lambda: Encoder(dict(zip(*packed)), pattern, blank_starts))
        for batch in steps(batches, TEXTS_AT_ONCE):
            coded = encoder(texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([c[i] for c in coded], pa.binary()) for i in (0, 1)]],
                names=["id", "ids", "decoded"],
            )

    frame = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return frame.mapInArrow(run, f"id {id_type.simpleString()}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: its id and ``decoded`` (binary), from ids as `encode` packs them.

    Null ids are an empty text. Ids outside of the vocabulary decode to nothing.
    """
    key = (_digest(ranks), "decode")
    packed = (list(ranks), list(ranks.values()))
    id_type = coded.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _of_worker(key, lambda: Coder(dict(zip(*packed))))
        for batch in steps(batches, 64):
            own = [b or b"" for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(coder.decode(own), pa.binary())], names=["id", "decoded"]
            )

    frame = coded.select(coded[id_col].alias("id"), coded[ids_col].alias("ids"))
    return frame.mapInArrow(run, f"id {id_type.simpleString()}, decoded binary").withColumnRenamed("id", id_col)
