"""URL filters by a sorted array of 64-bit digests with the full strings behind it.

A list of rules (host suffix and path prefix) is kept as a file: the sorted xxhash keys of the rules,
then their strings. Tasks memory-map the file, probe it for all hosts and path prefixes of a batch of
urls with one vectorised binary search, and confirm every hit against the stored string, so that
colliding digests decide nothing.

Small lists travel to the tasks (`filter_urls`; the size is checked). Large ones are split by digest
over the cluster and meet the distinct keys of the urls there (`filter_urls_by_table`).
"""

from __future__ import annotations

import os
import tempfile
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelane.llm.arrow import steps, texts
from mergelane.session import materialize

# Rules that may travel to every task: at this size a file of some 100 MB.
MAX_LOCAL_RULES = 1_000_000
# Rules of a large list, or keys of urls that meet them, in one shard.
SHARD_RULES = 500_000
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class Rule:
    """`verdict` (allow or block) for a host with all its subdomains, and paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    host, slash, path = rest[:cut].partition("/")
    return host.translate(_LOWER), slash + path


def host_suffixes(host: str) -> list[str]:
    """The host and the domains it lies in: a.b.c, b.c, c. None for an empty host."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))] if host else []


def digests(keys: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))


class DigestArray:
    """A file of sorted 64-bit digests and the strings they stand for.

    Layout: number of keys; digests, ascending; offsets of the strings; the strings. All numbers are
    little-endian 64-bit integers. Equal digests of different strings stand next to each other.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        n = int(np.fromfile(path, dtype="<u8", count=1)[0])
        self.keys = np.memmap(path, dtype="<u8", mode="r", offset=8, shape=(n,)) if n else np.zeros(0, "<u8")
        self.offsets = np.memmap(path, dtype="<u8", mode="r", offset=8 + 8 * n, shape=(n + 1,))
        size = int(self.offsets[-1])
        start = 8 + 8 * n + 8 * (n + 1)
        self.strings = np.memmap(path, dtype=np.uint8, mode="r", offset=start, shape=(size,)) if size else b""

    @staticmethod
    def pack(keys: Sequence[bytes]) -> tuple[bytes, np.ndarray]:
        """The file's bytes, and for each place in it the place of its key in `keys`."""
        own = digests(keys)
        order = np.argsort(own, kind="stable")
        sizes = np.fromiter((len(keys[i]) for i in order), dtype="<u8", count=len(keys))
        offsets = np.concatenate([np.zeros(1, "<u8"), np.cumsum(sizes, dtype="<u8")])
        head = np.array([len(keys)], dtype="<u8").tobytes()
        return head + own[order].astype("<u8").tobytes() + offsets.tobytes() + b"".join(keys[i] for i in order), order

    def probe(self, keys: Sequence[bytes], of: np.ndarray | None = None) -> np.ndarray:
        """The place of each key in the array, or -1. `of`: the keys' digests, if they are known."""
        of = digests(keys) if of is None else of
        out = np.full(len(keys), -1, dtype=np.int64)
        at = np.searchsorted(self.keys, of, side="left")
        hits = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == of)) if len(
            self.keys
        ) else []
        for i in hits:
            place = int(at[i])
            while place < len(self.keys) and self.keys[place] == of[i]:
                if bytes(self.strings[int(self.offsets[place]) : int(self.offsets[place + 1])]) == keys[i]:
                    out[i] = place
                    break
                place += 1
        return out


class _TempArray:
    """A digest array in a file of this machine, which goes when the block ends; only this task reads it."""

    def __init__(self, packed: bytes) -> None:
        self.packed = packed

    def __enter__(self) -> DigestArray:
        handle, self.path = tempfile.mkstemp(suffix=".digests")
        with os.fdopen(handle, "wb") as out:
            out.write(self.packed)
        return DigestArray(self.path)

    def __exit__(self, *_) -> None:
        os.unlink(self.path)


def _candidates(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Texts of all rules that could fit, the longest first: per host suffix, the path cut to the rules' lengths (ascending)."""
    own = lengths[: bisect_right(lengths, len(path))]
    fits = [suffix + path[:n] for suffix in host_suffixes(host) for n in own]
    return sorted(set(fits), key=lambda x: (-len(x), x))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Per row: its id, host, path, rule (text of the rule that decides, else null) and verdict.

    The longest fitting rule decides (of equally long ones the first by text); without one it is
    `default`. A null url, or one without ``://``, has an empty host and path and fits no rule. Rows
    stay as they are, repeated ones and null ids included; other columns go; an empty table gives an
    empty one. Two rules of one text must not disagree. The rules travel to the tasks, at most MAX_LOCAL_RULES of them;
    see `filter_urls_by_table` for more.
    """
    verdicts: dict[str, str] = {}
    for rule in rules:
        if verdicts.setdefault(rule.text, rule.verdict) != rule.verdict:
            raise ValueError(f"two rules of the text {rule.text} disagree")
    if len(verdicts) > MAX_LOCAL_RULES:
        raise ValueError(f"{len(verdicts)} rules are too many to send to every task; use filter_urls_by_table")
    packed, order = DigestArray.pack([t.encode() for t in verdicts])
    by_place = [list(verdicts.items())[i] for i in order]
    lengths = sorted({len(r.path) for r in rules})
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _TempArray(packed) as array:
            for batch in steps(batches, 4096):
                parts = [host_and_path(u) for u in batch.column(1).to_pylist()]
                candidates = [_candidates(h, p, lengths) for h, p in parts]
                places = array.probe([c.encode() for own in candidates for c in own])
                at, decided = 0, []
                for own in candidates:
                    hits = [p for p in places[at : at + len(own)].tolist() if p >= 0]
                    decided.append(by_place[hits[0]] if hits else (None, default))
                    at += len(own)
                columns = [*zip(*parts), *zip(*decided)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, pa.string()) for c in columns]],
                    names=["id", "host", "path", "rule", "verdict"],
                )

    frame = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"))
    schema = f"id {id_type}, host string, path string, rule string, verdict string"
    return frame.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def filter_urls_by_table(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
    shard_rules: int = SHARD_RULES,
) -> DataFrame:
    """As `filter_urls`, for rules in a table (verdict, host, path) of any size.

    The distinct keys that the urls' hosts and paths could meet are split by digest into shards, each
    probed in the digest array of its rules; there are as many shards as the larger of the two needs. Keys are made
    distinct before they are shuffled, so a host or path that most urls share is one key; they are written once. Rules with a null go; of two rules of one text that disagree, block holds.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    listed = rules.dropna(subset=["verdict", "host", "path"])
    lengths = sorted(r[0] for r in listed.select(F.length("path")).distinct().collect())
    texts_ = (
        listed.withColumn("text", F.concat("host", "path")).groupBy("text").agg(F.max("verdict").alias("verdict"))
    )  # "block" is larger than "allow"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 4096):
            own = [host_and_path(u) for u in texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c, pa.string()) for c in zip(*own)],
                    pa.array([_candidates(h, p, lengths) for h, p in own], pa.list_(pa.string())),
                ],
                names=["url", "host", "path", "texts"],
            )

    urls = pages.select(pages[url_col].alias("url")).distinct()
    split = urls.mapInArrow(parts, "url string, host string, path string, texts array<string>")
    keys = materialize(split.select(F.explode("texts").alias("text")).distinct(), "url-keys")
    shards = max(1, -(-max(keys.count(), texts_.count()) // shard_rules))
    shard = F.pmod(F.xxhash64("text"), F.lit(shards))

    def probe(key: pd.DataFrame, listed_: pd.DataFrame) -> pd.DataFrame:
        strings = [t.encode() for t in listed_["text"]]
        packed, order = DigestArray.pack(strings)
        with _TempArray(packed) as array:
            places = array.probe([t.encode() for t in key["text"]])
        hit = places >= 0
        verdicts = listed_["verdict"].to_numpy()[order][places[hit]]
        return pd.DataFrame({"text": key["text"].to_numpy()[hit], "verdict": verdicts})

    hits = (
        keys.withColumn("shard", shard).groupBy("shard")
        .cogroup(texts_.withColumn("shard", shard).groupBy("shard"))
        .applyInPandas(probe, "text string, verdict string")
    )
    fits = split.select("url", F.explode("texts").alias("text")).join(hits, "text")
    best = fits.groupBy("url").agg(
        F.min_by(F.struct("text", "verdict"), F.struct(-F.length("text"), F.col("text"))).alias("best")
    )
    judged = split.select("url", "host", "path").join(best, "url", "left")
    mine = pages.select(pages[id_col].alias("id"), pages[url_col].alias("own"))
    return mine.join(judged, F.col("own") == F.col("url"), "left").select(
        F.col("id").cast(id_type).alias(id_col),
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.col("best.text").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
