"""Near-duplicate embeddings by an inverted multi-index (Babenko and Lempitsky, CVPR 2012).

Two codebooks, one for each half of the vectors, form a grid of cells. A vector is stored in the cell of its nearest
codewords and looks for others in the cells around it, which the multi-sequence traversal gives in the order of their
distance: the two lists of codewords, each by distance, are merged through a heap. How far to go is found on the
sample that the codebooks are fitted to: as much farther than the own cell as brings the target share of the neighbours at the
threshold into view. Whoever meets in a cell is compared exactly.

1. Equal vectors are one class from here on.
2. Codewords come from a bounded sample, thinned so that no two of its vectors are close: a group of thousands
   of near copies has a few cells then, not most of them.
3. Cells with more than a strip of classes are made smaller: what lies within a small angle of one centre becomes
   a ball, whose members all link to each other. A ball stands for its members as long as the triangle inequality settles
   whether all or none of them link; only where it does not, its members are compared themselves.
4. The rest of a large cell is cut into strips that meet each other strip once, so tasks stay small at any skew.

Links are counted where they are found, and a tile gives one row a vector: pairs are never written.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelane.llm.arrow import steps
from mergelane.llm.components import components, joined
from mergelane.session import materialize

# Vectors that the index is fitted to, at most about that many; it holds all others as well.
SAMPLE_ROWS = 16_384
# The share of neighbours at the threshold that the traversal has to bring into view.
TARGET = 0.97
# Codewords of a half, at most; fewer for few vectors.
MOST_WORDS = 1_024
# Vectors of one side of a tile.
STRIP = 1_024
# Cells of more than a strip that are so many times as large as the mean are searched for balls.
CROWDED = 8
# Vectors of fewer components have no halves worth an index: they are compared in strips.
LEAST_DIM = 8
# Rounds that look for balls in a crowded cell; what is left after them is compared in strips.
BALL_ROUNDS = 4
# Angles in radians that decide for a whole ball keep this distance from the threshold.
MARGIN = 1e-6


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """The rows in double precision, scaled to length 1."""
    rows = matrix.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=0.0)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose lists have one length, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not all zero, all components finite numbers."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(wide, lambda x: x != 0.0), F.lit(False))


# --- the index -------------------------------------------------------------------------------------


@dataclass
class Index:
    """Codewords of both halves, and how much farther than its own cell a vector looks."""

    first: np.ndarray
    second: np.ndarray
    slack: float

    @property
    def dim(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves of each row from all codewords."""
        half = self.first.shape[1]
        return _squared(units[:, :half], self.first), _squared(units[:, half:], self.second)

    def place(self, units: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The cell of each row, and the other cells that it looks into."""
        one, two = self.distances(units)
        order_one, order_two = np.argsort(one, axis=1), np.argsort(two, axis=1)
        near_one, near_two = np.take_along_axis(one, order_one, 1), np.take_along_axis(two, order_two, 1)
        wide = len(self.second)
        cells = order_one[:, 0] * wide + order_two[:, 0]
        visits = []
        for i in range(len(units)):
            found = multi_sequence(near_one[i].tolist(), near_two[i].tolist(), self.slack)
            a, b = order_one[i], order_two[i]
            visits.append([int(a[x]) * wide + int(b[y]) for x, y in found[1:]])
        return cells, visits


def _squared(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(1)[:, None] - 2 * rows @ words.T + (words * words).sum(1)


def multi_sequence(one: list[float], two: list[float], slack: float) -> list[tuple[int, int]]:
    """Positions (x, y) of two ascending lists by rising ``one[x] + two[y]``, up to `slack` above the first."""
    bound = one[0] + two[0] + slack
    heap, found = [(one[0] + two[0], 0, 0)], []
    while heap and heap[0][0] <= bound:
        _, x, y = heapq.heappop(heap)
        found.append((x, y))
        if y + 1 < len(two):
            heapq.heappush(heap, (one[x] + two[y + 1], x, y + 1))
        if y == 0 and x + 1 < len(one):
            heapq.heappush(heap, (one[x + 1] + two[0], x + 1, 0))
    return found


def _thinned(units: np.ndarray, cosine: float) -> np.ndarray:
    """Rows of which no two have that cosine, and each other row has it with one of them."""
    kept = units[:0]
    for start in range(0, len(units), 1024):
        block = units[start : start + 1024]
        block = block[(block @ kept.T < cosine).all(axis=1)] if len(kept) else block
        close = np.tril(block @ block.T >= cosine, -1)
        stays = np.ones(len(block), dtype=bool)
        for i in range(len(block)):
            stays[i] = not (close[i] & stays).any()
        kept = np.concatenate([kept, block[stays]])
    return kept


def _codewords(rows: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """n means of the rows (Lloyd's algorithm)."""
    words = rows[rng.choice(len(rows), n, replace=False)].copy()
    for _ in range(12):
        nearest = _squared(rows, words).argmin(axis=1)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=n)
        held = counts > 0
        words[held] = sums[held] / counts[held, None]
    return words


def fit_index(sample: np.ndarray, n: int, threshold: float, target: float | None = TARGET) -> Index:
    """An index for `n` vectors fitted to some of them; without `target` every cell is looked into."""
    rng = np.random.default_rng(7)
    # In an order of their own, so that the same vectors give the same index.
    units = unit_rows(sample[np.lexsort(sample.T)])
    spread = _thinned(units, math.cos(math.acos(threshold) / 2))
    half = units.shape[1] // 2
    words = min(MOST_WORDS, 2 ** max(1, round(math.log2(math.sqrt(n) / 4 + 1))), max(1, len(spread) // 4))
    index = Index(_codewords(spread[:, :half], words, rng), _codewords(spread[:, half:], words, rng), math.inf)
    if target is not None:
        index.slack = _slack(index, units[rng.permutation(len(units))[:4096]], threshold, target, rng)
    return index


def _slack(index: Index, units: np.ndarray, threshold: float, target: float, rng: np.random.Generator) -> float:
    """How far the traversal has to go for the target share of neighbours: planted ones at the threshold, and real ones."""
    # A neighbour at exactly the threshold, in a random direction.
    aside = rng.normal(size=units.shape)
    aside -= (aside * units).sum(1)[:, None] * units
    planted = threshold * units + math.sqrt(1 - threshold * threshold) * unit_rows(aside)
    needed = [_distance_to_meet(index, units, planted)]
    cosines = units @ units.T
    np.fill_diagonal(cosines, -1.0)
    linked = np.where(cosines >= threshold, cosines, np.inf)
    farthest = linked.argmin(axis=1)
    has = np.isfinite(linked[np.arange(len(units)), farthest])
    if has.any():
        needed.append(_distance_to_meet(index, units[has], units[farthest[has]]))
    return max(float(np.quantile(x, target)) for x in needed) + 1e-9


def _distance_to_meet(index: Index, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of a and b, how far beyond its cell the one has to look that finds the other's first."""
    (a1, a2), (b1, b2) = index.distances(a), index.distances(b)
    at = np.arange(len(a))
    one = a1[at, b1.argmin(1)] + a2[at, b2.argmin(1)] - a1.min(1) - a2.min(1)
    two = b1[at, a1.argmin(1)] + b2[at, a2.argmin(1)] - b1.min(1) - b2.min(1)
    return np.minimum(one, two)


def _placed(classes: DataFrame, index: Index | None) -> DataFrame:
    """`classes` with cell and visits; vectors of other dimensions are in a cell of their dimension, below 0."""
    dim = index.dim if index else -1
    schema = f"cid long, rows long, vector {classes.schema['vector'].dataType.simpleString()}, cell long, visits array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1024):
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            cells, visits = -sizes.astype(np.int64), [[] for _ in sizes]
            mine = np.flatnonzero(sizes == dim)
            if len(mine):
                found, looked = index.place(unit_rows(_matrix(batch.column(2).take(pa.array(mine)))))
                cells[mine] = found
                for i, cells_of in zip(mine.tolist(), looked):
                    visits[i] = cells_of
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(cells), pa.array(visits, pa.list_(pa.int32()))],
                names=["cid", "rows", "vector", "cell", "visits"],
            )

    return classes.select("cid", "rows", "vector").mapInArrow(run, schema)


# --- balls -----------------------------------------------------------------------------------------


def _balls(placed: DataFrame, strip: int, threshold: float) -> tuple[DataFrame, DataFrame | None]:
    """The units to compare (uid, weight, radius, vector, cell, visits), and cid and uid of the members of balls.

    A class that is in no ball is a unit of its own, with its cid as uid; balls have uids below 0.
    """
    kind = placed.schema["vector"].dataType
    radius = 0.45 * math.acos(threshold)
    rest, members, centres = placed, [], []
    mean = placed.groupBy("cell").count().agg(F.avg("count")).first()[0] or 0
    for round_ in range(BALL_ROUNDS):
        crowded = rest.groupBy("cell").count().filter((F.col("count") > strip) & (F.col("count") > CROWDED * mean))
        crowded = materialize(crowded.select("cell"), "crowded")
        if crowded.isEmpty():
            break
        inside = rest.join(crowded, "cell")
        if round_ == 0:  # the mean of a cell is amid its largest group
            vectors = inside.select("cell", array_to_vector("vector").alias("wide"))
            units = Normalizer(inputCol="wide", outputCol="unit").transform(vectors)
            means = units.groupBy("cell").agg(vector_to_array(Summarizer.mean(F.col("unit"))).alias("centre"))
        else:
            means = inside.groupBy("cell").agg(F.min_by("vector", F.xxhash64(F.lit(round_), "cid")).alias("centre"))
        means = means.select("cell", F.col("centre").cast(kind).alias("centre")).filter(F.exists("centre", lambda x: x != 0))
        dot = lambda a, b: F.aggregate(
            F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x
        )
        cosine = dot("vector", "centre") / F.sqrt(dot("vector", "vector")) / F.sqrt(dot("centre", "centre"))
        angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
        near = inside.join(means, "cell").withColumn("angle", angle).filter(F.col("angle") <= radius)
        near = materialize(near.select("cid", "rows", "cell", "visits", "centre", "angle"), "near")
        large = near.groupBy("cell").count().filter(F.col("count") > strip // 16).select("cell")
        near = near.join(large, "cell")
        if near.isEmpty():
            continue
        heads = near.groupBy("cell").agg(
            (-1 - F.min("cid")).alias("uid"), F.sum("rows").alias("weight"), (F.max("angle") + MARGIN).alias("radius"),
            F.first("centre").alias("vector"),
        )
        looked = near.select("cell", F.explode("visits").alias("to")).distinct().groupBy("cell").agg(
            F.collect_list("to").alias("visits")
        )
        heads = heads.join(looked, "cell", "left").withColumn("visits", F.coalesce("visits", F.array().cast("array<int>")))
        heads = materialize(heads, "heads")
        centres.append(heads)
        members.append(near.select("cid", "cell").join(heads.select("cell", "uid"), "cell").select("cid", "uid"))
        rest = materialize(rest.join(near.select("cid"), "cid", "left_anti"), "rest")
    units = rest.select("cell", F.col("cid").alias("uid"), F.col("rows").alias("weight"), F.lit(0.0).alias("radius"), "vector", "visits")
    if not members:
        return units, None
    belongs = members[0]
    for more in members[1:]:
        belongs = belongs.unionByName(more)
    for heads in centres:
        units = units.unionByName(heads.select(units.columns))
    return materialize(units, "units"), materialize(belongs, "members")


# --- comparison ------------------------------------------------------------------------------------


def _tile(cell: int, left: dict, right: dict, threshold: float, inner: bool) -> tuple[list, list]:
    """Rows (uid, links, label) of what links in a tile, and pairs (uid, uid) that the members of a ball have to settle."""
    cosine = left["unit"] @ right["unit"].T
    home = right["home"]
    mask = np.ones(cosine.shape, dtype=bool)
    stay = home == cell
    mask[:, stay] = (left["uid"][:, None] < right["uid"][None, stay]) if inner else False
    # A pair that also meets in the other's cell counts in the lower one.
    of_home: dict[int, list[int]] = {}
    for j in np.flatnonzero(home < cell).tolist():
        of_home.setdefault(int(home[j]), []).append(j)
    for i, visits in enumerate(left["visits"]):
        for c in visits:
            if c in of_home:
                mask[i, of_home[c]] = False
    reach = left["radius"][:, None] + right["radius"][None, :]
    linked = (cosine >= threshold) & mask
    pairs = []
    if reach.any():
        angle, most = np.arccos(np.clip(cosine, -1.0, 1.0)), math.acos(threshold)
        large = reach > 0
        sure = large & mask & (angle + reach <= most - MARGIN)
        open_ = large & mask & ~sure & (angle - reach <= most + MARGIN)
        linked = np.where(large, sure, linked)
        a, b = np.nonzero(open_)
        pairs = list(zip(left["uid"][a].tolist(), right["uid"][b].tolist()))
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return [], pairs
    some = linked[np.ix_(rows, cols)]
    one, two = joined(some, left["uid"][rows], right["uid"][cols])
    counts_one = some @ right["weight"][cols].astype(np.float64)
    counts_two = some.T @ left["weight"][rows].astype(np.float64)
    found = list(zip(left["uid"][rows].tolist(), counts_one.astype(np.int64).tolist(), one.tolist()))
    found += zip(right["uid"][cols].tolist(), counts_two.astype(np.int64).tolist(), two.tolist())
    return found, pairs


def _compare(held: DataFrame, strip: int, threshold: float, inner: bool) -> DataFrame:
    """uid, links, label, other: what links in the cells, a row a vector and tile; `other` names pairs left open.

    `held` has cell, uid, home, weight, radius, vector, visits; what is at home in a cell meets all that is held in
    it, itself included if `inner`. Rows are dealt to strips by a hash; each strip of what is at home meets every strip of
    the cell in a tile of its own, and several small tiles are one group.
    """
    at_home = F.col("home") == F.col("cell")
    counts = held.groupBy("cell").agg(
        F.ceil(F.count(F.when(at_home, 1)) / strip).alias("high"), F.ceil(F.count(F.lit(1)) / strip).alias("wide"),
        F.count(F.lit(1)).alias("n"),
    ).filter("high > 0 AND n > 1")
    counts = materialize(counts, "cells")
    total = counts.agg(F.sum(F.expr("n * greatest(1, high)"))).first()[0] or 0
    groups = max(1, int(total // (4 * strip)))
    deal, several = F.xxhash64("uid"), F.col("high") * F.col("wide") > 1
    row, col = F.pmod(deal, F.col("high")), F.pmod(F.xxhash64(F.lit(1), "uid"), F.col("wide"))
    tile = lambda r, c, side: F.struct(r.alias("r"), c.alias("c"), F.lit(side).alias("side"))
    across = F.transform(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1), lambda c: tile(row, c, 0))
    down = F.transform(F.sequence(F.lit(0).cast("long"), F.col("high") - 1), lambda r: tile(r, col, 1))
    zero = F.lit(0).cast("long")
    places = (
        F.when(several & at_home, F.concat(across, down)).when(several, down)
        .when(at_home, F.array(tile(zero, zero, 2))).otherwise(F.array(tile(zero, zero, 1)))
    )
    kept = ["uid", "home", "weight", "radius", "vector", "visits"]
    copies = held.join(counts, "cell").select("cell", *kept, F.explode(places).alias("t")).select("cell", "t.*", *kept)
    dealt = copies.withColumn("group", F.pmod(F.xxhash64("cell", "r", "c"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        found, pairs = [], []
        cells, r, c = (table.column(n).to_numpy() for n in ("cell", "r", "c"))
        order = np.lexsort((c, r, cells))
        changes = np.flatnonzero(np.any([np.diff(x[order]) != 0 for x in (cells, r, c)], axis=0)) + 1
        for at in np.split(order, changes):
            part = table.take(pa.array(at))
            side = part.column("side").to_numpy()
            whole = {n: part.column(n).to_numpy() for n in ("uid", "home", "weight", "radius")}
            whole["unit"] = unit_rows(_matrix(part.column("vector")))
            visits = part.column("visits").to_pylist()
            sides = []
            for other in (1, 0):
                mine = np.flatnonzero(side != other)
                sides.append({n: v[mine] for n, v in whole.items()} | {"visits": [visits[i] for i in mine]})
            if len(sides[0]["uid"]) and len(sides[1]["uid"]):
                some, open_ = _tile(int(cells[at[0]]), *sides, threshold, inner)
                found += some
                pairs += open_
        uid, links, label = zip(*found) if found else ((), (), ())
        one, two = zip(*pairs) if pairs else ((), ())
        long = pa.int64()
        return pa.table({
            "uid": pa.array([*uid, *one], long), "links": pa.array([*links, *[0] * len(one)], long),
            "label": pa.array([*label, *[None] * len(one)], long), "other": pa.array([*[None] * len(uid), *two], long),
        })

    return dealt.groupBy("group").applyInArrow(run, "uid long, links long, label long, other long")


def _probes(units: DataFrame) -> DataFrame:
    """Each unit in its own cell and in all those that it looks into."""
    cells = F.concat(F.array("cell"), F.transform("visits", lambda v: v.cast("long")))
    kept = ["uid", F.col("cell").alias("home"), "weight", "radius", "vector"]
    away = F.array().cast("array<int>")
    placed = units.select(F.posexplode(cells).alias("nth", "to"), *kept, "visits")
    return placed.select(
        F.col("to").alias("cell"), "uid", "home", "weight", "radius", "vector",
        F.when(F.col("nth") == 0, F.col("visits")).otherwise(away).alias("visits"),
    )


def _members_of_open_pairs(open_: DataFrame, units: DataFrame, placed: DataFrame, members: DataFrame) -> DataFrame:
    """For each open pair the members of both sides, held in a cell named by the ball of one of them."""
    balls = units.filter("radius > 0").select(F.col("uid").alias("ball"))
    first = open_.join(balls, F.col("uid") == F.col("ball")).select("ball", "other")
    second = open_.join(balls, F.col("uid") == F.col("ball"), "left_anti")
    keyed = materialize(first.unionAll(second.select(F.col("other").alias("ball"), F.col("uid").alias("other"))), "open")
    belongs = members.select(F.col("uid").alias("of"), "cid")
    at_home = keyed.select("ball").distinct().join(belongs, F.col("ball") == F.col("of")).select("ball", "cid", F.col("ball").alias("home"))
    away = keyed.join(belongs, F.col("other") == F.col("of"), "left").select(
        "ball", F.coalesce("cid", "other").alias("cid"), F.col("other").alias("home")
    )
    return at_home.unionByName(away).join(placed.select("cid", "rows", "vector"), "cid").select(
        F.col("ball").alias("cell"), F.col("cid").alias("uid"), "home", F.col("rows").alias("weight"),
        F.lit(0.0).alias("radius"), "vector", F.array().cast("array<int>").alias("visits"),
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, target: float | None = TARGET, strip: int = STRIP,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Per row: its id, n_links, component_id and kept, of the links with a cosine of at least `threshold`.

    n_links counts the other rows that it links with; component_id is the smallest id reachable by links, itself
    included; kept tells whether that is its own id. Cosines are computed in double precision; no link lies below the
    threshold, and the traversal is tuned to see the share `target` of neighbours at it (more of nearer ones);
    with None it visits all cells and the result is exact. Only vectors of the same dimension are compared; the
    commonest one has the index, the others are compared in strips. Vectors that are null or zero, or hold null or
    non-finite components, link with nothing: 0 links, their own id, kept. Rows that repeat an id each stand for
    themselves. Rows with a null id take part but name no component as long as another id does; kept then is false, and true
    if null is their component. Other columns go; an empty table gives an empty one. Jobs run while it is planned.
    """
    if not 0 < threshold < 1:
        raise ValueError(f"threshold is between 0 and 1, not {threshold}")
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("vector")).withColumn("usable", usable(F.col("vector")))
    found = rows.filter("usable").groupBy("vector").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("least"))
    classes = materialize(found.withColumn("cid", F.monotonically_increasing_id()), "classes")
    sized = classes.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    index = None
    if sized and sized["dim"] >= LEAST_DIM:
        some = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_ROWS / sized["count"]))
        sample = classes.filter((F.size("vector") == sized["dim"]) & some).select("vector").toArrow()
        if sample.num_rows:
            index = fit_index(_matrix(sample.column(0)), sized["count"], threshold, target)
    placed = materialize(_placed(classes, index), "placed")
    units, members = _balls(placed, strip, threshold)
    met = materialize(_compare(_probes(units), strip, threshold, inner=True), "met")
    closed = met.filter("other IS NULL")
    unit_links = closed.groupBy("uid").agg(F.sum("links").alias("links"))
    edges = closed.select(F.col("uid").alias("src"), F.col("label").alias("dst"))
    per_class = classes.select("cid", "rows", "least", "vector")
    if members is None:
        mapped = per_class.withColumns({"uid": F.col("cid"), "weight": F.col("rows"), "more": F.lit(0)})
    else:
        open_ = met.filter("other IS NOT NULL").select("uid", "other")
        settled = materialize(
            _compare(_members_of_open_pairs(open_, units, placed, members), strip, threshold, inner=False), "settled"
        )
        edges = edges.unionAll(settled.select("uid", "label")).unionAll(members.select("cid", "uid"))
        class_links = settled.groupBy(F.col("uid").alias("cid")).agg(F.sum("links").alias("more"))
        balls = members.join(units.filter("radius > 0").select("uid", "weight"), "uid")
        mapped = per_class.join(balls, "cid", "left").join(class_links, "cid", "left").withColumns({
            "uid": F.coalesce("uid", "cid"), "weight": F.coalesce("weight", "rows"), "more": F.coalesce("more", F.lit(0)),
        })
    labels = components(edges)
    linked = mapped.join(unit_links, "uid", "left").join(labels, F.col("uid") == F.col("node"), "left").select(
        "vector", "least", F.coalesce("label", "uid").alias("part"),
        (F.coalesce("links", F.lit(0)) + F.col("more") + F.col("weight") - 1).cast("long").alias("n_links"),
    )
    linked = materialize(linked, "linked")
    heads = linked.groupBy("part").agg(F.min("least").alias("head"))
    labelled = linked.join(heads, "part").select("vector", "n_links", "head", F.lit(True).alias("in_class"))
    # Only usable vectors have a class; the others, null ones too, find none.
    key = F.when(F.col("usable"), F.col("vector")).alias("vector")
    out = rows.select("id", key).join(labelled, "vector", "left")
    component = F.when(F.col("in_class"), F.col("head")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
