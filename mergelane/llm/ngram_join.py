"""N-gram Jaccard join: links between documents whose sets of word shingles are alike, and their components.

Grouped prefix join (Bouros, Ge and Mamoulis, "Spatio-textual similarity joins", 2012; Xiao et al.,
PPJoin). Two sets of a Jaccard similarity of at least t share a token among the first
n - ceil(t n) + 1 tokens of either, in any order of all tokens. Here tokens go by their document
frequency, so that those of one set only come first and make no candidates.

1. One pass forms the sets. Texts with equal sets are one set from here on.
2. Frequencies are counted over a fixed share of the token space, which holds the prefix of nearly every set;
   a set that has too few tokens in it also gives all others, which go behind. So the order is one for
   all sets, and a set knows it for its own prefix, though most tokens are never shuffled. Sets whose
   prefix no other set shares link with nothing. The others, few in most corpora, do the same again among
   themselves, over a larger share.
3. Sets with the same prefix and size are one group. The groups of a token form a list. The pairs of a
   short list are filtered by size and position, expanded to their members, and verified on the whole sets.
4. In a long list every member meets one hub, the set that meets the most others over its lists, which leaves
   their symmetric difference. Sets that both link to the hub are joined already. For two others the
   differences have to share half of one of them, so a prefix join over the differences finds them. Its short
   lists are compared pair by pair, long ones in tiles of bounded size, which give a link or two a set: those that do not
   link to the hub against all of the list. So a group of
   thousands of near copies is never expanded into its pairs, and no link between different components is missed.

Every step is a join or an aggregation that Spark splits; no task holds a list of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergelane.llm.arrow import byte_steps
from mergelane.llm.components import components as connected_components
from mergelane.llm.components import joined
from mergelane.llm.shingles import BATCH_BYTES, set_digests, shingle_sets
from mergelane.session import materialize

# The share of the token space over which frequencies are counted, as a multiple of a prefix' share of its set: first
# for all sets, then for those that may still link to others. With a larger share more tokens are
# shuffled, and more sets turn out to have too many tokens of their own.
REGIONS = (1.6, 5.0)
# Lists of a token with up to this many sets are compared pair by pair.
SHORT_LIST = 16
# Sets of one side of a tile in which long lists of differences are compared.
STRIP = 1_024
# Bits of the table that tells tasks which sets to bring for verification: at most 16 MB, whatever the input.
MOST_BITS = 1 << 27


def _edge(threshold: Fraction, region: float) -> int:
    """The counted region holds the tokens below this one."""
    return min((1 << 63) - 1, int(-(1 << 63) + (1 << 64) * min(1.0, region * float(1 - threshold))))


def _prefix(n: Column, t: Fraction) -> Column:
    """Tokens in the prefix of a set of n."""
    return n - F.expr(f"({t.numerator} * n + {t.denominator - 1}) div {t.denominator}") + 1


def _may_be_alike(a: str, b: str, t: Fraction) -> Column:
    """Size and position filter of two sets (columns n and at) that share the token at these positions."""
    need = F.expr(f"({t.numerator} * ({a}.n + {b}.n) + {t.numerator + t.denominator - 1}) div {t.numerator + t.denominator}")
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    return (
        (F.col(f"{a}.n") * t.denominator >= F.col(f"{b}.n") * t.numerator)
        & (F.col(f"{b}.n") * t.denominator >= F.col(f"{a}.n") * t.numerator)
        & (F.least(f"{a}.at", f"{b}.at") + rest >= need)
    )


def shingled(docs: DataFrame, size: int, threshold: Fraction, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, sid (digest of the set, null if it is empty), n (its size), region, tokens.

    `tokens` are the set's tokens in the first region, `region` of them, behind which all other
    tokens follow if the region does not hold the set's prefix. Rows whose set the same task has seen before have null.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    num, den = threshold.numerator, threshold.denominator
    edge = _edge(threshold, REGIONS[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in byte_steps(batches, 1, BATCH_BYTES):
            sets = shingle_sets(batch.column(1), size)
            n = np.diff(sets.ends)
            digest = set_digests(sets)
            first = np.zeros(len(n), dtype=bool)
            for i, d in enumerate(digest.tolist()):
                if n[i] and d not in seen:
                    seen.add(d)
                    first[i] = True
            below = np.concatenate([[0], np.cumsum(sets.tokens < edge)])
            region = below[sets.ends[1:]] - below[sets.ends[:-1]]
            given = np.where(region >= n - (num * n + den - 1) // den + 1, region, n) * first
            begins = np.cumsum(given) - given
            taken = np.repeat(sets.ends[:-1] - begins, given) + np.arange(given.sum())
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(begins, given.sum()).astype(np.int32)), pa.array(sets.tokens[taken]), mask=pa.array(~first)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digest, mask=n == 0), pa.array(n), pa.array(region), lists],
                names=["id", "sid", "n", "region", "tokens"],
            )

    frame = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return frame.mapInArrow(run, f"id {id_type}, sid long, n long, region long, tokens array<long>")


def _of_several(postings: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that postings of more than one set have, and their number of postings as ``df``.

    Counted in the map tasks first; what is joined to it may have keys of any skew, as Spark splits joins.
    """
    counts = postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("df"), F.min("sid").alias("low"), F.max("sid").alias("high"))
    return counts.filter("low <> high").select(*keys, "df")


def _postings(sets: DataFrame, threshold: Fraction, edge: int) -> DataFrame:
    """token, sid, n, at: the tokens of all prefixes that other prefixes have too, and their positions (from 1).

    `sets` has sid, n, region and tokens; a set may stand there more than once.
    """
    every = sets.select("sid", F.explode("tokens").alias("token"))
    # The order of tokens goes by postings, those of repeated sets included; it is one for all sets.
    shared = every.join(_of_several(every, ["token"]), "token").select(
        "token", "sid", "df", (F.col("token") >= F.lit(edge)).alias("other")
    )
    shared = shared.repartition("sid").dropDuplicates(["sid", "token"])
    own = Window.partitionBy("sid")
    sizes = sets.groupBy("sid").agg(F.first("n").alias("n"), F.first("region").alias("region"), F.max(F.size("tokens")).alias("given"))
    placed = (
        shared.join(sizes, "sid")
        .withColumn("rank", F.row_number().over(own.orderBy("other", "df", "token")))
        .withColumn("in_region", F.count(F.when(~F.col("other"), 1)).over(own))
        .withColumn("in_all", F.count(F.lit(1)).over(own))
    )
    # Unshared tokens stand before the shared ones of their part, the region before the rest.
    lone = F.when(F.col("other"), F.col("given") - F.col("in_all")).otherwise(F.col("region") - F.col("in_region"))
    at = (F.col("rank") + lone).cast("long")
    prefixes = placed.withColumn("at", at).filter(F.col("at") <= _prefix(F.col("n"), threshold)).select("token", "sid", "n", "at")
    prefixes = materialize(prefixes, "prefixes")
    # A token in one prefix only makes no candidates.
    return prefixes.join(_of_several(prefixes, ["token"]).select("token"), "token").select("token", "sid", "n", "at")


def _of_region(sets: DataFrame, threshold: Fraction, edge: int) -> DataFrame:
    """Whole sets (sid, tokens) as `_postings` takes them, with the tokens of a region, or all if that is too small."""
    region = F.size(F.filter("tokens", lambda x: x < F.lit(edge))).cast("long")
    sized = sets.select("sid", "tokens", F.size("tokens").cast("long").alias("n"), region.alias("region"))
    given = F.when(F.col("region") >= _prefix(F.col("n"), threshold), F.col("region")).otherwise(F.col("n"))
    return sized.select("sid", "n", "region", F.slice("tokens", F.lit(1), given.cast("int")).alias("tokens"))


def _grouped(postings: DataFrame, threshold: Fraction) -> DataFrame:
    """sid, gid: sets of the same size and prefix have the smallest of their sids as gid.

    A prefix with a token that no other prefix holds is like no other. The tokens of one set's prefix are collected, never those of several sets.
    """
    prefixes = postings.groupBy("sid").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list("token")).alias("prefix")
    )
    whole = F.size("prefix") == _prefix(F.col("n"), threshold)
    groups = prefixes.filter(whole).groupBy("n", "prefix").agg(F.min("sid").alias("gid"))
    return prefixes.join(groups, ["n", "prefix"], "left").select("sid", F.coalesce("gid", "sid").alias("gid"))


def _lists(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """token, gid, n, at, sets (members of the group), length (members of all groups of the token)."""
    sizes = groups.groupBy("gid").agg(F.count(F.lit(1)).alias("sets"))
    heads = postings.join(sizes, F.col("sid") == F.col("gid")).select("token", "gid", "n", "at", "sets")
    return heads.join(heads.groupBy("token").agg(F.sum("sets").alias("length")), "token")


def _short_pairs(lists: DataFrame, groups: DataFrame, threshold: Fraction) -> DataFrame:
    """a, b (a < b): members of the groups that meet in a short list and may be alike."""
    short = lists.filter(F.col("length").between(2, SHORT_LIST))
    x, y = short.alias("x"), short.alias("y")
    of_two = F.when(F.col("x.gid") == F.col("y.gid"), F.col("x.sets") > 1).otherwise(_may_be_alike("x", "y", threshold))
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.gid") <= F.col("y.gid")) & of_two
    pairs = x.join(y, meet).select(F.col("x.gid").alias("one"), F.col("y.gid").alias("two")).distinct()
    member = lambda group, name: groups.select(F.col("gid").alias(group), F.col("sid").alias(name))
    expanded = pairs.join(member("one", "p"), "one").join(member("two", "q"), "two").filter("p <> q")
    return expanded.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _hub_pairs(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """hub, sid: the members of all groups of a long list with its hub.

    The hub is the group that meets the most others over all its long lists: of near copies, one with few edits,
    which holds most of what they have in common. As that goes by the group, a family has few hubs.
    """
    long = lists.filter(F.col("length") > SHORT_LIST)
    weight = long.groupBy("gid").agg(F.sum("length").alias("weight"))
    ranked = long.join(weight, "gid").select("token", F.struct(-F.col("weight"), -F.col("n"), "gid").alias("place"))
    hubs = ranked.groupBy(F.col("token").alias("of")).agg(F.min("place").alias("least"))
    stars = long.join(hubs, F.col("token") == F.col("of")).select(F.col("least.gid").alias("hub"), "gid").distinct()
    return stars.join(groups, "gid").filter("sid <> hub").select("hub", "sid")


def _differences(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """hub, sid, n, hub_n, linked, part, delta: the symmetric difference of each set and its hub.

    A set that links to the hub is of the hub's part (sets known to be connected), others are one of their own.
    """
    own = sets.select("sid", F.col("tokens").alias("x"))
    hub = sets.select(F.col("sid").alias("hub"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    linked = both * threshold.denominator >= (F.size("x") + F.size("y") - both) * threshold.numerator
    return pairs.join(own, "sid").join(hub, "hub").withColumn("linked", linked).select(
        "hub", "sid", F.size("x").cast("long").alias("n"), F.size("y").cast("long").alias("hub_n"), "linked",
        F.when(F.col("linked"), F.col("hub")).otherwise(F.col("sid")).alias("part"),
        F.concat(F.array_except("x", "y"), F.array_except("y", "x")).alias("delta"),
    )


def _difference_postings(stars: DataFrame, threshold: Fraction) -> DataFrame:
    """hub, token, sid, n, d, linked, part, at, rank, short: the prefixes of the differences, and the size of their lists.

    With the differences a, b of two sets from their hub, their own difference has |a| + |b| - 2 |a and b| tokens,
    which may be c (n_a + n_b) at most, with c = (1 - t) / (1 + t). Let set A not link to the hub, so that
    |a| > c (n_a + n_hub). Then they share more than (|b| - c (n_b - n_hub)) / 2 tokens (b's short prefix), and also
    |a| - c (n_a + n_b) of them, where n_b is at most n_a / t. Prefixes leave that many tokens less one out.
    Lists whose sets all link to the hub give nothing new: tokens that no set off the hub has stand before all others, with
    those of one set, and need no rows.
    """
    c = (1 - threshold) / (1 + threshold)
    open_hubs = stars.filter("NOT linked").select("hub").distinct()
    some = stars.join(open_hubs, "hub", "left_semi")
    sizes = some.select("hub", "sid", "n", "hub_n", "linked", "part", F.size("delta").alias("d")).filter("d > 0")
    own = Window.partitionBy("hub", "sid")
    every = some.select("hub", "sid", "linked", F.explode("delta").alias("token"))
    counts = every.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("df"), F.every("linked").alias("all_linked"))
    shared = every.drop("linked").join(counts.filter("df > 1 AND NOT all_linked").select("hub", "token", "df"), ["hub", "token"])
    placed = shared.join(sizes, ["hub", "sid"]).withColumns({
        "rank": F.row_number().over(own.orderBy("df", "token")), "all": F.count(F.lit(1)).over(own),
    })
    at = F.col("rank") + F.col("d") - F.col("all")
    # In integers: x >= p / q is q x >= p. Half of what is left of b, and for sets off the hub what is left of a.
    half = F.expr(f"({c.denominator} * d - {c.numerator} * greatest(0L, n - hub_n)) div {2 * c.denominator} + 1")
    most = c * (1 + 1 / threshold)
    rest = F.greatest(F.lit(1), F.expr(f"({most.denominator} * d - {most.numerator} * n) div {most.denominator}"))
    prefixed = placed.withColumns({
        "at": at, "short": at <= F.col("d") - half + 1, "long": at <= F.col("d") - rest + 1,
    }).filter("short OR (long AND NOT linked)")
    prefixed = materialize(prefixed.drop("long", "all", "df", "hub_n"), "prefixed")
    lists = prefixed.groupBy("hub", "token").agg(
        F.count(F.lit(1)).alias("length"), F.min("part").alias("low"), F.max("part").alias("high"), F.every("linked").alias("all_linked")
    )
    open_ = lists.filter("low <> high AND NOT all_linked").select("hub", "token", "length")
    return prefixed.join(open_, ["hub", "token"])


def _short_difference_links(postings: DataFrame, stars: DataFrame, threshold: Fraction) -> DataFrame:
    """src, dst: sets of different parts that meet in a short list of differences and link."""
    c = (1 - threshold) / (1 + threshold)
    short = postings.filter(F.col("length") <= SHORT_LIST)
    off = short.filter("NOT linked").alias("x")
    any_ = short.filter("short").alias("y")
    # For a pair, the number of tokens that both differences must have is known; its prefixes are as short as that
    # allows, and behind the shared token there have to be enough more. Unshared tokens are in no other set.
    need = F.expr(
        f"greatest(1L, ({c.denominator} * (x.d + y.d) - {c.numerator} * (x.n + y.n) + {2 * c.denominator - 1}) div {2 * c.denominator})"
    )
    after = F.least(F.col("x.d") - F.col("x.at"), F.col("y.d") - F.col("y.at"))
    meet = (
        (F.col("x.hub") == F.col("y.hub")) & (F.col("x.token") == F.col("y.token")) & (F.col("x.part") != F.col("y.part"))
        & (F.col("y.linked") | (F.col("x.short") & (F.col("x.sid") < F.col("y.sid"))))
        & (F.col("x.at") <= F.col("x.d") - need + 1) & (F.col("y.at") <= F.col("y.d") - need + 1)
        & (F.least("x.rank", "y.rank") + after >= need)
    )
    pairs = off.join(any_, meet).select("x.hub", F.col("x.sid").alias("p"), F.col("y.sid").alias("q")).distinct()
    side = lambda name, more: stars.select(
        "hub", F.col("sid").alias(name), F.col("n").alias(f"n_{more}"), F.col("delta").alias(more)
    )
    known = pairs.join(side("p", "a"), ["hub", "p"]).join(side("q", "b"), ["hub", "q"])
    apart = F.size("a") + F.size("b") - 2 * F.size(F.array_intersect("a", "b"))
    total = F.col("n_a") + F.col("n_b")
    alike = (total - apart) * threshold.denominator >= (total + apart) * threshold.numerator
    return known.filter(alike).select(F.greatest("p", "q").alias("src"), F.least("p", "q").alias("dst"))


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of `a` has in common with each of `b`."""
    tokens, place = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    size = np.array([len(x) for x in [*a, *b]])
    owner = np.repeat(np.arange(len(size)), size)
    first = owner < len(a)
    wanted = np.flatnonzero(np.bincount(place[first], minlength=len(tokens)) * np.bincount(place[~first], minlength=len(tokens)))
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for start in range(0, len(wanted), 4096):
        some = np.full(len(tokens), -1)
        some[wanted[start : start + 4096]] = np.arange(len(wanted[start : start + 4096]))
        held = some[place]
        sides = []
        for mine, n, less in ((first, len(a), 0), (~first, len(b), len(a))):
            at = np.flatnonzero(mine & (held >= 0))
            side = np.zeros((n, 4096), dtype=np.float32)
            side[owner[at] - less, held[at]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _tile_links(postings: DataFrame, stars: DataFrame, threshold: Fraction) -> DataFrame:
    """src, dst: what connects the sets of each long list, from those that do not link to its hub to all of it.

    Lists of the same sets, as edits of several tokens give them, are one list. The sets of a list are dealt to strips by
    a hash, and each strip of the ones off the hub meets each strip of the list in a tile.
    """
    long = postings.filter(F.col("length") > SHORT_LIST)
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), "sid").cast("decimal(20,0)"))
    every = long.groupBy("hub", "token").agg(
        F.count(F.lit(1)).alias("held"), F.count(F.when(~F.col("linked"), 1)).alias("off"),
        digest(1).alias("one"), digest(2).alias("two"),
    )
    counts = every.groupBy("hub", "held", "off", "one", "two").agg(F.min("token").alias("token")).select(
        "hub", "token", F.ceil(F.col("off") / STRIP).alias("high"), F.ceil(F.col("held") / STRIP).alias("wide")
    )
    tile = lambda r, c, left: F.struct(r.alias("r"), c.alias("c"), F.lit(left).alias("left"))
    deal = F.xxhash64("sid")
    row, col = F.pmod(deal, F.col("high")), F.pmod(deal, F.col("wide"))
    across = F.transform(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1), lambda c: tile(row, c, True))
    down = F.transform(F.sequence(F.lit(0).cast("long"), F.col("high") - 1), lambda r: tile(r, col, False))
    places = F.when(F.col("linked"), down).otherwise(F.concat(across, down))
    held = long.select("hub", "token", "sid", "linked", "part", "n").join(counts, ["hub", "token"])
    dealt = held.select("hub", "token", "sid", "part", "n", F.explode(places).alias("t")).select("hub", "token", "sid", "part", "n", "t.*")
    dealt = dealt.join(stars.select("hub", "sid", "delta"), ["hub", "sid"])

    def run(table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy()
        sid, part, n = (table.column(c).to_numpy() for c in ("sid", "part", "n"))
        delta = table.column("delta").combine_chunks()
        ends, values = delta.offsets.to_numpy(), delta.values.to_numpy()
        one, two = np.flatnonzero(left), np.flatnonzero(~left)
        src, dst = [], []
        if len(one) and len(two):
            sets = [values[ends[i] : ends[i + 1]] for i in range(len(sid))]
            size = np.diff(ends).astype(np.int64)
            apart = size[one][:, None] + size[two][None, :] - 2 * _overlaps([sets[i] for i in one], [sets[i] for i in two])
            total = n[one][:, None] + n[two][None, :]
            alike = (total - apart) * threshold.denominator >= (total + apart) * threshold.numerator
            alike &= part[one][:, None] != part[two][None, :]
            for mine, label in zip((one, two), joined(alike, sid[one], sid[two])):
                new = label != sid[mine]
                src += sid[mine][new].tolist()
                dst += label[new].tolist()
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return dealt.groupBy("hub", "token", "r", "c").applyInArrow(run, "src long, dst long")


def _star_links(stars: DataFrame, threshold: Fraction) -> DataFrame:
    """src, dst: what links in the stars of long lists: a link a member with its hub, those of short lists, and of tiles."""
    own = stars.filter("linked").select(F.greatest("sid", "hub").alias("src"), F.least("sid", "hub").alias("dst"))
    postings = materialize(_difference_postings(stars, threshold), "differences")
    links = own.unionByName(_short_difference_links(postings, stars, threshold))
    return links.unionByName(_tile_links(postings, stars, threshold))


def _bit_table(sids: DataFrame) -> np.ndarray:
    """Bits that are set for all `sids`, 8 or more a sid up to MOST_BITS; more sids then share bits."""
    bits = 1 << 16
    n = sids.count()
    while bits < MOST_BITS and bits < 8 * n:
        bits *= 2
    words = sids.groupBy(F.expr(f"cast(pmod(sid, {bits}L) div 32 as int)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(pmod(sid, 32L) as int)))").alias("mask")
    )
    table = np.zeros(bits // 32, dtype=np.uint32)
    for part in words.toLocalIterator():
        table[part["word"]] = part["mask"]
    return table


def _sets_of(docs: DataFrame, sids: DataFrame, size: int, text_col: str) -> DataFrame:
    """sid, tokens: the whole sets of the given ones, formed again from the texts.

    A table of bits keeps most other sets in the tasks that form them; the join drops the rest.
    """
    table = _bit_table(sids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_steps(batches, 0, BATCH_BYTES):
            sets = shingle_sets(batch.column(0), size)
            digest = set_digests(sets)
            bit = digest.view(np.uint64) & np.uint64(len(table) * 32 - 1)
            wanted = (table[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32) & 1).astype(bool)
            wanted &= np.diff(sets.ends) > 0
            chosen, first = np.unique(digest[wanted], return_index=True)
            at = np.flatnonzero(wanted)[first]
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chosen), pa.array([sets[i] for i in at.tolist()], pa.list_(pa.int64()))],
                    names=["sid", "tokens"],
                )

    formed = docs.select(docs[text_col].alias("text")).mapInArrow(run, "sid long, tokens array<long>")
    return formed.join(sids, "sid", "left_semi").dropDuplicates(["sid"])


def _links(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    a = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("x"))
    b = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    alike = both * threshold.denominator >= (F.size("x") + F.size("y") - both) * threshold.numerator
    return pairs.join(b, "b").join(a, "a").filter(alike).select(F.col("b").alias("src"), F.col("a").alias("dst"))


def components(
    docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: its id, n_shingles (size of its set) and component_id, the smallest id of its component.

    Words stand between ASCII white space, with A-Z lower-cased; a set holds the distinct shingles of
    `size` words, or the whole text as one if it has fewer. Two rows link if their sets' Jaccard similarity
    is at least `threshold`; components follow links to any length. A row without words (or null) has an empty set
    and links with nothing, not even with others like it: its component is its own id. Rows with
    the same set link whatever their ids. Null ids take part but name no component as long as another
    id does. Repeated rows stay. Other columns go; an empty table gives an empty one.

    Jobs run while it is planned. Sets are told apart by 64-bit digests.
    """
    base = materialize(shingled(docs, size, threshold, id_col, text_col), "shingles")
    first, second = (_edge(threshold, region) for region in REGIONS)
    some = _postings(base.filter("tokens IS NOT NULL"), threshold, first)
    left = materialize(some.select("sid").distinct(), "left")
    whole = materialize(_sets_of(docs, left, size, text_col), "sets")
    # What is no candidate of any other set is left out, and frequencies count for the rest alone.
    postings = materialize(_postings(_of_region(whole, threshold, second), threshold, second), "postings")
    groups = materialize(_grouped(postings, threshold), "groups")
    lists = materialize(_lists(postings, groups), "lists")
    stars = materialize(_differences(_hub_pairs(lists, groups), whole, threshold), "stars")
    links = _links(_short_pairs(lists, groups, threshold), whole, threshold).unionByName(_star_links(stars, threshold))
    labels = connected_components(links)
    parts = labels.select(F.col("node").alias("sid"), "label")
    rows = base.select("id", "sid", "n").join(parts, "sid", "left").withColumn("part", F.coalesce("label", "sid"))
    rows = rows.select("id", "n", "part")
    least = rows.filter("part IS NOT NULL").groupBy("part").agg(F.min("id").alias("least"))
    return rows.join(least, "part", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("part").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )


def first_of_each(
    docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` without those whose component has a smaller id (see `components`); columns stay.

    Rows that repeat an id are one document: it stays if any of them names its component, and of its
    rows with the same text one stays. Rows with a null id stay.
    """
    parts = materialize(components(docs, size, threshold, id_col, text_col), "components").filter(F.col(id_col).isNotNull())
    per_id = parts.groupBy(F.col(id_col).alias("__id")).agg(
        F.max((F.col(id_col) == F.col("component_id")).cast("int")).alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    gone = materialize(per_id.filter("__first = 0").select("__id"), "gone")
    kept = docs.join(gone, F.col(id_col) == F.col("__id"), "left_anti")
    repeated = materialize(per_id.filter("__first = 1 AND __rows > 1").select("__id"), "repeated")
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, F.col(id_col) == F.col("__id"), "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(repeated, F.col(id_col) == F.col("__id"), "left_anti").unionByName(again)
