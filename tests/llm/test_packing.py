from itertools import product

import pytest

from mergelane.llm import packing


def check(rows, sizes, lengths):
    """Every item whole, in pieces; no bin over its length, no overlap, no bin longer than needed."""
    bins, items = {}, {}
    for r in rows:
        items.setdefault(r.doc_id, []).append((r.start, r.size))
        if r.size:
            bins.setdefault((r.bin, r.bin_length), []).append((r.bin_start, r.size))
        else:
            assert r.bin is None and r.bin_length is None and r.bin_start is None
    assert len({b for b, _ in bins}) == len(bins)
    for (_, length), parts in bins.items():
        end = 0
        for start, size in sorted(parts):
            assert start == end
            end += size
        assert length == min(n for n in lengths if n >= end)
    for i, size in sizes.items():
        end = 0
        for start, n in sorted(items[i]):
            assert start == end
            end += n
        assert end == max(size or 0, 0)
    return sum(length for _, length in bins)


@pytest.mark.parametrize("batch_items", [65_536, 7])
def test_packing(spark, batch_items):
    sizes = {i: s for i, s in enumerate([5, 3, 900, 64, 64, 31, 0, None, -4, 33, 1, 128, 129, 63, 65, 32] * 20)}
    docs = spark.createDataFrame(list(sizes.items()), "doc_id long, size int").selectExpr("*", "'x' AS bin", "'y' AS piece")
    out = packing.pack(docs, "size", lengths=(32, 64, 128), batch_items=batch_items)
    cost = check(out.collect(), sizes, (32, 64, 128))
    words = sum(max(s or 0, 0) for s in sizes.values())
    assert words <= cost <= 1.25 * words


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, 10), (1, 10), (None, 5), (None, 5)], "doc_id long, size int")
    rows = packing.pack(docs, "size", lengths=(16, 32)).collect()
    assert sorted((r.doc_id or -1, r.size) for r in rows) == [(-1, 5), (-1, 5), (1, 10), (1, 10)]
    assert packing.pack(docs.limit(0), "size").count() == 0


def partitions(items):
    if not items:
        yield []
        return
    for rest in partitions(items[1:]):
        for i in range(len(rest)):
            yield rest[:i] + [rest[i] + [items[0]]] + rest[i + 1 :]
        yield rest + [[items[0]]]


@pytest.mark.parametrize("per_bin", [0.0, 3.0])
def test_close_to_the_best(per_bin):
    """Against all packings: never better than the best one, and within half of it on any small set."""
    lengths, worst = [4, 8, 16], 1.0

    def cost(final):
        return sum(n + per_bin for n in final)

    for sizes in product([1, 3, 5, 9], repeat=5):
        own = sorted(sizes, reverse=True)
        best = min(
            (cost(packing.shrunk([sum(b) for b in p], lengths)) for p in partitions(own) if max(map(sum, p)) <= 16)
        )
        bins, places, final = packing.pack_batch(own, lengths, per_bin)
        filled = [sum(s for s, b in zip(own, bins) if b == i) for i in range(len(final))]
        assert packing.shrunk(filled, lengths) == final
        assert best <= cost(final)
        worst = max(worst, cost(final) / best)
    assert worst <= 1.5


def test_lengths_are_chosen_together():
    # Alone, the long bins win; only if each bin has a price of its own do they win by more.
    assert sum(packing.pack_batch([5, 5, 5], [8, 16])[2]) == 16
    assert packing.pack_batch([8, 8], [8, 16])[2] == [8, 8]
    assert packing.pack_batch([8, 8], [8, 16], per_bin=1.0)[2] == [16]


def test_best_fit_takes_the_fullest_bin():
    bins, places, contents = packing.best_fit([6, 5, 3, 2], [8], 8)
    assert bins == [0, 1, 1, 0] and places == [0, 0, 5, 6] and contents == [8, 8]


def test_each_bin_opens_at_its_least_cost():
    assert packing.Opener([1, 1, 3], [8, 16], 0.0).filled(5) == 5
    opener = packing.Opener([5, 5, 5], [8, 16], 0.0)
    opener.take(5)
    assert opener.length(5) == 16  # 15 of 16, against 5 of 8
    opener = packing.Opener([5, 3], [8, 16], 0.0)
    opener.take(5)
    assert opener.length(5) == 8
    # Equal without a price of a bin; with one, the longer bin is cheaper.
    for per_bin, length in ((0.0, 8), (1.0, 16)):
        opener = packing.Opener([8, 8], [8, 16], per_bin)
        opener.take(8)
        assert opener.length(8) == length


def test_lengths_differ_from_bin_to_bin():
    """No single smallest length packs these as well as a choice for each bin."""
    lengths, sizes = [8, 16, 32], sorted([30, 2, 9, 7, 5, 3, 6, 10, 11, 11], reverse=True)

    def cost(smallest):
        return sum(packing.shrunk(packing.best_fit(sizes, lengths, smallest)[2], lengths))

    assert cost(None) <= min(cost(n) for n in lengths)


def test_query_against_brute_force_of_its_parts(spark):
    """The query over a whole table: every document's words in pieces in bins, and no dearer than any one length."""
    from mergelane.llm.queries import QUERIES

    name = next(n for n in QUERIES if n.startswith("op9_"))
    folder = "/root/testdata/sf0.001"
    rows = QUERIES[name](spark, folder).collect()
    sizes = {r.doc_id: 0 for r in rows}
    for r in rows:
        sizes[r.doc_id] += r.size
    assert sorted(sizes) == sorted(r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    cost = check(rows, sizes, packing.LENGTHS) + packing.PER_BIN * len({r.bin for r in rows if r.size})
    pieces = sorted((r.size for r in rows if r.size), reverse=True)
    for smallest in packing.LENGTHS:
        final = packing.shrunk(packing.best_fit(pieces, packing.LENGTHS, smallest)[2], packing.LENGTHS)
        assert cost <= sum(final) + packing.PER_BIN * len(final)
