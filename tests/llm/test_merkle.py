"""The Merkle manifest against a plain one, and the arithmetic of its layout."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import frames
from mergelane.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    parts = ["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS]
    return _h(*parts)


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def _path(levels, i):
    path = []
    for level in levels[:-1]:
        first = i // 3 * 3
        path.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return path


def _brute(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        leaves = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r), i) for i, r in enumerate(rows) if r["source"] == s))
        trees[s] = ([x[3] for x in leaves], _levels([x[2] for x in leaves]))
    top = _levels([trees[s][1][-1][0] for s in sources])
    out = []
    for n, s in enumerate(sources):
        for i, at in enumerate(trees[s][0]):
            row = rows[at]
            path = _path(trees[s][1], i) + _path(top, n)
            changed = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None:
                changed["text"] = row["text"].replace("\n", "")
            node = _leaf(changed)
            for left, right in path:
                node = _h(left, node, right)
            out.append((
                row["doc_id"], _leaf(row), trees[s][1][-1][0], top[-1][0], _h(*[a + b for a, b in path]), node, node == top[-1][0],
            ))
    return sorted(out, key=str)


def _run(docs, **more):
    even = F.crc32(docs["doc_id"].cast("string")) % 2 == 0
    text = F.when(even, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    return sorted((tuple(r) for r in merkle.manifest(docs, tampered={"text": text}, **more).collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 8])
def test_against_brute_force(spark, height):
    """Trees of one block, of several, and of several rounds of blocks."""
    sizes = {"a": 1, "b": 2, "é": 3, "big": 47, "": 10, None: 9}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append({"doc_id": i * 7 % 101 + i, "source": source, "lang": "en" if i % 4 else None, "n_chars": i, "text": f"t\n{i}\nü"})
            i += 1
    rows[3]["text"], rows[5]["text"], rows[8]["doc_id"], rows[9]["n_chars"] = None, "", None, None
    rows.append(dict(rows[20]))  # a repeated row
    rows.append({**rows[20], "text": "other"})  # the same id again
    rows.append({**rows[0], "text": "long " * 200_000})
    docs = spark.createDataFrame([tuple(r[f] for f in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], frames.SCHEMA)
    assert _run(docs.repartition(5), height=height) == _brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert _run(frames.documents(spark, [])) == []
    docs = frames.documents(spark, ["a\n", "b"], tree="x", block="x", rank="x", digest="x", leaf="x", root="x", id="x")
    assert _run(docs) == _run(frames.documents(spark, ["a\n", "b"]))


def test_only_digests_are_shuffled(spark):
    docs = frames.documents(spark, ["a\nb", "c"])
    merkle.manifest(docs)
    plan = merkle.leaf_digest([docs["text"]])
    shown = docs.select(plan)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in shown and "Python" not in shown


@pytest.mark.parametrize("levels", range(1, 8))
def test_layout_has_every_node_once(levels):
    """Ragged subtrees too: the places of all nodes are 0 to size - 1, and the top is the first."""
    for leaves in {1, 2, 3, 4, 3 ** (levels - 1) // 2 + 1, 3 ** (levels - 1) - 1 or 1, 3 ** (levels - 1)}:
        if leaves > 3 ** (levels - 1):
            continue
        places = np.concatenate([merkle._places(leaves, levels, y) for y in range(levels)])
        assert sorted(places.tolist()) == list(range(merkle.tree_size(leaves, levels)))
        assert merkle._places(leaves, levels, levels - 1).tolist() == [0]


def test_layout_is_recursive_by_halves():
    """Of 4 levels the upper 2 are together at the front, and each subtree below them is one stretch."""
    assert sorted(np.concatenate([merkle._places(27, 4, 3), merkle._places(27, 4, 2)]).tolist()) == [0, 1, 2, 3]
    roots, leaves = merkle._places(27, 4, 1), merkle._places(27, 4, 0)
    for i, root in enumerate(roots.tolist()):
        assert leaves[3 * i : 3 * i + 3].tolist() == [root + 1, root + 2, root + 3]
