from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidescore.llm import merkle_manifest as mm
from tidescore.session import scratch_path

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, id string, tree int, place double"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*values):
    return sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode()).hexdigest()


def rise(nodes):
    """(root, path of each node) of a list of digests, by the plain rule."""
    paths, spot = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(spot):
            low = at // 16 * 16
            run = nodes[low : low + 16]
            paths[i] += [("".join(run[: at - low]), "".join(run[at - low + 1 :]))]
        nodes = [sha256("".join(nodes[i : i + 16]).encode()).hexdigest() for i in range(0, len(nodes), 16)]
        spot = [at // 16 for at in spot]
    return nodes[0], paths


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to a sorted list of results."""
    trees = {}
    for row in rows:
        lowered = None if row[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
        changed = row[0] is not None and crc32(str(row[0]).encode()) % 5 == 0
        leaf = digest(*row)
        trees.setdefault(row[1], []).append((row[0], leaf, digest(*row[:4], lowered) if changed else leaf))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    kept = {s: sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for s in names}
    low = {s: rise([leaf for _, leaf, _ in kept[s]]) for s in names}
    root, high = rise([low[s][0] for s in names])
    out = []
    for s, above in zip(names, high):
        for (doc, leaf, shown), path in zip(kept[s], low[s][1]):
            way = path + above
            folded = shown
            for before, after in way:
                folded = sha256((before + folded + after).encode()).hexdigest()
            proof = sha256("".join(x + y for x, y in way).encode()).hexdigest()
            out.append((doc, leaf, low[s][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def audited(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "clash", 5, 0.5) for r in rows], SCHEMA).repartition(3)
    path = scratch_path(spark, "manifest-test")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered).otherwise(F.col("text"))
    mm.write_manifest(frame, path, FIELDS, presented={"text": changed})
    return mm.audit(spark, path, **more)


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (None, "b", "en", 3, "Abc"), (5, None, "de", 0, ""),
    (7, "b", None, 4, "Über A"), (7, "b", None, 4, "Über B"), (7, "b", None, 4, "Über B"), (8, "é", "x", 1, "Q" * 300_000),
    (-3, "", "en", 9, "12:ab-"), (9_007_199_254_740_993, "Z", "en", 1, "x\ny"),
]


def test_odd_rows(spark):
    found = sorted(map(tuple, audited(spark, ODD).collect()), key=str)
    assert found == brute(ODD)
    assert audited(spark, []).collect() == [] and "doc_id" not in audited(spark, []).columns


@pytest.mark.parametrize("rows", [[(1, "a", "en", 1, "one")], [(i, "a", "en", 1, f"T{i}") for i in range(17)]])
def test_one_tree(spark, rows):
    assert sorted(map(tuple, audited(spark, rows).collect()), key=str) == brute(rows)


def test_trees_of_several_blocks(spark):
    """A hot source of more than one block with a repeated id and equal rows, an exact block, and many small sources."""
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(5_000)] + [(77, "hot", "en", 1, "Same")] * 600
    rows += [(i, "whole", None, i, "w") for i in range(mm.BLOCK)] + [(i, f"s{i % 300}", "de", 1, "Few") for i in range(700)]
    assert sorted(map(tuple, audited(spark, rows).collect()), key=str) == brute(rows)


def test_proof_folds_to_the_root(spark):
    rows = [(i, "ab"[i % 2], "en", 1, f"t{i}") for i in range(40)]
    for r in audited(spark, rows, with_proof=True).collect():
        path = [(p.before, p.after) for p in r.proof]
        assert mm.fold(r.leaf, path) == r.root and len(path) == 3
        assert sha256("".join(x + y for x, y in path).encode()).hexdigest() == r.proof_sha256


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_the_block(levels):
    """Every place is used once, and each lower half lies together behind the upper half."""
    every = np.concatenate([mm.address(d, np.arange(16**d), levels) for d in range(levels)])
    assert sorted(every.tolist()) == list(range(mm.subtree_size(levels)))
    if levels == 4:
        for j in (0, 3, 255):
            held = [int(mm.address(2, j, 4)), *mm.address(3, np.arange(16) + 16 * j, 4).tolist()]
            assert held == list(range(17 + 17 * j, 17 + 17 * j + 17))


@pytest.mark.parametrize("count", [1, 2, 16, 17, 255, 256, 257, 4000, 4096])
@pytest.mark.parametrize("alone", [True, False])
def test_blocks(count, alone):
    leaves = [sha256(str(i).encode()).digest() for i in range(count)]
    steps, nodes = mm.build_block(leaves, alone)
    top, beside = int(mm.places(steps)[steps][0]), mm.siblings(nodes, steps, count)
    root = mm.read_nodes(nodes, np.array([top]))[0]
    assert all(mm.fold(leaves[i].hex(), mm.path_of(i, beside)) == root for i in range(0, count, 7))
    if alone:
        assert root == rise([d.hex() for d in leaves])[0]
    else:
        assert steps == mm.STEPS and len(beside) == mm.STEPS
