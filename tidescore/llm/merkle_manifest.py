"""A Merkle manifest of a dataset: trees of 16 children over rows, stored in van Emde Boas order, and audits.

Every row is a leaf; the rows of one `tree_col` value form a tree, and the roots of these trees form the top
tree. While more than one node of a tree remains, every 16 consecutive ones become the hash of their digests.

Trees are stored as blocks: aligned subtrees of up to three steps (4,096 leaves). The roots of a tree's blocks
are the leaves of its next blocks, and so on until one block is left; what is built and what is read repeats
itself over block roots, so no group grows with the rows and a tree with a third of all rows is as many groups
as it needs. Inside a block the nodes lie in van Emde Boas order: a subtree is split at half its height, its
upper half is stored first, then its lower halves one after the other, each stored alike. `address` computes
where a node is; construction writes through it and siblings are read through it.

An audit folds a presented digest of each row with the stored siblings, from its block over the blocks above
to the root. What is above a block is the same for all its leaves and comes down once per block.

Defined cases: a null value is hashed as `-`, in the id as well; a null tree value is a tree of its own, the
first; leaves of a tree ascend by id (null first), rows of one id by their digest, equal rows are each a
leaf; a tree of one leaf has that leaf as its root, and one tree alone has its root as the root; an empty
table has an empty manifest and gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.operators.ordering import with_global_index

FAN_BITS = 4  # 16 children
FAN = 1 << FAN_BITS
STEPS = 3  # of a block: 16**3 leaves
BLOCK_BITS = FAN_BITS * STEPS
BLOCK = 1 << BLOCK_BITS
DIGEST = 32


def subtree_size(levels: int) -> int:
    """Nodes of a full subtree."""
    return ((1 << FAN_BITS * levels) - 1) // (FAN - 1)


def address(depth: int, index, levels: int):
    """Place of the nodes number `index` (an int or an array) of a depth in a subtree of so many levels."""
    if levels == 1:
        return index * 0
    upper = levels // 2
    if depth < upper:
        return address(depth, index, upper)
    bits = FAN_BITS * (depth - upper)
    lower = levels - upper
    inside = address(depth - upper, index & (1 << bits) - 1, lower)
    return subtree_size(upper) + (index >> bits) * subtree_size(lower) + inside


@lru_cache(maxsize=STEPS + 1)
def places(steps: int) -> list[np.ndarray]:
    """Addresses of a block's nodes by steps from the leaves; a block of no step is a lone leaf."""
    return [address(steps - up, np.arange(1 << FAN_BITS * (steps - up)), steps + 1) for up in range(steps + 1)]


def steps_of(leaves: int, alone: bool) -> int:
    """Steps to a block's root: all of them beside other blocks, else until one node remains."""
    if not alone:
        return STEPS
    return next(s for s in range(STEPS + 1) if leaves <= 1 << FAN_BITS * s)


def build_block(digests: Sequence[bytes], alone: bool) -> tuple[int, bytes]:
    """(steps, nodes in van Emde Boas order up to the last one used) of a block's leaves."""
    steps = steps_of(len(digests), alone)
    at = places(steps)
    count = len(digests)
    used = max(int(at[up][: -(-count >> FAN_BITS * up)].max()) for up in range(steps + 1)) + 1
    nodes = bytearray(used * DIGEST)
    for place, digest in zip(at[0].tolist(), digests):
        nodes[place * DIGEST : (place + 1) * DIGEST] = digest
    for up in range(1, steps + 1):
        below, count = count, -(-count // FAN)
        for i, place in enumerate(at[up][:count].tolist()):
            run = read_nodes(nodes, at[up - 1][i * FAN : min(below, (i + 1) * FAN)])
            nodes[place * DIGEST : (place + 1) * DIGEST] = sha256("".join(run).encode()).digest()
    return steps, bytes(nodes)


def read_nodes(nodes: bytes, where: np.ndarray) -> list[str]:
    """Digests at some addresses, as hexadecimal text."""
    return [nodes[p * DIGEST : (p + 1) * DIGEST].hex() for p in where.tolist()]


def siblings(nodes: bytes, steps: int, leaves: int) -> list[list[tuple[str, str]]]:
    """For each step and node below it: its run's digests before and after it."""
    out = []
    for up in range(steps):
        count = -(-leaves >> FAN_BITS * up)
        found = []
        for low in range(0, count, FAN):
            run = read_nodes(nodes, places(steps)[up][low : min(count, low + FAN)])
            found += [("".join(run[:i]), "".join(run[i + 1 :])) for i in range(len(run))]
        out.append(found)
    return out


def path_of(slot: int, beside: list[list[tuple[str, str]]]) -> list[tuple[str, str]]:
    return [found[slot >> FAN_BITS * up] for up, found in enumerate(beside)]


def fold(digest: str, path: Sequence[tuple[str, str]]) -> str:
    for before, after in path:
        digest = sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: of each value its UTF-8 byte count, a colon and the value, or `-` for null."""
    texts = [v.cast("string") for v in values]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*sized), 256))


BLOCKS = "tree string, block long, total long, leaves long, steps int, nodes binary, apex binary"


def blocks_of(nodes: DataFrame) -> DataFrame:
    """Blocks of the nodes (tree, total: nodes of the tree, place: from 0, digest)."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        total = int(group["total"].iloc[0])
        steps, stored = build_block([bytes(d) for d in group["digest"]], total <= BLOCK)
        root = int(places(steps)[steps][0])
        return pd.DataFrame([(key[0], key[1], total, len(group), steps, stored, stored[root * DIGEST : (root + 1) * DIGEST])],
                            columns=["tree", "block", "total", "leaves", "steps", "nodes", "apex"])

    numbered = nodes.select("tree", F.shiftright("place", BLOCK_BITS).alias("block"), "total", "place", "digest")
    return numbered.groupBy("tree", "block").applyInPandas(run, BLOCKS)


def write_tower(nodes: DataFrame, largest: int, path: str) -> list[DataFrame]:
    """Blocks over nodes, blocks over their roots, up to one block per tree; written below `path`."""
    spark, levels = nodes.sparkSession, []
    while True:
        where = f"{path}/level={len(levels)}"
        blocks_of(nodes).write.parquet(where)
        levels.append(spark.read.schema(BLOCKS).parquet(where))
        if largest <= BLOCK:
            return levels
        largest = -(-largest // BLOCK)
        nodes = levels[-1].where(F.col("total") > BLOCK).select(
            "tree", F.ceil(F.col("total") / BLOCK).cast("long").alias("total"), F.col("block").alias("place"),
            F.col("apex").alias("digest"))


def write_manifest(
    docs: DataFrame, path: str, fields: Sequence[str], id_col: str = "doc_id", tree_col: str = "source",
    presented: dict[str, Column] | None = None,
) -> None:
    """Write the manifest of `docs` to `path`: leaves, the trees' blocks, their roots, the top tree's blocks.

    A leaf is the digest of `fields` in their order. `presented` gives values to be audited instead of those
    of some fields, such as another copy's; their digest is kept beside the leaf.
    """
    spark = docs.sparkSession
    own = [F.col(f"`{c}`") for c in fields]
    shown = [(presented or {}).get(c, F.col(f"`{c}`")) for c in fields]
    tree = F.col(f"`{tree_col}`").cast("string")
    # `-` sorts before `:`, so the null tree is the first; strings sort by their UTF-8 bytes.
    rows = docs.select(
        F.coalesce(F.concat(F.lit(":"), tree), F.lit("-")).alias("tree"), F.col(f"`{id_col}`").cast("long").alias("id"),
        leaf_digest(*own).alias("digest"), leaf_digest(*shown).alias("shown"), F.monotonically_increasing_id().alias("_tie"))
    # Equal rows are interchangeable; their position in the scan only lets the range split divide a run of them.
    placed = with_global_index(rows, [F.col(c).asc_nulls_first() for c in ("tree", "id", "digest", "_tie")], "_at").drop("_tie")
    sizes = placed.groupBy("tree").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("total"))
    placed.join(sizes, "tree").select(
        "tree", "total", (F.col("_at") - F.col("_low")).alias("place"), "id", "digest", "shown").write.parquet(f"{path}/leaves")
    leaves = spark.read.parquet(f"{path}/leaves")
    largest = leaves.agg(F.max("total").alias("n")).first().n
    if largest is None:
        return
    towers = write_tower(leaves, largest, f"{path}/trees")
    roots = towers[0].where(F.col("total") <= BLOCK)
    for level in towers[1:]:
        roots = roots.unionByName(level.where(F.col("total") <= BLOCK))
    with_global_index(roots.select(F.col("tree").alias("name"), F.col("apex").alias("digest")), [F.col("name")], "place").write.parquet(
        f"{path}/roots")
    top = spark.read.parquet(f"{path}/roots")
    count = top.count()
    write_tower(top.select(F.lit("").alias("tree"), F.lit(count).cast("long").alias("total"), "place", "digest"), count, f"{path}/top")


def stored_levels(spark: SparkSession, path: str) -> list[DataFrame]:
    """Blocks by level, lowest first."""
    found = spark.read.schema(BLOCKS + ", level int").parquet(path)
    return [found.where(F.col("level") == n).drop("level") for n in sorted(r.level for r in found.select("level").distinct().collect())]


ABOVE = "before array<string>, after array<string>, subroot string, root string"


def paths_below(blocks: DataFrame) -> DataFrame:
    """Of blocks with what is above them: one row per leaf of theirs (tree, place) with what is above it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b in frame.itertuples(index=False):
                beside = siblings(bytes(b.nodes), b.steps, b.leaves)
                rows = []
                for slot in range(b.leaves):
                    before, after = zip(*path_of(slot, beside)) if beside else ((), ())
                    rows.append((b.tree, (b.block << BLOCK_BITS) + slot, [*before, *b.before], [*after, *b.after], b.subroot, b.root))
                yield pd.DataFrame(rows, columns=["tree", "place", "before", "after", "subroot", "root"])

    held = blocks.select("tree", "block", "leaves", "steps", "nodes", "before", "after", "subroot", "root")
    return held.mapInPandas(run, f"tree string, place long, {ABOVE}")


def paths_down(levels: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """The lowest blocks with what is above them; `tops`: what is above each tree (tree, before, after, subroot,
    root), None if its own root is the last.
    """
    known = None
    for n in range(len(levels) - 1, -1, -1):
        blocks = levels[n]
        ends = blocks.where(F.col("total") <= BLOCK)
        if tops is None:
            none = F.array().cast("array<string>")
            ends = ends.withColumns({"before": none, "after": none, "subroot": F.lit(""), "root": F.lower(F.hex("apex"))})
        else:
            ends = ends.join(tops, "tree")
        if known is not None:
            ends = ends.unionByName(
                blocks.where(F.col("total") > BLOCK).join(known.withColumnRenamed("place", "block"), ["tree", "block"]))
        if n == 0:
            return ends
        known = paths_below(ends)
    raise ValueError("a manifest without levels")


AUDIT = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def audit(spark: SparkSession, path: str, with_proof: bool = False) -> DataFrame:
    """One row per leaf: its digest, its tree's root, the root, the digest of its siblings on the way up, the
    root its presented digest folds to and whether that is the root; the siblings themselves if asked for
    (`proof`: before and after of each step).
    """
    schema = AUDIT + (", proof array<struct<before:string,after:string>>" if with_proof else "")
    leaves = spark.read.parquet(f"{path}/leaves")
    if leaves.isEmpty():
        return spark.createDataFrame([], schema).withColumn("id", F.col("id").cast("long"))
    over = paths_below(paths_down(stored_levels(spark, f"{path}/top")))
    names = spark.read.parquet(f"{path}/roots")
    tops = names.join(over.drop("tree", "subroot"), "place").select(
        F.col("name").alias("tree"), "before", "after", F.lower(F.hex("digest")).alias("subroot"), "root")
    blocks = paths_down(stored_levels(spark, f"{path}/trees"), tops)

    def run(key: tuple, rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        b = next(block.itertuples(index=False))
        beside = siblings(bytes(b.nodes), b.steps, b.leaves)
        above = list(zip(b.before, b.after))
        above_text = "".join(x + y for x, y in above).encode()
        out = []
        for slot, number, digest, shown in zip(rows["slot"], rows["id"], rows["digest"], rows["shown"]):
            path = path_of(slot, beside)
            proof = sha256("".join([x + y for x, y in path]).encode())
            proof.update(above_text)
            folded = fold(fold(bytes(shown).hex(), path), above)
            row = (number, bytes(digest).hex(), b.subroot, b.root, proof.hexdigest(), folded, folded == b.root)
            out.append((*row, [{"before": x, "after": y} for x, y in [*path, *above]]) if with_proof else row)
        return pd.DataFrame(out, columns=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
                                          *(["proof"] if with_proof else [])])

    # The id travels as text: pandas would turn longs beside nulls into doubles.
    asked = leaves.select(
        "tree", F.shiftright("place", BLOCK_BITS).alias("block"), F.col("place").bitwiseAND(BLOCK - 1).alias("slot"),
        F.col("id").cast("string").alias("id"), "digest", "shown")
    held = blocks.select("tree", "block", "leaves", "steps", "nodes", "before", "after", "subroot", "root")
    audited = asked.groupBy("tree", "block").cogroup(held.groupBy("tree", "block")).applyInPandas(run, schema)
    return audited.withColumn("id", F.col("id").cast("long"))
