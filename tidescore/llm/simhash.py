"""Near-duplicates by SimHash fingerprints, joined on Golay-code fuzzy hashes.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. Fingerprints at most three bits
apart have two segments with at most one differing bit each (pigeonhole). Each segment is read as a
word of the perfect binary Golay code (23, 12): a word within two errors of its codeword has that
codeword's index as its only key; a word three errors away also has the indices of the codewords that
a one-bit change leads to, five at most. Words one bit apart then share a key. The keys of two
segments together name a bucket; members of a bucket are compared exactly.

Only distinct fingerprints are joined. Buckets are read in sorted runs and give a spanning forest of
their links, never all pairs; a run longer than a block is dealt out as pairs of blocks to more tasks.

Defined cases: a null text is empty; without words the fingerprint is zero, linked like any other;
with fewer words than a shingle the whole sequence is the shingle; rows may repeat and share a
component; rows with a null id count as documents but never name a component, which is null if no
member has an id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.llm.labelled import texts_of
from tidescore.llm.links import components
from tidescore.session import scratch_table

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
GOLAY_BITS, GOLAY_CHECKS = 23, 11
GOLAY_POLYNOMIAL = 0b110001110101  # fixed value: generator of the perfect binary Golay code
MOST_KEYS = 6
SHORT_RUN, BLOCK = 32, 4096
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int) -> int:
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist())], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, hash of the text, and fingerprint as a signed long."""
    source = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.col(id_col).alias("id"), text_hash(text_col).alias("hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, 0):
            found = np.array([fingerprint(t, shingle) for t in texts], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(found)], ["id", "hash", "print"])

    return source.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, hash long, print long")


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of each byte in each of three places, and the error pattern of each remainder with its weight."""
    def remainder(word: int) -> int:
        for bit in range(GOLAY_BITS - 1, GOLAY_CHECKS - 1, -1):
            if word >> bit & 1:
                word ^= GOLAY_POLYNOMIAL << bit - GOLAY_CHECKS
        return word

    rests = np.array([[remainder(b << 8 * place & (1 << GOLAY_BITS) - 1) for b in range(256)] for place in range(3)])
    errors = np.zeros(1 << GOLAY_CHECKS, np.int64)
    weights = np.zeros(1 << GOLAY_CHECKS, np.int64)
    for weight in range(4):
        for bits in combinations(range(GOLAY_BITS), weight):
            pattern = sum(1 << b for b in bits)
            errors[remainder(pattern)], weights[remainder(pattern)] = pattern, weight
    return rests, errors, weights


def golay_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the one codeword within three bits of each 23-bit word."""
    rests, errors, _ = golay_tables()
    rest = rests[0][words & 255] ^ rests[1][words >> 8 & 255] ^ rests[2][words >> 16]
    return (words ^ errors[rest]) >> GOLAY_CHECKS


def segment_keys(words: np.ndarray, bits: int) -> np.ndarray:
    """Rows of up to six codeword indices, -1 where there are fewer."""
    flipped = np.concatenate([words[:, None], words[:, None] ^ (1 << np.arange(bits))[None, :]], axis=1)
    found = np.sort(golay_index(flipped), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = 1 << 20
    found.sort(axis=1)
    found = found[:, :MOST_KEYS]
    return np.where(found < 1 << 20, found, -1)


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, position of the fingerprint) for all pairs of segments and their keys."""
    unsigned = prints.view(np.uint64)
    keys = [segment_keys((unsigned >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64), n) for at, n in SEGMENTS]
    buckets, places = [], []
    for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        both = keys[i][:, :, None] << 12 | keys[j][:, None, :]
        real = (keys[i] >= 0)[:, :, None] & (keys[j] >= 0)[:, None, :]
        at, _, _ = np.nonzero(real)
        buckets.append(both[real] | pair << 24)
        places.append(at)
    return np.concatenate(buckets), np.concatenate(places)


def forest(prints: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among fingerprints, breadth first."""
    out, free = [], prints
    while len(free) > 1:
        wave, free = free[:1], free[1:]
        while len(wave) and len(free):
            at, wave = wave[0], wave[1:]
            near = np.bitwise_count(free ^ at) <= distance
            if near.any():
                found, free = free[near], free[~near]
                out.append((np.full(len(found), at), found))
                wave = np.concatenate([wave, found])
    return out


def run_links(buckets: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal buckets: short runs by comparing at every lag, long ones by forests."""
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    sizes = np.diff(np.r_[starts, len(buckets)])
    short = np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes)
    b, p, found = buckets[short], prints[short], []
    for lag in range(1, SHORT_RUN):
        same = np.flatnonzero(b[lag:] == b[:-lag])
        if not len(same):
            break
        near = same[np.bitwise_count(p[same] ^ p[same + lag]) <= distance]
        found.append((p[near], p[near + lag]))
    for at, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
        found += forest(prints[at : at + size], distance)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = (np.concatenate(x) for x in zip(*found))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


LINKS = "a long, b long, bucket long, block int"


def link_rows(a, b, bucket=None, block=None) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(a, np.uint64).view(np.int64)), pa.array(np.asarray(b, np.uint64).view(np.int64)) if b is not None else pa.nulls(n, pa.int64()),
         pa.nulls(n, pa.int64()) if bucket is None else pa.array(np.full(n, bucket)),
         pa.nulls(n, pa.int32()) if block is None else pa.array(np.full(n, block, np.int32))],
        ["a", "b", "bucket", "block"])


def links_of_runs(distance: int):
    """Reads rows (bucket, print) sorted by bucket. Gives links, and runs above a block as (print, bucket, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_p = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        large, blocks = None, 0  # the bucket that has outgrown a block, and how many of its blocks are out

        def closed(b: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal large, blocks
            if large is not None and len(b):
                rest = b == large
                if rest.any():
                    yield link_rows(p[rest], None, large, blocks)
                    b, p = b[~rest], p[~rest]
                large, blocks = None, 0
            starts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, len(b)])
            usual = np.ones(len(b), bool)
            for at, size in zip(starts[sizes > BLOCK], sizes[sizes > BLOCK]):
                usual[at : at + size] = False
                for k in range(0, size, BLOCK):
                    yield link_rows(p[at + k : at + min(k + BLOCK, size)], None, b[at], k // BLOCK)
            if usual.any():
                yield link_rows(*run_links(b[usual], p[usual], distance))

        for batch in batches:
            b = np.concatenate([held_b, batch.column(0).to_numpy()])
            p = np.concatenate([held_p, batch.column(1).to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(b, b[-1], side="left")) if len(b) else 0
            if cut:
                yield from closed(b[:cut], p[:cut])
            held_b, held_p = b[cut:], p[cut:]
            while len(held_b) > 2 * BLOCK:  # one bucket fills the memory: pass its blocks on
                if large != held_b[0]:
                    large, blocks = held_b[0], 0
                yield link_rows(held_p[:BLOCK], None, large, blocks)
                blocks += 1
                held_b, held_p = held_b[BLOCK:], held_p[BLOCK:]
        if len(held_b):
            yield from closed(held_b, held_p)

    return run


def block_pairs(deferred: DataFrame, distance: int) -> DataFrame:
    """Links inside large buckets: every pair of blocks meets in one task."""
    counts = scratch_table(deferred.groupBy(F.col("bucket").alias("of")).agg(F.max("block").alias("last")), "blocks")
    paired = deferred.join(counts, F.col("bucket") == F.col("of")).select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"), "block", F.col("a").alias("print"))
    keyed = paired.select(
        F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"), "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_p = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            b = np.concatenate([held_b, batch.column(0).to_numpy()])
            p = np.concatenate([held_p, batch.column(1).to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(b, b[-1], side="left")) if len(b) else 0
            if cut:
                yield link_rows(*run_links(b[:cut], p[:cut], distance))
            held_b, held_p = b[cut:], p[cut:]
        if len(held_b):
            yield link_rows(*run_links(held_b, held_p, distance))

    return keyed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, LINKS)


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect the same distinct fingerprints (`print`) as all pairs within `distance` bits do."""
    if not 0 <= distance <= 3:
        raise ValueError("the Golay keys find pairs at most three bits apart")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.column(0).slice(at, 4096).to_numpy()
                buckets, places = bucket_keys(own)
                yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(own[places])], ["bucket", "print"])

    keyed = prints.select("print").mapInArrow(keys, "bucket long, print long")
    found = scratch_table(
        keyed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(links_of_runs(distance), LINKS), "links")
    deferred = found.where(F.col("b").isNull()).select("bucket", "block", "a")
    edges = found.where(F.col("b").isNotNull()).select("a", "b")
    if deferred.isEmpty():
        return edges
    return edges.union(block_pairs(deferred, distance).select("a", "b"))


def rooted_classes(rows: DataFrame, distance: int) -> DataFrame:
    """Distinct fingerprints of `rows` (id, print): print, its smallest id (least), and its component (root)."""
    classes = scratch_table(rows.groupBy("print").agg(F.min("id").alias("least")), "classes")
    found = components(links(classes, distance))
    return scratch_table(
        classes.join(found, F.col("print") == F.col("node"), "left")
        .select("print", "least", F.coalesce("root", "print").alias("root")), "rooted")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component_id, the smallest id linked to it by any chain."""
    rows = scratch_table(fingerprints(docs, shingle, id_col, text_col).select("id", "print"), "prints")
    rooted = rooted_classes(rows, distance)
    names = scratch_table(
        rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id")), "names")
    named = scratch_table(
        rooted.join(names, F.col("root") == F.col("of")).select(F.col("print").alias("known"), "component_id"), "named")
    return rows.join(named, F.col("print") == F.col("known")).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(
    docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component with all columns: the smallest id, null last; among its texts the smallest
    (fingerprint, hash); repeated rows of it once. The row is known again by its id and text, as ids may repeat.
    """
    rows = scratch_table(fingerprints(docs, shingle, id_col, text_col), "prints")
    # One row per fingerprint first, so that a large component of few fingerprints is a few rows.
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "print", "hash")
    firsts = scratch_table(rows.groupBy("print").agg(F.min(order).alias("first")), "firsts")
    rooted = rooted_classes(rows, distance).select(F.col("print").alias("known"), "root")
    kept = firsts.join(rooted, F.col("print") == F.col("known")).groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.id").alias("_kept"), F.col("first.hash").alias("_kept_hash"))
    keyed = docs.withColumn("_hash", text_hash(text_col))
    same = F.col(id_col).eqNullSafe(F.col("_kept")) & (F.col("_hash") == F.col("_kept_hash"))
    return keyed.join(kept, same, "left_semi").dropDuplicates([id_col, "_hash"]).drop("_hash")
