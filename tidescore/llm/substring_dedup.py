"""Substring deduplication by joining the documents' blocks with those of the whole corpus.

Relative Lempel-Ziv would factor a document greedily, left to right, each factor the longest match with the
reference blocks. That parse is replaced by joins of blocks on their anchors: the answer needs which windows
occur elsewhere, not the factors, and a greedy parse needs every reference block at hand for each document.

Every document is cut into reference blocks: each window of `window` words belongs to its smallest
hashed gram (the leftmost one if equal), the anchor, and a block is a run of windows with one anchor.
Cutting depends on content alone, so equal passages are cut alike wherever they stand, and the index
of all blocks of the corpus is a table keyed by anchor.

A document's blocks are then joined with that index, in no order and without extending matches. A block
that occurs elsewhere as a whole is a copied factor, at least one window long; neighbouring factors run
together. Where a
passage begins or ends, a block differs from the others of its anchor and is not copied as a whole;
at these factor boundaries its windows are looked up one by one among the blocks of the same anchor.
Words under copied windows are the duplicate spans. This finds exactly the windows whose words start
anywhere else too, in the same document or another.

Two bitmaps of fixed size say which anchors recur, so that only their blocks are shuffled in the
second pass; a false hit costs work and changes nothing, as joins and counts decide. Hashes have 64
bits; blocks and windows are only compared under equal anchors.

Defined cases: a null text has no words; documents shorter than the window lose nothing; repeated
rows are occurrences like others; an empty table gives no rows. Columns other than id and text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.llm.labelled import texts_of
from tidescore.session import scratch_table

GRAM = 8  # words of an anchor
BITMAP_BITS = 26  # log2 of the bits of a bitmap: 8 MB each at any input size
# Odd multipliers of the byte and word hashes and the finalizer's constants: fixed values.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * MIX_1
    x = (x ^ x >> np.uint64(27)) * MIX_2
    return x ^ x >> np.uint64(31)


@lru_cache(maxsize=8)
def _powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(length, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(base, max(1 << 16, 1 << (length - 1).bit_length()))
    return up[:length], down[:length]


def prefix_sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


def word_hashes(joined: bytes) -> np.ndarray:
    """Hash of each word of a text whose words are joined by single spaces."""
    b = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(b == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(b)]
    sums, down = prefix_sums(b.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    return mixed((sums[ends] - sums[starts]) * down[starts])


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value of every window of `width` values."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def blocks(text: str, window: int) -> tuple[np.ndarray, ...] | None:
    """(anchor, content, first window, number of windows) per block, and the hash of every window."""
    words = text.encode().split()
    if len(words) < window:
        return None
    gram = min(GRAM, window)
    sums, down = prefix_sums(word_hashes(b" ".join(words)), WORD_BASE)
    grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(words) - gram + 1])
    windows = mixed((sums[window:] - sums[:-window]) * down[: len(words) - window + 1])
    anchor = leftmost_minimum(grams, window - gram + 1)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    count = np.diff(np.r_[first, len(anchor)])
    at = anchor[first]
    shape = ((at - first) * 65_536 + count).astype(np.uint64)
    content = mixed((sums[first + count + window - 1] - sums[first]) * down[first] + mixed(shape))
    return grams[at], content, first, count, windows


def bits_of(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = (anchors >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return place >> 6, place & 63


def document_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def recurring_anchors(docs: DataFrame, window: int) -> DataFrame:
    """Anchors that occur more than once: anchor, whether all of their blocks are equal (`pure`), and the least content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in texts_of(batches, 0):
            found = [x for x in (blocks(t, window) for t in texts) if x]
            if found:
                columns = [np.concatenate([x[i] for x in found]).view(np.int64) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "content"])

    rows = docs.select("text").mapInArrow(run, "anchor long, content long")
    return scratch_table(
        rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("a"), F.max("content").alias("b"))
        .where(F.col("n") > 1).select("anchor", (F.col("a") == F.col("b")).alias("pure"), F.col("a").alias("content")),
        "anchors",
    )


def bitmap(anchors: DataFrame) -> np.ndarray:
    """One bit per value of the anchors' leading bits; as large for any number of anchors."""
    place = F.shiftrightunsigned("anchor", 64 - BITMAP_BITS)
    rows = anchors.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))).alias("bits")
    ).toArrow()
    out = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def recurring_blocks(docs: DataFrame, pure: np.ndarray, mixed_map: np.ndarray, window: int) -> DataFrame:
    """Blocks whose anchor may recur; those of anchors with unequal blocks come with their windows' hashes."""
    sent = docs.sparkSession.sparkContext.broadcast((pure, mixed_map))

    def hit(bitmap: np.ndarray, word: np.ndarray, bit: np.ndarray) -> np.ndarray:
        return bitmap[word] >> bit.astype(np.uint64) & np.uint64(1) != 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, 0):
            out: list[tuple] = []
            for key, text in zip(part.column(1).to_pylist(), texts):
                found = blocks(text, window)
                if found is None:
                    continue
                anchor, content, first, count, windows = found
                word, bit = bits_of(anchor)
                whole, edge = hit(sent.value[0], word, bit), hit(sent.value[1], word, bit)
                for i in np.flatnonzero(whole | edge):
                    at, n = int(first[i]), int(count[i])
                    hashes = windows[at : at + n].tobytes() if edge[i] else None
                    out.append((anchor[i], content[i], key, at, n, hashes))
            if out:
                a, c, k, at, n, hashes = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(np.array(c, np.uint64).view(np.int64)),
                     pa.array(k, pa.int64()), pa.array(at, pa.int32()), pa.array(n, pa.int32()),
                     pa.array(hashes, pa.binary())],
                    ["anchor", "content", "key", "at", "n", "windows"])

    schema = "anchor long, content long, key long, at int, n int, windows binary"
    return scratch_table(docs.select("text", "key").mapInArrow(run, schema), "blocks")


def unpacked(classes: DataFrame) -> DataFrame:
    """One row per window: anchor, hash, key, at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                hashes = part.column(3).to_pylist()
                sizes = np.array([len(h) // 8 for h in hashes])
                flat = np.frombuffer(b"".join(hashes), np.int64)
                inside = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                anchor, key, at = (np.repeat(part.column(i).to_numpy(), sizes) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(flat), pa.array(key), pa.array((at + inside).astype(np.int32))],
                    ["anchor", "hash", "key", "at"])

    return classes.select("anchor", "key", "at", "windows").mapInArrow(run, "anchor long, hash long, key long, at int")


def copied_factors(docs: DataFrame, window: int) -> DataFrame:
    """Copied factors (key, low, high: word positions, high not included) of `docs` (text, key)."""
    anchors = recurring_anchors(docs, window)
    found = recurring_blocks(
        docs, bitmap(anchors.where("pure")), bitmap(anchors.where("not pure")), window)
    edges = found.where(F.col("windows").isNotNull())
    # Equal content means equal windows, so any member stands for its class.
    classes = scratch_table(
        edges.groupBy("anchor", "content").agg(
            F.count(F.lit(1)).alias("members"), F.min("key").alias("key"), F.min("at").alias("at"),
            F.first("windows").alias("windows")),
        "block-classes")
    # Blocks copied as a whole: all of an anchor whose blocks are equal, and classes with more than one member.
    copies = anchors.where("pure").select("anchor", "content").union(
        classes.where("members > 1").select("anchor", "content")).toDF("known", "same")
    whole = found.join(copies, (F.col("anchor") == F.col("known")) & (F.col("content") == F.col("same"))).select(
        "key", F.col("at").alias("low"), (F.col("at") + F.col("n") + (window - 1)).alias("high"))
    each = unpacked(classes)
    shared = scratch_table(
        each.groupBy(F.col("anchor").alias("known"), F.col("hash").alias("same")).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n"),
        "windows")
    single = unpacked(classes.where("members = 1"))
    ends = single.join(shared, (F.col("anchor") == F.col("known")) & (F.col("hash") == F.col("same"))).select(
        "key", F.col("at").alias("low"), (F.col("at") + window).alias("high"))
    return whole.union(ends)


def remove_duplicates(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with the kept words, joined by one space, as text; and n_words, n_removed, spans.

    `spans` holds the duplicate spans as (low, high) word positions of the original text. The three
    added columns replace input columns of the same names.
    """
    source = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), document_key(id_col, text_col).alias("key"))
    factors = scratch_table(
        copied_factors(source, window).groupBy(F.col("key").alias("of")).agg(
            F.collect_set(F.struct("low", "high")).alias("factors")),  # rows with one id and text share their factors
        "factors")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_rest"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"), document_key(id_col, text_col).alias("_key"))
    joined = rows.join(factors, F.col("_key") == F.col("of"), "left").select("_rest", "_text", "factors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, 1):
            kept_texts, counts, removed, spans = [], [], [], []
            for text, factors in zip(texts, part.column(2).to_pylist()):
                words = text.encode().split()
                depth = np.zeros(len(words) + 1, np.int64)
                for f in factors or ():
                    depth[f["low"]] += 1
                    depth[f["high"]] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).tolist()
                spans.append([{"low": a, "high": b} for a, b in zip(turns[::2], turns[1::2])])
                out, at = [], 0
                for a, b in zip(turns[::2], turns[1::2]):
                    out += words[at:a]
                    at = b
                kept_texts.append(b" ".join(out + words[at:]).decode())
                counts.append(len(words))
                removed.append(int(gone.sum()))
            kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(kept_texts, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, kind)],
                ["_rest", "_text", "n_words", "n_removed", "spans"])

    rest = joined.schema["_rest"].dataType.simpleString()
    cleaned = joined.mapInArrow(
        run, f"_rest {rest}, _text string, n_words long, n_removed long, spans array<struct<low:int,high:int>>")
    own = ("n_words", "n_removed", "spans")
    return cleaned.select(
        *[F.col("_text").alias(c) if c == text_col else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns if c not in own],
        *own)
