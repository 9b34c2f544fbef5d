"""Best-fit packing of tokenized documents into sequences of a fixed length, hierarchically.

1. Each partition tokenizes its documents, cuts the long ones and packs the pieces by best fit, a
   window of pieces at a time, largest first, into bins that stay open until the partition ends.
2. Bins that are nearly full are done. The others become items of a tree: groups of `fan` partitions
   repack theirs by best fit, whole bins as items, then groups of groups, up to one root.
3. Pieces learn their final sequence by a join on their first bin.

Only bin numbers and fills travel up the tree. Two bins merge only if one is at most half full, and best
fit leaves at most one such bin per partition or group. So a group of `fan` merges at most `fan` fuller bins,
the emptiest serving best: each member hands up its `fan` + 1 emptiest bins, cut before they meet, whatever
the number of rows. The others are sequences as they stand; no piece is ever dropped.

Defined cases: a null or empty text is a document of the end id alone; a document longer than a
sequence has a shorter first piece and whole pieces after it; repeated rows are packed as often as
they come; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidescore.llm.bpe_automaton import vocabulary_text
from tidescore.llm.bpe_text import TextEncoder, parse_vocabulary, printable_bytes
from tidescore.session import scratch_table

BIN_BITS = 32  # bin number: partition above, count within the partition below
WINDOW_PIECES, WINDOW_BYTES = 4096, 16_000_000


class BestFit:
    """Open bins by free room; the smallest room that suffices takes the next item."""

    def __init__(self, size: int):
        self.size = size
        self.by_room: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = 0  # bit r is set if some bin has room r
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) for an item of `length` <= size."""
        mask = self.open >> length
        if mask:
            room = length + (mask & -mask).bit_length() - 1
            number = self.by_room[room].pop()
            if not self.by_room[room]:
                self.open ^= 1 << room
        else:
            room, number = self.size, self.opened
            self.opened += 1
        left = room - length
        if left:
            self.by_room[left].append(number)
            self.open |= 1 << left
        return number, self.size - room


def cut_lengths(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones at the end, the rest at the front."""
    first = length - (length - 1) // size * size
    return [(0, first), *((at, size) for at in range(first, length, size))]


@lru_cache(maxsize=2)
def library_encoder(text: str) -> TextEncoder:
    """Words through the tokenizers library's model; its own cache is not used, ours holds more."""
    from tokenizers import Tokenizer

    model, vocabulary = Tokenizer.from_str(text).model, parse_vocabulary(text)
    alphabet = {b: c for c, b in printable_bytes().items()}

    packed = [np.array([i], "<u4").tobytes() for i in range(max(vocabulary.labels) + 1)]

    def word(w: str) -> bytes:
        return b"".join([packed[t.id] for t in model.tokenize(w.encode().decode("latin-1").translate(alphabet))])

    return TextEncoder(word, vocabulary.special)


PIECES = "doc bigint, piece int, start bigint, length bigint, ids binary, bin bigint, place bigint"


def pack_partitions(docs: DataFrame, path: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit), local bin and place there."""
    sent = vocabulary_text(docs.sparkSession, path)
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ending = np.array([end_id], "<u4").tobytes()

    def packed(pieces: list[tuple], fit: BestFit, first_bin: int) -> pa.RecordBatch:
        places: list[tuple[int, int]] = [(0, 0)] * len(pieces)
        for i in sorted(range(len(pieces)), key=lambda i: -pieces[i][3]):
            number, place = fit.place(pieces[i][3])
            places[i] = (first_bin + number, place)
        columns = list(zip(*[(*p, *at) for p, at in zip(pieces, places)]))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        names = ["doc", "piece", "start", "length", "ids", "bin", "place"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, fit = library_encoder(sent.value), BestFit(size)
        first_bin = TaskContext.get().partitionId() << BIN_BITS
        pieces: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + ending
                held += len(ids)
                for piece, (start, length) in enumerate(cut_lengths(len(ids) // 4, size)):
                    pieces.append((doc, piece, start, length, ids[4 * start : 4 * (start + length)]))
                if len(pieces) >= WINDOW_PIECES or held >= WINDOW_BYTES:
                    yield packed(pieces, fit, first_bin)
                    pieces, held = [], 0
        if pieces:
            yield packed(pieces, fit, first_bin)
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, PIECES)


def repack(bins: DataFrame, divisor: int, size: int, carried: int, fan: int = 16) -> DataFrame:
    """One level of the tree: bins (`bin`, `fill`) of one group by best fit into fewer (`parent`, `base`).

    Of each of a group's `fan` members only the emptiest bins are read, at most `carried` of them.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["fill", "bin"], kind="stable").iloc[::-1]
        fit, opener, out = BestFit(size), {}, []
        for number, fill in zip(group["bin"], group["fill"]):
            at, base = fit.place(int(fill))
            out.append((number, opener.setdefault(at, number), base))
        return pd.DataFrame(out, columns=["bin", "parent", "base"])

    partition = F.shiftright("bin", BIN_BITS)
    emptiest = Window.partitionBy(F.floor(partition / (divisor // fan))).orderBy("fill", "bin")
    handed = bins.withColumn("_n", F.row_number().over(emptiest)).where(F.col("_n") <= min(carried, fan + 1)).drop("_n")
    return handed.groupBy(F.floor(partition / divisor).alias("group")).applyInPandas(run, "bin long, parent long, base long")


def pack(
    docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    nearly: float = 1 / 64, fan: int = 16, carried: int = 65_536, keep_ids: bool = False,
) -> DataFrame:
    """Per piece: id, piece, start, length, CRC-32 of its ids, sequence_id, offset (and `ids` if asked for)."""
    pieces = pack_partitions(docs, path, size, end_id, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    pieces = scratch_table(pieces if keep_ids else pieces.drop("ids"), "pieces")
    done = size - int(size * nearly)
    filled = pieces.groupBy("bin").agg(F.sum("length").alias("fill"))
    # where: the sequence that an unfilled bin has gone to, and its place and that sequence's fill.
    where = scratch_table(
        filled.where(F.col("fill") < done).select("bin", F.col("bin").alias("sequence"), F.lit(0).cast("long").alias("base"), "fill"),
        "bins",
    )
    partitions = (where.agg(F.max(F.shiftright("bin", BIN_BITS))).first()[0] or 0) + 1
    divisor = fan
    while True:
        sums = where.groupBy("sequence").agg(F.sum("fill").alias("total"))
        items = sums.where(F.col("total") < done).select(F.col("sequence").alias("bin"), F.col("total").alias("fill"))
        moved = repack(items, divisor, size, carried, fan).select(
            F.col("bin").alias("moved"), "parent", F.col("base").alias("shift"))
        where = scratch_table(
            where.join(moved, F.col("sequence") == F.col("moved"), "left").select(
                "bin", F.coalesce("parent", "sequence").alias("sequence"),
                (F.col("base") + F.coalesce("shift", F.lit(0))).alias("base"), "fill"),
            "bins",
        )
        if divisor >= partitions:
            break
        divisor *= fan
    final = where.select(F.col("bin").alias("first"), "sequence", "base")
    return pieces.join(final, F.col("bin") == F.col("first"), "left").select(
        F.col("doc").alias(id_col), "piece", "start", "length", *(["ids"] if keep_ids else []), "ids_crc32",
        F.coalesce("sequence", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
