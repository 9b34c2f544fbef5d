"""Phrase collocations by relational set mining (SETM), a language at a time.

1. Words are counted; the frequent ones get numbers. The occurrence relation of length 1 holds the number of
   the frequent word at every position, a gap elsewhere and between pieces; it is written once.
2. Lengths 2 to `longest`: the relation is merge-joined with itself on the piece and the next position, so two
   frequent phrases that overlap but for one word make a longer one, named by the pair of their numbers. Pairs
   are counted, in the task first and by groups after. Frequent pairs get numbers, and the joined relation is
   semi-joined with them and written before the next length is made from it.
3. Counts, parts and containment come from the tables of frequent phrases alone.

A relation's row is a document with its positions in order: both sides of the merge join are the same sorted
run, so occurrences are never shuffled, whatever their number. Frequent tables up to `held` rows are sent to the
scan for the semi-join; larger ones are joined by shuffle, where adaptive execution splits hot keys, and the
positions of a document come together again.

A phrase of w words is frequent only if its two phrases of w - 1 words are, so nothing is lost by extending
frequent ones only, and all parts of a candidate are counted. Scores use 38-digit decimals.

Defined cases: a null text is empty, a null language is `und`; documents without words add nothing; repeated
rows are occurrences like others; ties go by score, count and phrase, in the order of UTF-8 bytes; an empty
table gives no rows. Columns other than text and language are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidescore.llm.bpe_text import Lookup, slices
from tidescore.operators.ordering import with_global_index
from tidescore.session import scratch_path, scratch_table

# The bytes that end a piece, and those between words.
ENDS, BLANKS = b".,;:!?\n\v\f\r", b" \t"
BREAK = b"\xff"  # stands for the end of a piece; no UTF-8 text holds it
GAP = -1
COUNTED_WORDS, COUNTED_PAIRS = 200_000, 1_000_000  # that a task counts before it hands them on
CLEANING = bytes.maketrans(bytes(range(65, 91)) + ENDS + BLANKS, bytes(range(97, 123)) + b"\n" * len(ENDS) + b" " * len(BLANKS))


def tokens(text: str) -> list[bytes]:
    """Words with the ends of pieces between them."""
    return text.encode().translate(CLEANING).replace(b"\n", b" " + BREAK + b" ").split()


def word_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every word of `docs` (lang, text): lang, word, f."""

    def handed(counts: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, word.decode(), n) for lang, found in counts.items() for word, n in found.items() if word != BREAK]
        counts.clear()
        langs, words, numbers = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for part in (x for batch in batches for x in slices(batch, 1)):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counts.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, counts.values())) >= COUNTED_WORDS:
                yield handed(counts)
        yield handed(counts)

    found = docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("f"))


def numbered(frequent: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Frequent phrases with their place in `order` as `id`, written; and their number."""
    table = scratch_table(with_global_index(frequent, [F.col(c) for c in order], "id"), "frequent")
    return table, table.count()


def write_relation(rows: DataFrame, label: str) -> DataFrame:
    """An occurrence relation (doc, ids: one a position) in the shared folder."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema("doc long, ids array<long>").parquet(path)


def renested(flat: DataFrame) -> DataFrame:
    """(doc, size, at, id) to a relation: a document's positions side by side again, gaps where none came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.full(row.column(1)[0].as_py(), GAP, np.int64)
                ids[row.column(2).flatten().to_numpy()] = row.column(3).flatten().to_numpy()
                yield pa.RecordBatch.from_arrays([row.column(0), lists([0, len(ids)], ids)], ["doc", "ids"])

    # The two lists keep one order, that of the rows of the group.
    together = flat.groupBy("doc").agg(F.first("size").alias("size"), F.collect_list(F.struct("at", "id")).alias("found"))
    return together.select("doc", "size", "found.at", "found.id").mapInArrow(run, "doc long, ids array<long>")


def lists(ends, flat: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.asarray(ends, np.int32), pa.array(flat, pa.int64()))


def first_relation(docs: DataFrame, frequent: DataFrame, count: int, held: int) -> DataFrame:
    """The relation of length 1: at every position of `docs` (doc, lang, text) the number of its frequent word."""
    if count > held:
        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in (x for batch in batches for x in slices(batch, 2)):
                for doc, lang, text in zip(*[c.to_pylist() for c in part.columns]):
                    found = tokens(text)
                    at = [i for i, w in enumerate(found) if w != BREAK]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc] * len(at), pa.int64()), pa.array([len(found)] * len(at), pa.int32()), pa.array(at, pa.int32()),
                         pa.array([lang] * len(at), pa.string()), pa.array([found[i].decode() for i in at], pa.string())],
                        ["doc", "size", "at", "lang", "word"])

        flat = docs.mapInArrow(spread, "doc long, size int, at int, lang string, word string")
        return write_relation(renested(flat.join(frequent, ["lang", "word"])), "occurrences")

    rows = frequent.select("lang", "word", "id").toArrow()
    known: dict[str, dict[bytes, int]] = {}
    for lang, word, number in zip(*[rows[c].to_pylist() for c in ("lang", "word", "id")]):
        known.setdefault(lang, {})[word.encode()] = number
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for batch in batches for x in slices(batch, 2)):
            found, ends = [], [0]
            for lang, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                get = sent.value.get(lang, {}).get
                ids = [get(w, GAP) for w in tokens(text)]
                found.append(np.array(ids, np.int64))
                ends.append(ends[-1] + len(ids))
            yield pa.RecordBatch.from_arrays([part.column(0), lists(ends, np.concatenate(found))], ["doc", "ids"])

    return write_relation(docs.mapInArrow(run, "doc long, ids array<long>"), "occurrences")


def neighbours(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge join of a relation's rows with themselves: (flat ids, row ends, places of the joined, next places)."""
    column = part.column(1)
    ends, ids = column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().to_numpy()
    both = ids[:-1] >= 0
    both &= ids[1:] >= 0
    cuts = ends[1:-1]
    both[cuts[(cuts > 0) & (cuts < len(ids))] - 1] = False  # the next position is another document's
    at = np.flatnonzero(both)
    return ids, ends, at, at + 1


def pair_counts(relation: DataFrame) -> DataFrame:
    """Occurrences of neighbouring phrases: a, b, f."""

    def counted(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
        left, right = np.concatenate(a or [np.zeros(0, np.int64)]), np.concatenate(b or [np.zeros(0, np.int64)])
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])][: len(left)])
        return pa.RecordBatch.from_arrays(
            [pa.array(left[first]), pa.array(right[first]), pa.array(np.diff(np.r_[first, len(left)]))], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        for part in (x for batch in batches for x in slices(batch, 1)):
            ids, _, at, after = neighbours(part)
            a.append(ids[at])
            b.append(ids[after])
            held += len(at)
            if held >= COUNTED_PAIRS:
                yield counted(a, b)
                a, b, held = [], [], 0
                pa.default_memory_pool().release_unused()
        yield counted(a, b)

    return relation.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("f"))


def next_relation(relation: DataFrame, frequent: DataFrame, count: int, held: int) -> DataFrame:
    """The relation of the next length: the merge join, semi-joined with the frequent pairs (a, b, id)."""
    if count > held:
        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in (x for batch in batches for x in slices(batch, 1)):
                ids, ends, at, after = neighbours(part)
                row = np.searchsorted(ends, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(np.diff(ends)[row].astype(np.int32)),
                     pa.array((at - ends[row]).astype(np.int32)), pa.array(ids[at]), pa.array(ids[after])],
                    ["doc", "size", "at", "a", "b"])

        flat = relation.mapInArrow(spread, "doc long, size int, at int, a long, b long")
        return write_relation(renested(flat.join(frequent.select("a", "b", "id"), ["a", "b"])), "occurrences")

    rows = frequent.select("a", "b", "id").toArrow()
    sent = relation.sparkSession.sparkContext.broadcast([rows[c].to_numpy() for c in ("a", "b", "id")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, number = sent.value
        lefts, left_at = np.unique(a, return_inverse=True)
        rights, right_at = np.unique(b, return_inverse=True)
        tables = [
            Lookup(lefts, np.arange(len(lefts)), GAP), Lookup(rights, np.arange(len(rights)), GAP),
            Lookup(left_at * len(rights) + right_at, number, GAP)]
        for part in (x for batch in batches for x in slices(batch, 1)):
            ids, ends, at, after = neighbours(part)
            x = tables[0].get(ids[at])
            at, after, x = at[x >= 0], after[x >= 0], x[x >= 0]
            y = tables[1].get(ids[after])
            out = np.full(len(ids), GAP, np.int64)
            out[at[y >= 0]] = tables[2].get(x[y >= 0] * len(rights) + y[y >= 0])
            yield pa.RecordBatch.from_arrays([part.column(0), lists(ends, out)], ["doc", "ids"])

    return write_relation(relation.mapInArrow(run, "doc long, ids array<long>"), "occurrences")


def phrases_of(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases (id, a, b, f) with what follows from their two shorter phrases.

    `heads` and `tails` hold the counts of both parts of each cut, `last` the last word.
    """
    left = shorter.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("front"), F.col("heads"), F.col("f").alias("of_a"))
    right = shorter.select(F.col("id").alias("b"), "last", "tails", F.col("f").alias("of_b"))
    return pairs.join(left, "a").join(right, "b").select(
        "id", "a", "b", "f", "lang", F.concat_ws(" ", "front", "last").alias("phrase"), "last",
        F.concat("heads", F.array("of_a")).alias("heads"), F.concat(F.array("of_b"), "tails").alias("tails"))


def lowest_cut(words: int, scale: int) -> Column:
    """Struct (score, k, l, r) of the lowest-scoring cut, the first of equal ones."""
    wide = lambda c: c.cast("decimal(20,0)")
    cuts = []
    for k in range(1, words):
        left, right = F.element_at("heads", k), F.element_at("tails", k)
        score = F.call_function("div", wide(F.col("f")) * F.lit(scale).cast("decimal(10,0)"), wide(left) + wide(right))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def mine(
    docs: DataFrame, least: int = 30, longest: int = 4, share: int = 80, scale: int = 2_000_000,
    text_col: str = "text", lang_col: str = "lang", held: int = 1_000_000,
) -> DataFrame:
    """Phrases of 2 to `longest` words with at least `least` occurrences: lang, phrase, words, a, l, r, n, score.

    Left out are phrases inside a longer one with at least `share` percent of their occurrences. `held` bounds
    the rows of a table that is sent to every task.
    """
    source = docs.select(
        F.monotonically_increasing_id().alias("doc"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # One row per frequent word, and one per language for the rest, which only counts.
    words = scratch_table(
        word_counts(source).groupBy("lang", F.when(F.col("f") >= least, F.col("word")).alias("word")).agg(F.sum("f").alias("f")),
        "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent, count = numbered(words.where(F.col("word").isNotNull()), ["lang", "word"])
    none = F.array().cast("array<bigint>")
    levels = [frequent.select("id", "f", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
                              none.alias("heads"), none.alias("tails"))]
    relation = first_relation(source, frequent, count, held)
    for length in range(2, longest + 1):
        frequent, count = numbered(pair_counts(relation).where(F.col("f") >= least), ["a", "b"])
        levels.append(scratch_table(phrases_of(frequent, levels[-1]), "phrases"))
        if length < longest:
            relation = next_relation(relation, frequent, count, held)
    found = None
    for words_of, phrases in enumerate(levels[1:], start=2):
        kept = phrases
        if words_of < longest:
            # A phrase is inside longer candidates by way of those of one more word, which occur at least as often.
            longer = levels[words_of]
            around = longer.select(F.col("a").alias("inner"), "f").unionByName(longer.select(F.col("b").alias("inner"), "f"))
            most = around.groupBy("inner").agg(F.max("f").alias("most"))
            kept = phrases.join(most, phrases["id"] == most["inner"], "left").where(
                F.col("most").isNull() | (100 * F.col("most") < share * F.col("f")))
        scored = kept.withColumn("cut", lowest_cut(words_of, scale)).select(
            "lang", "phrase", F.lit(words_of).alias("words"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
        found = scored if found is None else found.unionByName(scored)
    return found.join(totals, "lang")


def best(candidates: DataFrame, per_lang: int) -> DataFrame:
    """The first of each language by score, occurrences and phrase, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # Every task keeps its own first rows before they meet.
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
