"""BPE as a deterministic automaton, compiled merge by merge into tables and walked one step a byte.

Compilation starts with one state that loops on every byte. The gadget of a merge (a, b) takes the state
reached by a, copies it without its b arc, leads every a arc to the copy, and gives each state with an a arc
an arc for the joined token to where b led before. When all merges are in, a token sequence is accepted
exactly if it is the BPE encoding of its bytes.

Every token has one state behind its arcs, so a gadget is stored as the merge number at which a lost its b
arc, and whether an arc leaves a state follows from these numbers and the halves of the two tokens.

Every prefix of a word has exactly one accepted path, so it has one last token. The second table is the
automaton of all suffixes of the read bytes that start a label: (state, byte) -> state, with a link to the
next shorter suffix. While the whole word read so far starts some label, the state alone tells the last
token, which is worked out for every such state when the tables are compiled. Beyond, the labels that end at
the byte are tried by their arcs from the state the shorter prefix left, longest first; one of them has its
arc. No position is read twice; the tokens follow from the last ones, back to front. Decoding emits the
labels of the arcs, gathered from one buffer.

Defined cases: a null text is empty and has no ids; unknown ids in `decode` raise; rows may repeat and
columns other than the id and the text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.llm.bpe_text import BatchEncoder, Labels, Lookup, Vocabulary, parse_vocabulary, slices

KNOWN_ARCS = 200_000
SIDE_BY_SIDE = 64  # words of up to so many bytes walk together, if there are so many of them
TOKEN_BITS = 20
NEVER = 1 << 40  # later than any merge


class Automaton:
    def __init__(self, vocabulary: Vocabulary):
        self.labels = vocabulary.labels
        joined = {j for _, _, j in vocabulary.merges}
        size = max(self.labels) + 1
        # Halves of a token and the merge that made it; a token of one byte was made before all merges.
        self.left, self.right, self.made = [-1] * size, [-1] * size, [-1] * size
        self.taken: dict[int, int] = {}  # (token, token): the merge whose gadget took the second's arc from the first
        live = {t for t, label in self.labels.items() if len(label) == 1 and t not in joined}
        for number, (a, b, ab) in enumerate(vocabulary.merges):
            if a in live and b in live and self.has_arc(a, b):
                self.taken[a << TOKEN_BITS | b] = number
                if ab not in live:
                    live.add(ab)
                    self.left[ab], self.right[ab], self.made[ab] = a, b, number
        self.live = live
        self.known: dict[int, bool] = {}
        self._compile_steps()
        self._compile_last()
        self.written = Labels([self.labels.get(t) for t in range(size)])
        self._compile_arrays()

    def has_arc(self, a: int, t: int) -> bool:
        """Whether an arc for `t` leaves the state behind `a`.

        The younger of the two tells where its arcs came from: a's state is a copy of its right half's as it
        was before a was made, and t's arc exists where its left half's was left when t was made.
        """
        taken, made, left, right, before = self.taken, self.made, self.left, self.right, NEVER
        while True:
            if taken.get(a << TOKEN_BITS | t, NEVER) < before:
                return False
            if made[a] > made[t]:
                before, a = made[a], right[a]
            elif made[t] >= 0:
                before, t = made[t] + 1, left[t]
            else:
                return True

    def arc(self, a: int, t: int) -> bool:
        """Look an arc up in the tables and note the answer."""
        if len(self.known) >= KNOWN_ARCS:
            self.known.clear()
        found = self.known[a << TOKEN_BITS | t] = self.has_arc(a, t)
        return found

    def _compile_steps(self) -> None:
        """Steps inside the labels, and for each state the longest proper suffix that is a state too."""
        self.step: dict[int, int] = {}
        self.ends, parent, came = [-1], [0], [0]
        for token in sorted(self.live, key=lambda t: len(self.labels[t])):
            node = 0
            for byte in self.labels[token]:
                key = node << 8 | byte
                there = self.step.get(key)
                if there is None:
                    there = self.step[key] = len(self.ends)
                    self.ends.append(-1)
                    parent.append(node)
                    came.append(byte)
                node = there
            self.ends[node] = token
        depth = [0] * len(parent)
        for node in range(1, len(parent)):  # a parent is numbered before its children
            depth[node] = depth[parent[node]] + 1
        self.parent, self.depth = parent, depth
        self.fall = [0] * len(parent)
        self.by_depth = sorted(range(1, len(parent)), key=depth.__getitem__)
        for node in self.by_depth:
            if depth[node] > 1:
                self.fall[node] = self.next_state(self.fall[parent[node]], came[node])
        # The tokens that end at a state, longest first, as a chain: own token, then the next state that has one.
        self.shorter = [0] * len(parent)
        for node in self.by_depth:
            below = self.fall[node]
            self.shorter[node] = below if self.ends[below] >= 0 else self.shorter[below]

    def next_state(self, state: int, byte: int) -> int:
        """One step of the automaton of suffixes; what a missing step falls back to is noted in the table."""
        there = self.step.get(state << 8 | byte)
        if there is not None:
            return there
        at = state
        while at:
            at = self.fall[at]
            there = self.step.get(at << 8 | byte)
            if there is not None:
                return there
        return 0

    def _compile_last(self) -> None:
        """The last token of the only accepted path over the bytes that lead to a state from the start."""
        self.last = [-1] * len(self.parent)
        for node in self.by_depth:
            found, token_end = -1, node if self.ends[node] >= 0 else self.shorter[node]
            while token_end:
                token = self.ends[token_end]
                at = node
                for _ in range(self.depth[token_end]):
                    at = self.parent[at]
                if at == 0 or self.last[at] >= 0 and self.has_arc(self.last[at], token):
                    found = token
                    break
                token_end = self.shorter[token_end]
            self.last[node] = found

    def encode_word(self, word: bytes) -> list[int]:
        """The last token of every prefix, one table step a byte, then the tokens from back to front."""
        step, last_of, node = self.step, self.last, 0
        last: list[int] = []
        for byte in word:
            node = step.get(node << 8 | byte, -1)
            if node < 0:
                self._beyond(word, last)
                break
            last.append(last_of[node])
        out, at, labels = [], len(last), self.labels
        while at:
            token = last[at - 1]
            if token < 0:
                raise ValueError("a byte of the word has no token")
            out.append(token)
            at -= len(labels[token])
        out.reverse()
        return out

    def _beyond(self, word: bytes, last: list[int]) -> None:
        """Last tokens from where the word is no longer the start of a label."""
        ends, shorter, depth, known, following = self.ends, self.shorter, self.depth, self.known, self.next_state
        node = 0
        for byte in word[: len(last)]:
            node = self.step[node << 8 | byte]
        for at in range(len(last), len(word)):
            node = following(node, word[at])
            tail, found = node if ends[node] >= 0 else shorter[node], -1
            while tail:
                token, start = ends[tail], at + 1 - depth[tail]
                if start == 0:
                    found = token
                    break
                before = last[start - 1]
                there = known.get(before << TOKEN_BITS | token)
                if there or there is None and before >= 0 and self.arc(before, token):
                    found = token
                    break
                tail = shorter[tail]
            last.append(found)

    def _compile_arrays(self) -> None:
        """The same tables for many words at once."""
        self.steps, self.takes = Lookup.of(self.step, -1), Lookup.of(self.taken, NEVER)
        held = ("left", "right", "made", "ends", "fall", "depth", "shorter", "last")
        self.at = {name: np.array(getattr(self, name), np.int64) for name in held}

    def next_states(self, states: np.ndarray, read: np.ndarray) -> np.ndarray:
        out = self.steps.get(states << 8 | read)
        left = np.flatnonzero(out < 0)
        at = states[left]
        while len(left):
            out[left[at == 0]] = 0
            left, at = left[at != 0], self.at["fall"][at[at != 0]]
            there = self.steps.get(at << 8 | read[left])
            out[left] = there
            left, at = left[there < 0], at[there < 0]
        return out

    def has_arcs(self, a: np.ndarray, t: np.ndarray) -> np.ndarray:
        """`has_arc` of many pairs."""
        made, out, left = self.at["made"], np.ones(len(a), bool), np.arange(len(a))
        before = np.full(len(a), NEVER)
        while len(left):
            gone = self.takes.get(a << TOKEN_BITS | t) < before
            out[left[gone]] = False
            of_a, of_t = made[a], made[t]
            on = ~gone & ((of_a >= 0) | (of_t >= 0))
            left, a, t, of_a, of_t = left[on], a[on], t[on], of_a[on], of_t[on]
            copied = of_a > of_t
            before = np.where(copied, of_a, of_t + 1)
            a, t = np.where(copied, self.at["right"][a], a), np.where(copied, t, self.at["left"][t])
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit bytes; short words walk side by side."""
        sizes = np.array([len(w) for w in words], np.int64)
        together = np.flatnonzero((sizes > 0) & (sizes <= SIDE_BY_SIDE))
        out = [b""] * len(words)
        if len(together) < SIDE_BY_SIDE:
            together = together[:0]
        else:
            together = together[np.argsort(-sizes[together], kind="stable")]
            coded, ends = self._walk([words[i] for i in together.tolist()], sizes[together])
            for i, a, b in zip(together.tolist(), ends.tolist(), ends[1:].tolist()):
                out[i] = coded[4 * a : 4 * b]
        alone = np.ones(len(words), bool)
        alone[together] = False
        for i in np.flatnonzero(alone).tolist():
            out[i] = np.array(self.encode_word(words[i]), "<u4").tobytes()
        return out

    def _walk(self, words: list[bytes], sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Words, longest first, one byte of each at a time: their ids in one run and where each word's end."""
        n, width, table = len(words), int(sizes[0]), self.at
        flat, starts = np.frombuffer(b"".join(words) + bytes(width), np.uint8), np.cumsum(sizes) - sizes
        last, state = np.full((width, n), -1, np.int64), np.zeros(n, np.int64)
        for i in range(width):
            going = int(np.searchsorted(-sizes, -i))  # words longer than i
            state = self.next_states(state[:going], flat[starts[:going] + i].astype(np.int64))
            row = last[i]
            row[:going] = table["last"][state]
            left = np.flatnonzero(table["depth"][state] <= i)
            tail = state[left]
            tail = np.where(table["ends"][tail] >= 0, tail, table["shorter"][tail])
            row[left] = -1
            while len(left):
                token, below = table["ends"][tail], table["shorter"][tail]
                right = below == 0  # exactly one label has its arc, so the only one left does
                ask = np.flatnonzero(~right)
                before = last[i - table["depth"][tail[ask]], left[ask]]
                right[ask] = self.has_arcs(before, token[ask])
                row[left[right]] = token[right]
                left, tail = left[~right], below[~right]
            if going and row[:going].min() < 0:
                raise ValueError("a byte of the word has no token")
        rounds, at, left = [], sizes.copy(), np.arange(n)
        counts = np.zeros(n, np.int64)
        while len(left):
            token = last[at[left] - 1, left]
            rounds.append((left, token))
            counts[left] += 1
            at[left] -= self.written.size[token]
            left = left[at[left] > 0]
        ends = np.r_[0, np.cumsum(counts)]
        ids = np.empty(ends[-1], "<u4")
        for back, (left, token) in enumerate(rounds, start=1):
            ids[ends[left + 1] - back] = token
        return ids.tobytes(), ends


@lru_cache(maxsize=2)
def compiled(text: str) -> tuple[Automaton, BatchEncoder]:
    """Tables of one vocabulary, once per worker process."""
    vocabulary = parse_vocabulary(text)
    automaton = Automaton(vocabulary)
    return automaton, BatchEncoder(lambda words: automaton.encode_words([w.encode() for w in words]), vocabulary.special)


def vocabulary_text(spark: SparkSession, path: str):
    """The vocabulary file (of a fixed size) as a broadcast, read on the driver alone."""
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds `ids` (array of int): the BPE ids of each whole text."""
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sent = vocabulary_text(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = compiled(sent.value)
        for batch in batches:
            for part in slices(batch, 1):
                coded = encoder.encode_all(part.column(1).to_pylist())
                ends = np.cumsum([0] + [len(c) // 4 for c in coded]).astype(np.int32)
                ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(coded), "<i4"))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Ids back to `text`, keeping the ids."""
    source = encoded.select(F.col(id_col).alias("_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    sent = vocabulary_text(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, _ = compiled(sent.value)
        for batch in batches:
            for part in slices(batch, 1):
                lists = part.column(1)
                ends = lists.offsets.to_numpy()
                texts = [t.decode("utf-8", "replace") for t in automaton.written.joined(
                    lists.flatten().to_numpy(zero_copy_only=False), ends - ends[0])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["_id", "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, ids array<int>, text string").withColumnRenamed("_id", id_col)
