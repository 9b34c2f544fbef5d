"""SentencePiece encoding and decoding for vocabularies that were made by merges.

A text gets one space in front and its spaces become the mark of the vocabulary. Its characters are the first
symbols; an agenda holds every pair of neighbouring symbols that together are a piece, ordered by the piece's
score, the leftmost first among equals. The best entry is taken, its symbols become one, and the pairs the new
symbol makes with its neighbours enter, until the agenda is empty. Symbols that are no piece become the ids of
their bytes.

No piece has the mark behind another character, so a text falls apart before every run of marks, and a part is
encoded once while a bounded cache knows it. The agendas of short parts are the rows of one array: the best
entry of every row is taken at the same time. Long parts have a heap each.

In every Arrow batch the parts that were encoded in it are encoded by the sentencepiece library as well; a
difference ends the job. Decoding joins the pieces' texts and drops the space in front.

Defined cases: a null text is empty; an empty text has the begin and end ids alone and decodes to an empty
text; ids outside the vocabulary raise; bytes that are no UTF-8 decode as the library says; rows may repeat
and columns other than the id and the text are not read; an empty table gives an empty result. Vocabularies
that are not made by merges, that normalize texts, or that have pieces of the user's own are refused.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.llm.bpe_text import Labels, Lookup, slices

MARK = "▁"  # fixed value: stands for a space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces in a model file
PARTS = regex.compile(f"{MARK}+[^{MARK}]*")
SYMBOL_BITS = 21
LAST = 1 << 40  # a rank behind every piece's
SIDE_BY_SIDE = 32  # characters of a part that takes a row of the array
ROWS = 16_384  # of the array
KEPT, LONGEST_KEPT = 200_000, 48


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The tables of a model file and the parts known so far; once per worker process."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        data = sentencepiece_model_pb2.ModelProto.FromString(model)
        trainer, normalizer, kinds = data.trainer_spec, data.normalizer_spec, {p.type for p in data.pieces}
        plain = (
            trainer.model_type == trainer.BPE and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix
            and not normalizer.precompiled_charsmap and normalizer.add_dummy_prefix and normalizer.escape_whitespaces
            and not normalizer.remove_extra_whitespaces and kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        )
        texts = [p.piece for p in data.pieces]
        if not plain or any(MARK in t.lstrip(MARK) for t in texts):
            raise ValueError("only merge vocabularies with byte fallback, a space in front and no normalization are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.ids = {p.piece: i for i, p in enumerate(data.pieces) if p.type == NORMAL}
        self.byte_ids = [0] * 256
        labels: list[bytes] = []
        for i, p in enumerate(data.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
            label = {NORMAL: p.piece.replace(MARK, " ").encode(), UNKNOWN: trainer.unk_surface.encode(), CONTROL: b""}
            labels.append(bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else label[p.type])
        self.labels = Labels(labels)
        self.starts = np.array([p.type == NORMAL and p.piece.startswith(MARK) for p in data.pieces])
        self._compile_pairs([p.score for p in data.pieces])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _compile_pairs(self, scores: list[float]) -> None:
        """Symbols are pieces, then characters that only occur inside pieces; each pair that makes a piece."""
        symbols = dict(self.ids)
        for piece in self.ids:
            for char in piece:
                symbols.setdefault(char, len(scores) + len(symbols))
        order = {s: i for i, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        self.rank = np.full(len(scores), LAST, np.int64)
        self.pairs: dict[int, int] = {}
        for piece, number in self.ids.items():
            self.rank[number] = order[scores[number]]
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left << SYMBOL_BITS | right] = number
        self.found = Lookup.of(self.pairs, -1)
        self.ranks = self.rank.tolist()
        # A character that is in no piece is the negative of its code point, less one.
        self.of_char = -np.arange(0x110000, dtype=np.int64) - 1
        self.char_of = {}
        for text, symbol in symbols.items():
            if len(text) == 1:
                self.of_char[ord(text)] = symbol
                self.char_of[symbol] = text
        self.pieces = len(scores)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 for none."""
        real = (left >= 0) & (right >= 0)
        return np.where(real, self.found.get(np.where(real, left << SYMBOL_BITS | right, 0)), -1)

    def side_by_side(self, parts: list[str], sizes: np.ndarray) -> list[bytes]:
        """Short parts: row i of the agenda holds the ranks of the pairs of part i."""
        n, width = len(parts), int(sizes.max())
        chars = self.of_char[np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")]
        starts = np.cumsum(sizes) - sizes
        gap = -(1 << 40)  # no symbol
        symbols = np.full((n, width + 1), gap, np.int64)
        inside = np.arange(width + 1)[None, :] < sizes[:, None]
        symbols[inside] = chars
        made = self.merged(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, width)
        agenda = np.where(made >= 0, self.rank[made], LAST)
        out: list[bytes] = [b""] * n
        rows = np.arange(n)
        while len(rows):
            best = agenda.argmin(axis=1)
            at = np.arange(len(rows))
            open_ = agenda[at, best] < LAST
            if not open_.all():
                done = ~open_
                for row, coded in zip(rows[done].tolist(), self.emitted(symbols[done], gap)):
                    out[row] = coded
                rows, symbols, made, agenda, best = rows[open_], symbols[open_], made[open_], agenda[open_], best[open_]
                at = at[: len(rows)]
                if not len(rows):
                    break
            new = made[at, best]
            # The pair's second symbol goes: what is behind it moves up by one.
            behind = np.arange(symbols.shape[1] - 1)[None, :] > best[:, None]
            symbols = np.where(behind, symbols[:, 1:], symbols[:, :-1])
            symbols[at, best] = new
            behind = behind[:, : made.shape[1] - 1]
            made = np.where(behind, made[:, 1:], made[:, :-1])
            agenda = np.where(behind, agenda[:, 1:], agenda[:, :-1])
            for side in (best - 1, best):
                ask = np.flatnonzero((side >= 0) & (side < made.shape[1]))
                spot = side[ask]
                pair = self.merged(symbols[ask, spot], symbols[ask, spot + 1])
                made[ask, spot] = pair
                agenda[ask, spot] = np.where(pair >= 0, self.rank[pair], LAST)
            if made.shape[1] == 0:
                for row, coded in zip(rows.tolist(), self.emitted(symbols, gap)):
                    out[row] = coded
                break
        return out

    def emitted(self, symbols: np.ndarray, gap: int) -> list[bytes]:
        """Ids of rows of symbols."""
        used = symbols != gap
        plain = (symbols < self.pieces) & (symbols >= 0)
        odd = (used & ~plain).any(axis=1)
        ends = np.r_[0, np.cumsum(used.sum(axis=1))].tolist()
        flat = symbols[used].astype("<u4").tobytes()
        out = [flat[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self.spelled(symbols[i][used[i]].tolist())
        return out

    def spelled(self, symbols: list[int]) -> bytes:
        """Ids of symbols, those that are no piece by their bytes."""
        ids: list[int] = []
        for s in symbols:
            if 0 <= s < self.pieces:
                ids.append(s)
            else:
                ids += [self.byte_ids[b] for b in (self.char_of[s] if s >= 0 else chr(-s - 1)).encode()]
        return np.array(ids, "<u4").tobytes()

    def alone(self, part: str) -> bytes:
        """A part of any length, its agenda a heap of (rank, place of the first symbol, both symbols, piece)."""
        pairs, ranks = self.pairs, self.ranks
        symbols = self.of_char[np.frombuffer(part.encode("utf-32-le"), "<u4")].tolist()
        size = len(symbols)
        before, behind = list(range(-1, size - 1)), list(range(1, size + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            a, b = symbols[left], symbols[right]
            piece = pairs.get(a << SYMBOL_BITS | b) if a >= 0 and b >= 0 else None
            if piece is not None:
                heapq.heappush(agenda, (ranks[piece], left, a, b, piece))

        for i in range(size - 1):
            offer(i, i + 1)
        gone = -(1 << 40)
        while agenda:
            _, left, a, b, piece = heapq.heappop(agenda)
            right = behind[left] if symbols[left] == a else size
            if right >= size or symbols[right] != b:
                continue  # one of the two has become part of another symbol
            symbols[left], symbols[right] = piece, gone
            behind[left] = after = behind[right]
            if after < size:
                before[after] = left
                offer(left, after)
            if before[left] >= 0:
                offer(before[left], left)
        return self.spelled([s for s in symbols if s != gone])

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts, each beginning with a mark."""
        sizes = np.array([len(p) for p in parts], np.int64)
        out: list[bytes] = [b""] * len(parts)
        together = np.flatnonzero(sizes <= SIDE_BY_SIDE)
        together = together[np.argsort(sizes[together], kind="stable")]
        for low in range(0, len(together), ROWS):
            chosen = together[low : low + ROWS]
            for i, coded in zip(chosen.tolist(), self.side_by_side([parts[i] for i in chosen.tolist()], sizes[chosen])):
                out[i] = coded
        for i in np.flatnonzero(sizes > SIDE_BY_SIDE).tolist():
            out[i] = self.alone(parts[i])
        return out

    def checked(self, parts: list[str]) -> list[bytes]:
        """Ids of parts; the library, which puts the first mark itself, must give the same."""
        coded = self.encode_parts(parts)
        asked = [i for i, p in enumerate(parts) if p != MARK]  # it gives nothing for a mark alone
        wanted = self.library.encode([parts[i][1:] for i in asked], num_threads=1)
        whole = np.fromiter(chain.from_iterable(wanted), "<u4").tobytes()
        given = [coded[i] for i in asked]
        if b"".join(given) != whole or [len(c) // 4 for c in given] != [len(w) for w in wanted]:
            wrong = next(parts[i] for i, w in zip(asked, wanted) if np.array(w, "<u4").tobytes() != coded[i])
            raise ValueError(f"the library has other ids for {wrong[:80]!r}")
        return coded

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, with the begin and end ids."""
        split: list[list[str]] = []
        for text in texts:
            # Most parts are a word behind one space; they are known by the word.
            words = text.split(" ") if text else []
            if "" in words or MARK in text:
                words = [p[1:] for p in PARTS.findall(MARK + text.replace(" ", MARK))]
            split.append(words)
        known, older = self.known, self.older
        missing = set().union(*split).difference(known)
        fresh = []
        for word in sorted(missing):
            found = older.get(word)
            if found is None:
                fresh.append(word)
            else:
                known[word] = found
        if fresh:
            known.update(zip(fresh, self.checked([MARK + w for w in fresh])))
        first, last = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        out = [b"".join([first, *[known[w] for w in words], last]) for words in split]
        for word in fresh:
            if len(word) > LONGEST_KEPT:
                del known[word]
        if len(known) >= KEPT:
            self.older, self.known = known, {}
        return out

    def decode_all(self, coded: list[bytes]) -> list[str]:
        flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int64)
        ends = np.cumsum([0] + [len(c) // 4 for c in coded])
        out = []
        for joined, a, b in zip(self.labels.joined(flat, ends), ends.tolist(), ends[1:].tolist()):
            at = a
            while at < b and self.labels.size[flat[at]] == 0:
                at += 1
            try:
                text = joined.decode()
                out.append(text[1:] if at < b and self.starts[flat[at]] else text)
            except UnicodeDecodeError:
                out.append(self.library.decode(flat[a:b].tolist()))
        return out


@lru_cache(maxsize=2)
def compiled(model: bytes) -> Pieces:
    return Pieces(model)


def sent_model(docs: DataFrame, path: str) -> Broadcast:
    """The model file (of a fixed size) as a broadcast, read on the driver alone."""
    return docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and `ids` of each whole text: little-endian unsigned 32-bit, begin and end ids included."""
    source = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    sent = sent_model(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = compiled(sent.value)
        for part in (x for batch in batches for x in slices(batch, 1)):
            coded = pieces.encode_all(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(coded, pa.binary())], ["_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, ids binary").withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Ids (as `encode` gives them, null: none) back to `text`, keeping the ids."""
    source = encoded.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{ids_col}`"), F.lit(b"")).alias("ids"))
    sent = sent_model(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = compiled(sent.value)
        for part in (x for batch in batches for x in slices(batch, 1)):
            texts = pieces.decode_all(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["_id", "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, ids binary, text string").withColumnRenamed("_id", id_col)
