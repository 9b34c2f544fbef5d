"""Byte-level BPE files and texts: the vocabulary as bytes, the word rule, a cache of encoded chunks, array tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Fixed value: the word pattern of byte-level BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS = regex.compile(WORD_PATTERN)
SAFE_GAP = regex.compile(r"(?<=\S) (?=\S)")
EDGE_SPACE = regex.compile(r"\A\s|\s\Z|\A\Z")
LONGEST_KEPT = 48
CLOSING = tuple(".,!?;:")
KEPT = 200_000  # entries of one generation of a cache
GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # 2**64 over the golden ratio
ROWS_PER_BATCH, BYTES_PER_BATCH = 1024, 1_000_000
LATIN_END = "\u0250"  # below it, what Python calls a letter is one in every Unicode version


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def printable_bytes() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    labels: dict[int, bytes]  # id -> bytes
    merges: list[tuple[int, int, int]]  # (left id, right id, joined id) in rank order
    special: dict[str, int]  # strings that are cut out of a text before the words are


def parse_vocabulary(text: str) -> Vocabulary:
    """Read a tokenizers file; anything but plain byte-level BPE is refused."""
    data = json.loads(text)
    model, splitter = data["model"], data.get("pre_tokenizer") or {}
    plain = (
        model["type"] == "BPE" and not model.get("dropout") and data.get("normalizer") is None
        and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space", True) and not model.get("ignore_merges")
    )
    if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
        raise ValueError("only byte-level BPE without normalizer, prefix space or dropout is supported")
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    alphabet = printable_bytes()
    ids = model["vocab"]
    labels = {i: bytes(alphabet[c] for c in word) for word, i in ids.items() if word not in special}
    merges = []
    for merge in model["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((ids[left], ids[right], ids[left + right]))
    return Vocabulary(labels | {i: s.encode() for s, i in special.items()}, merges, special)


class _Unsafe(Exception):
    pass


class TextEncoder:
    """Whole texts to ids, given as little-endian unsigned 32-bit bytes.

    A single space between two non-space characters always starts a new word, so a text falls into
    chunks that are encoded independently; chunks and words seen before come from bounded caches.
    """

    def __init__(self, encode_word: Callable[[str], bytes], special: dict[str, int], kept: int = KEPT):
        self.encode_word, self.kept = encode_word, kept
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}
        self.cut = regex.compile("|".join(f"({regex.escape(s)})" for s in special)) if special else None
        # Two generations: a full one becomes the older, which gives up what is still asked for.
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.encode_word(word)
            if len(word) <= LONGEST_KEPT:
                if len(self.words) >= self.kept:
                    self.words.clear()
                self.words[word] = found
        return found

    def run(self, text: str) -> bytes:
        return b"".join([self.word(w) for w in WORDS.findall(text)])

    def after_space(self, chunk: str) -> bytes:
        """Ids of a chunk that a single space precedes."""
        found = self.older.get(chunk)
        if found is None:
            simple = chunk.isascii() or max(chunk) < LATIN_END
            if simple and chunk.isalpha():
                found = self.encode_word(" " + chunk)
            elif simple and chunk[-1:] in CLOSING and chunk[:-1].isalpha():
                stem = chunk[:-1]
                found = self.chunks.get(stem) or self.older.get(stem) or self.encode_word(" " + stem)
                found += self.word(chunk[-1])
            elif EDGE_SPACE.search(chunk):
                raise _Unsafe
            else:
                found = self.run(" " + chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self.chunks) >= self.kept:
                self.older, self.chunks = self.chunks, {}
            self.chunks[chunk] = found
        return found

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        get, miss = self.chunks.get, self.after_space
        try:
            if EDGE_SPACE.search(first):
                raise _Unsafe
            return self.run(first) + b"".join([get(c) or miss(c) for c in rest])
        except _Unsafe:
            first, *rest = SAFE_GAP.split(text)
            # White space at the end belongs to the last chunk, so only whole-text ends differ.
            return self.run(first) + b"".join([get(c) or self.run(" " + c) for c in rest])

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        out, at = [], 0
        for found in self.cut.finditer(text):
            out += [self.plain(text[at : found.start()]), self.special[found.group()]]
            at = found.end()
        return b"".join([*out, self.plain(text[at:])])


class BatchEncoder:
    """`TextEncoder` for batches of texts: the words that no cache knows are encoded together."""

    def __init__(self, encode_words: Callable[[list[str]], list[bytes]], special: dict[str, int], kept: int = KEPT // 2):
        self.encode_words, self.kept = encode_words, kept
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}
        self.cut = regex.compile("|".join(f"({regex.escape(s)})" for s in special)) if special else None
        # Ids of chunks that a single space precedes. Two generations: a full one becomes the older,
        # which gives up what is still asked for.
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if self.cut is None:
            return self.plain_all(texts)
        special = [any(s in t for s in self.special) for t in texts]
        if not any(special):
            return self.plain_all(texts)
        pieces: list[str] = []
        plan = []
        for text, cut in zip(texts, special):
            own: list[int | bytes] = []
            at = 0
            for found in self.cut.finditer(text) if cut else ():
                own += [len(pieces), self.special[found.group()]]
                pieces.append(text[at : found.start()])
                at = found.end()
            own.append(len(pieces))
            pieces.append(text[at:])
            plan.append(own)
        coded = self.plain_all(pieces)
        return [b"".join([x if isinstance(x, bytes) else coded[x] for x in own]) for own in plan]

    def plain_all(self, texts: list[str]) -> list[bytes]:
        """Texts without special strings."""
        known, older, missing = self.chunks, self.older, set()
        split, coded, holes = [], [], []

        def look_up(chunks: list[str]) -> tuple[list[bytes | None], list[int]]:
            found = list(map(known.get, chunks))
            return found, [i for i, ids in enumerate(found) if ids is None]

        for text in texts:
            s = text.split(" ")
            found, open_ = look_up(s)
            open_ = open_ if open_ and open_[0] == 0 else [0, *open_]  # no space precedes the first
            # White space beside a chunk's space may belong to another word: such texts are cut at safe gaps only.
            if any([len(s[i].strip()) != len(s[i]) or not s[i] for i in open_]):
                s = SAFE_GAP.split(text)
                found, open_ = look_up(s)
                open_ = open_ if open_ and open_[0] == 0 else [0, *open_]
            missing.update([s[i] for i in open_[1:]])
            split.append(s)
            coded.append(found)
            holes.append(open_)
        again = missing.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        missing -= again
        self.learn(missing, [s[0] for s in split])
        out = []
        for s, found, open_ in zip(split, coded, holes):
            for i in open_:
                found[i] = known.get(s[i])
            found[0] = b"".join([self.words[w] for w in WORDS.findall(s[0])])
            out.append(b"".join(found))
        for c in missing:
            if len(c) > LONGEST_KEPT:
                del known[c]
        if len(known) >= self.kept:
            self.older, self.chunks = known, {}
        if len(self.words) >= self.kept:
            self.words = {}
        return out

    def learn(self, chunks: set[str], firsts: list[str]) -> None:
        """Encode chunks that a single space precedes, and the words of the texts' first chunks."""
        known, words = self.chunks, self.words
        plain, closed, cut = [], [], []
        for c in chunks:
            if c.isascii() or max(c) < LATIN_END:
                if c.isalpha():
                    plain.append(c)
                    continue
                if c[-1] in CLOSING and c[:-1].isalpha():
                    closed.append(c)
                    continue
            cut.append(c)
        stems = {c[:-1] for c in closed}.difference(known, chunks)
        plain += stems
        pieces = [WORDS.findall(" " + c) for c in cut]
        rest = {w for part in chain(pieces, map(WORDS.findall, firsts)) for w in part}
        fresh = [w for w in rest.union(CLOSING) if w not in words]
        coded = self.encode_words([" " + c for c in plain] + fresh)
        known.update(zip(plain, coded))
        words.update(zip(fresh, coded[len(plain) :]))
        for c in closed:
            known[c] = known[c[:-1]] + words[c[-1]]
        for c, part in zip(cut, pieces):
            known[c] = b"".join([words[w] for w in part])
        for c in stems:
            if len(c) > LONGEST_KEPT:
                del known[c]


class Lookup:
    """A fixed table from non-negative numbers to numbers, asked for many keys at once (linear probing)."""

    @classmethod
    def of(cls, entries: dict[int, int], missing: int) -> Lookup:
        size = len(entries)
        return cls(np.fromiter(entries, np.int64, size), np.fromiter(entries.values(), np.int64, size), missing)

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        bits = max(4, (8 * len(keys)).bit_length() - 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, missing, np.int64)
        self.missing, at, left = missing, self._first(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]  # of equal places the last one wins
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = at[left] + 1 & self.mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * GOLDEN >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._first(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], self.missing)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            at[left] = at[left] + 1 & self.mask
            held, asked = self.keys[at[left]], keys[left]
            hit = left[held == asked]
            out[hit] = self.values[at[hit]]
            left = left[(held != asked) & (held >= 0)]
        return out


class Labels:
    """The bytes of every token in one buffer; None for an id without any."""

    def __init__(self, labels: list[bytes | None]):
        self.buffer = np.frombuffer(b"".join([x or b"" for x in labels]), np.uint8)
        self.size = np.array([-1 if x is None else len(x) for x in labels], np.int64)
        held = np.maximum(self.size, 0)
        self.start = np.cumsum(held) - held

    def joined(self, flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The labels of rows of ids, given as one array and the rows' ends (first entry 0)."""
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.size) or self.size[flat].min() < 0):
            raise KeyError("an id is not in the vocabulary")
        sizes = self.size[flat]
        stops = np.cumsum(sizes)
        moved = np.repeat(self.start[flat] - (stops - sizes), sizes)
        moved += np.arange(len(moved))
        whole = self.buffer[moved].tobytes()
        cuts = np.r_[0, stops][ends].tolist()
        return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts or ids hold a bounded number of bytes, or single rows."""
    held = batch.column(column)
    lists = pa.types.is_list(held.type)
    sizes, each = (pc.list_value_length(held), 4) if lists else (pc.binary_length(held), 1)
    low, ends = 0, np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64) * each
    while low < batch.num_rows:
        base = ends[low - 1] if low else 0
        high = int(np.searchsorted(ends, base + BYTES_PER_BATCH, side="right"))
        high = min(max(high, low + 1), low + ROWS_PER_BATCH)
        yield batch.slice(low, high - low)
        low = high
