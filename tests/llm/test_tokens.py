import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidescore.llm import bpe_automaton, packing
from tidescore.llm.bpe_text import default_path, parse_vocabulary, printable_bytes

PATH = default_path()
LIBRARY = Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(1)
    letters = [chr(i) for i in range(1, 0x3000) if not 0xD800 <= i < 0xE000] + ["\U0001F600", "\U00020000"]
    mixed = ["".join(rng.choices(letters + [" "] * 3000, k=1500)) for _ in range(12)]
    spaces = ["".join(rng.choices([" ", "\n", "\t", "a", "A1", "'s", "\u0301", "\u3000", "\x1c", "\x85"], k=800)) for _ in range(12)]
    return ["", " ", "  a", "a  b ", "\n\n x", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "it's we'll I'M x", "½²٣ⅷ一é",
            "x" * 3000, " " * 500 + "y", "word " * 4000, "aaa aaaa aaaaaaa", "Hello, world!!! (it's)", "foo. bar, baz; q"] + mixed + spaces


TEXTS = [None, *odd_texts(), "repeated row", "repeated row"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def frame(spark, texts):
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


def test_automaton_equals_the_library(spark):
    encoded = bpe_automaton.encode(frame(spark, TEXTS), PATH)
    for r in bpe_automaton.decode(encoded, PATH).collect():
        want = library_ids(TEXTS[r.doc_id])
        assert r.ids == want and r.text == LIBRARY.decode(want, skip_special_tokens=False) == (TEXTS[r.doc_id] or "")
    assert bpe_automaton.encode(frame(spark, []), PATH).count() == 0


def test_gadgets_on_small_merges():
    """Against applying the merges in rank order to every word over two letters."""
    vocabulary = parse_vocabulary(open(PATH, encoding="utf-8").read())
    a, b = 0, 1
    merges = [(a, a, 2), (2, b, 3), (b, b, 4), (2, 2, 5), (3, 3, 6), (4, a, 7), (a, b, 8), (b, 3, 9)]
    labels = {0: b"a", 1: b"b"}
    for x, y, xy in merges:
        labels[xy] = labels[x] + labels[y]
    vocabulary.labels, vocabulary.merges = labels, merges
    automaton = bpe_automaton.Automaton(vocabulary)

    def by_rank(word):
        tokens = [0 if c == "a" else 1 for c in word]
        for x, y, xy in merges:
            out, i = [], 0
            while i < len(tokens):
                pair = tokens[i : i + 2] == [x, y]
                out.append(xy if pair else tokens[i])
                i += 2 if pair else 1
            tokens = out
        return tokens

    words = ["".join("ab"[bits >> i & 1] for i in range(n)) for n in range(1, 13) for bits in range(1 << n)]
    together = automaton.encode_words([w.encode() for w in words])
    for word, ids in zip(words, together):
        assert automaton.encode_word(word.encode()) == np.frombuffer(ids, "<u4").tolist() == by_rank(word), word


def test_words_side_by_side_and_alone():
    """Words through the arrays, one by one, and through the library's model; some too long for the arrays."""
    vocabulary = parse_vocabulary(open(PATH, encoding="utf-8").read())
    automaton = bpe_automaton.Automaton(vocabulary)
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoin shrdluíß漢\x00\U0001F600", k=rng.choice([1, 3, 9, 20, 70, 200]))).encode()
             for _ in range(1500)]
    together = automaton.encode_words([*words, b""])
    assert together[-1] == b""
    spell = {b: c for c, b in printable_bytes().items()}
    for word, ids in zip(words, together):
        want = [t.id for t in LIBRARY.model.tokenize("".join(spell[b] for b in word))]
        assert automaton.encode_word(word) == np.frombuffer(ids, "<u4").tolist() == want


def test_other_files_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        parse_vocabulary(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_unknown_ids_raise(spark):
    with pytest.raises(Exception, match="KeyError"):
        bpe_automaton.decode(spark.createDataFrame([(1, [99_999_999])], "doc_id long, ids array<int>"), PATH).collect()


def check_packing(rows, texts, size):
    whole = {i: library_ids(t) + [2] for i, t in enumerate(texts)}
    pieces, sequences = {}, {}
    for r in rows:
        part = whole[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(whole)
    for doc, found in pieces.items():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert sum(n for _, _, n in found) == len(whole[doc])
        assert all(n == size for _, _, n in found[1:]) and (len(found) == 1 or len(whole[doc]) > size)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences), -(-sum(map(len, whole.values())) // size)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_packing_is_whole_and_tight(spark, parts):
    rng = random.Random(parts)
    texts = TEXTS + [" ".join(rng.choices(["one", "two", "three"], k=rng.randint(0, 400))) for _ in range(400)]
    docs = frame(spark, texts).repartition(parts, "doc_id")
    rows = packing.pack(docs, PATH, size=256, end_id=2, fan=4).collect()
    used, least = check_packing(rows, texts, 256)
    assert used <= least * 1.03 + 1


def test_packing_carries_only_so_many_bins(spark):
    texts = ["one " * 140 for _ in range(60)]
    rows = packing.pack(frame(spark, texts).repartition(6, "doc_id"), PATH, size=256, fan=2, carried=3).collect()
    check_packing(rows, texts, 256)
    assert packing.pack(frame(spark, []), PATH).count() == 0
    kept = packing.pack(frame(spark, ["a b"]), PATH, keep_ids=True).first()
    assert np.frombuffer(bytes(kept.ids), "<u4").tolist() == [*library_ids("a b"), 2]


def test_groups_do_not_grow_with_the_bins(spark):
    """A third of all rows in bins that merge with nothing, and one bin per partition that fits one of them."""
    rng = random.Random(3)
    bins = [(p << packing.BIN_BITS | i, rng.randint(520, 1000)) for p in range(16) for i in range(1000)]
    small = [(p << packing.BIN_BITS | 1000, rng.randint(20, 500)) for p in range(16)]
    frame = spark.createDataFrame(bins + small, "bin long, fill long")
    moved = packing.repack(frame, 16, 1024, 65_536).collect()
    assert len(moved) <= 16 * 17
    fills, sums = dict(bins + small), {}
    for r in sorted(moved, key=lambda r: (r.parent, r.base)):
        assert r.base == sums.get(r.parent, 0)
        sums[r.parent] = r.base + fills[r.bin]
    assert max(sums.values()) <= 1024 and {b for b, _ in small} <= {r.bin for r in moved}
    fit = packing.BestFit(1024)
    for fill in sorted(fills.values(), reverse=True):
        fit.place(fill)
    assert len(fills) - len(moved) + len(sums) == fit.opened


def test_best_fit_takes_the_tightest_room():
    fit = packing.BestFit(10)
    assert [fit.place(n) for n in (7, 8, 2, 3, 5, 5)] == [(0, 0), (1, 0), (1, 8), (0, 7), (2, 0), (2, 5)]
    assert packing.cut_lengths(25, 10) == [(0, 5), (5, 10), (15, 10)] and packing.cut_lengths(10, 10) == [(0, 10)]


def test_query_digests(spark, folder):
    from tidescore.llm.queries import QUERIES, table

    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    for r in QUERIES["op6_bpe"](spark, folder).collect():
        ids = library_ids(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    ids = sorted(texts)
    rows = [r for r in QUERIES["op9_packing"](spark, folder).collect()]
    place = {d: i for i, d in enumerate(ids)}
    renamed = [type(r)(**(r.asDict() | {"doc_id": place[r.doc_id]})) for r in rows]
    used, least = check_packing(renamed, [texts[d] for d in ids], 1024)
    assert used <= least + 3
