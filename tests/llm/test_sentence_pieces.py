import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tidescore.llm import sentence_pieces as sp

PATH = sp.default_path()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_bos=True, add_eos=True)


def odd_texts():
    rng = random.Random(2)
    letters = [chr(i) for i in range(1, 0x3000) if not 0xD800 <= i < 0xE000] + ["\U0001F600", "\U00020000"]
    mixed = ["".join(rng.choices(letters + [" "] * 3000, k=1500)) for _ in range(8)]
    marks = ["".join(rng.choices([" ", "\n", "▁", "a", "A1", "the", "ing", "　", "漢", "\x00"], k=800)) for _ in range(8)]
    words = [" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 60))) for _ in range(400)) for _ in range(4)]
    return ["", " ", "  a", "a  b ", "▁", "▁▁x ▁", "a▁b", "<s></s><unk><0x0A>", "x" * 3000, " " * 500 + "y", "the " * 4000,
            "aaaa aaa aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", *mixed, *marks, *words]


TEXTS = [None, *odd_texts(), "repeated row", "repeated row"]


def frame(spark, texts):
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, _id int")


def test_equals_the_library(spark):
    rows = sp.decode(sp.encode(frame(spark, TEXTS), PATH), PATH).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(TEXTS)))
    for r in rows:
        want = library_ids(TEXTS[r.doc_id])
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want
        assert r.text == LIBRARY.decode(want) == (TEXTS[r.doc_id] or "").replace("▁", " ")
    assert sp.decode(sp.encode(frame(spark, []), PATH), PATH).count() == 0


def model_of(pieces, **changes):
    """A small model: control and byte pieces, then (text, score)."""
    data = sentencepiece_model_pb2.ModelProto()
    data.trainer_spec.model_type = data.trainer_spec.BPE
    data.trainer_spec.byte_fallback = True
    data.normalizer_spec.name, data.normalizer_spec.remove_extra_whitespaces = "identity", False
    first = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]]
    for text, score, kind in [*first, *[(*p, 1) for p in pieces]]:
        data.pieces.add(piece=text, score=score, type=kind)
    for name, value in changes.items():
        setattr(data.trainer_spec if hasattr(data.trainer_spec, name) else data.normalizer_spec, name, value)
    return data.SerializeToString()


def test_agendas_by_score_and_place():
    """All words over two letters against joining the best pair, leftmost first, until none is a piece; equal scores."""
    pieces = [("▁", -20.0), ("a", -21.0), ("aa", -1.0), ("ab", -1.0), ("▁a", -2.0), ("aab", -3.0), ("bb", -1.0), ("abab", -4.0),
              ("▁aa", -2.0), ("bab", -0.5)]
    own = sp.Pieces(model_of(pieces))
    scores = dict(pieces)

    def by_rule(text):
        s = list(text)
        while True:
            best = min(((-scores[x + y], i) for i, (x, y) in enumerate(zip(s, s[1:])) if x + y in scores), default=None)
            if best is None:
                return [own.ids[x] if x in own.ids else own.byte_ids[b] for x in s for b in (x.encode() if x not in own.ids else b"1")]
            s[best[1] : best[1] + 2] = [s[best[1]] + s[best[1] + 1]]

    parts = ["▁" + "".join("ab"[bits >> i & 1] for i in range(n)) for n in range(1, 11) for bits in range(1 << n)]
    for part, coded in zip(parts, own.checked(parts)):
        assert np.frombuffer(coded, "<u4").tolist() == by_rule(part)
        assert own.alone(part) == coded


@pytest.mark.parametrize("changes", [{"byte_fallback": False}, {"model_type": 1}, {"add_dummy_prefix": False}, {"remove_extra_whitespaces": True}])
def test_other_models_are_refused(changes):
    with pytest.raises(ValueError):
        sp.Pieces(model_of([("▁", -1.0)], **changes))
    with pytest.raises(ValueError):
        sp.Pieces(model_of([("a▁b", -1.0)]))


def test_a_difference_to_the_library_raises():
    own = sp.Pieces(open(PATH, "rb").read())
    own.encode_parts = lambda parts: [b"\0\0\0\0"] * len(parts)
    with pytest.raises(ValueError, match="the library has other ids"):
        own.encode_all(["one two"])


def test_odd_ids(spark):
    own = sp.Pieces(open(PATH, "rb").read())
    for ids in ([1, own.byte_ids[0xE2], own.byte_ids[0x28], 2], [0], [1, 1, 500, 2], [own.byte_ids[0xC3]], []):
        assert own.decode_all([np.array(ids, "<u4").tobytes()]) == [LIBRARY.decode(ids)]
    bad = spark.createDataFrame([(1, bytearray(np.array([99_999_999], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="KeyError"):
        sp.decode(bad, PATH).collect()
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert sp.decode(nothing, PATH).first().text == ""


def test_query_digests(spark, folder):
    from tidescore.llm.queries import QUERIES, table

    texts = {r.doc_id: r.text or "" for r in table(spark, folder, "documents").collect()}
    rows = QUERIES["op12_sentencepiece"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library_ids(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
