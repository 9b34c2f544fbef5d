"""The columnar codec against the message classes, on plain, odd and broken bytes."""

import math
import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from tidescore.functions import codec, wire
from tidescore.schemas import DESCRIPTOR_SCHEMA, FEATURES, MODEL_TYPES, RECORD_SCHEMA

NUMBERS = [0.0, -0.0, 1.5, -2.25, math.inf, math.nan, 5e-324, 1e308]
TEXTS = ["", "wine", "Ünï", "漢字", "x" * 127, "y" * 128, "z" * 20_000, "\x00", "\U0001F600"]


def same(a, b):
    return all(x == y and math.copysign(1, x) == math.copysign(1, y) or x != x and y != y if isinstance(x, float)
               and isinstance(y, float) else x == y for x, y in zip(a, b)) and len(a) == len(b)


def record_by_class(payload):
    found, error = codec._parse(codec.message_classes()[0], payload)
    return tuple(getattr(found, n) if found is not None else None for n in RECORD_SCHEMA.names) + (error,)


def descriptor_by_class(payload):
    found, error = codec._parse(codec.message_classes()[1], payload)
    if found is None:
        return (None,) * len(DESCRIPTOR_SCHEMA.names) + (error,)
    content, names = found.WhichOneof("content"), {n: k for k, n in MODEL_TYPES.items()}
    return (found.name, found.description, found.dataType, names.get(found.modeltype, str(found.modeltype)),
            found.data if content == "data" else None, found.location if content == "location" else None,
            None if content == "data" else codec.LOCATION_UNSUPPORTED)


def varint(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def broken(rng, whole):
    """A message cut short, with bytes changed, or with fields that a reader does not expect."""
    kind = rng.randrange(7)
    if kind == 0:
        return whole[: rng.randrange(len(whole) + 1)]
    if kind == 1 and whole:
        data = bytearray(whole)
        data[rng.randrange(len(data))] = rng.randrange(256)
        return bytes(data)
    if kind == 2:
        return whole + varint(40 << 3) + varint(rng.randrange(1 << 40))  # a number nobody knows
    if kind == 3:
        return varint(50 << 3 | 2) + varint(3) + b"abc" + whole
    if kind == 4:
        return whole + rng.randbytes(rng.randrange(20))
    if kind == 5:
        return whole + bytes([12 << 3 | 2]) + varint(2) + rng.choice([b"\xc3\x28", b"\xe2\x82", b"ok"])
    return whole + whole


def records(rng, count):
    cls, _ = codec.message_classes()
    return [cls(**{f: rng.choice(NUMBERS) for f in rng.sample(FEATURES, rng.randrange(12))}, dataType=rng.choice(TEXTS)).SerializeToString()
            for _ in range(count)]


def descriptors(rng, count):
    _, cls = codec.message_classes()
    out = []
    for _ in range(count):
        made = cls(name=rng.choice(TEXTS), description=rng.choice(TEXTS), dataType=rng.choice(TEXTS), modeltype=rng.choice([0, 1, 2, 7, 300]))
        if rng.random() < 0.6:
            made.data = rng.choice([b"", b"\xff\x00", rng.randbytes(5000)])
        elif rng.random() < 0.6:
            made.location = rng.choice(TEXTS)
        out.append(made.SerializeToString())
    return out


@pytest.mark.parametrize("seed", range(6))
def test_reading_equals_the_classes(seed):
    rng = random.Random(seed)
    for make, read, by_class in ((records, codec.records_from, record_by_class),
                                 (descriptors, codec.descriptors_from, descriptor_by_class)):
        whole = make(rng, 300)
        rows = [None, b"", *whole, *[broken(rng, rng.choice(whole)) for _ in range(900)]]
        rng.shuffle(rows)
        column = pa.array(rows, pa.binary())
        for part in (column, column.slice(7, 500), column.slice(0, 0)):
            for payload, found in zip(part.to_pylist(), read(part).to_pylist()):
                assert same(tuple(found.values()), by_class(payload)), payload


def test_plain_messages_need_no_classes(monkeypatch):
    rng = random.Random(9)
    rows, models = records(rng, 200), descriptors(rng, 200)
    monkeypatch.setattr(codec, "message_classes", lambda: pytest.fail("read one by one"))
    assert codec.records_from(pa.array(rows)).field("error").null_count == 200
    assert len(codec.descriptors_from(pa.array(models))) == 200


def test_writing_equals_the_classes():
    rng = random.Random(11)
    cls, model = codec.message_classes()
    names = RECORD_SCHEMA.names
    rows = [{f: rng.choice([*NUMBERS, None]) for f in FEATURES} | {"dataType": rng.choice([*TEXTS, None])} for _ in range(400)]
    column = pa.StructArray.from_arrays(
        [pa.array([r[n] for r in rows], pa.string() if n == "dataType" else pa.float64(), from_pandas=False) for n in names], names)
    want = [cls(**{k: v for k, v in r.items() if v is not None}).SerializeToString() for r in rows]
    assert codec.messages_of_records(column).to_pylist() == want
    assert codec.messages_of_records(column.slice(33, 100)).to_pylist() == want[33:133]
    kinds = list(MODEL_TYPES)
    rows = [{"name": rng.choice([*TEXTS, None]), "description": rng.choice(TEXTS), "dataType": rng.choice([*TEXTS, None]),
             "modeltype": rng.choice(kinds), "data": rng.choice([None, b"", b"\x01" * 300]),
             "location": rng.choice([None, "", "/x"])} for _ in range(300)]
    kind_of = {n: pa.binary() if n == "data" else pa.string() for n in DESCRIPTOR_SCHEMA.names}
    column = pa.StructArray.from_arrays([pa.array([r[n] for r in rows], k) for n, k in kind_of.items()], list(kind_of))
    want = []
    for r in rows:
        made = model(name=r["name"] or "", description=r["description"], dataType=r["dataType"] or "", modeltype=MODEL_TYPES[r["modeltype"]])
        if r["data"] is not None:
            made.data = r["data"]
        elif r["location"] is not None:
            made.location = r["location"]
        want.append(made.SerializeToString())
    assert codec.messages_of_descriptors(column).to_pylist() == want
    with pytest.raises(KeyError):
        codec.messages_of_descriptors(pa.StructArray.from_arrays(
            [pa.array(["?" if n == "modeltype" else None], k) for n, k in kind_of.items()], list(kind_of)))


def test_text_borders():
    """Two runs that are text only together are none alone."""
    data = np.frombuffer("aé".encode() + "é".encode(), np.uint8)
    runs = wire.Runs(data, np.array([0, 2, 3, 5, 0]), np.array([2, 1, 2, 0, 5]))
    assert wire.texts_valid(runs).tolist() == [False, False, True, True, True]
    assert struct.pack("<d", 1.5) == wire.write_messages(1, [(wire.Field(1, 1), np.array([1.5]), np.array([True]))])[0].as_py()[1:]
