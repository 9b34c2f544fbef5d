"""Protobuf messages to columns and back.

All messages of an Arrow batch are read and written side by side (`wire`). Only messages of an unusual form
go through the message classes, which also say what is wrong with those that cannot be read. Where the
cluster has Spark's own protobuf functions on its class path, their columns can take the place of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.functions.wire import (
    BYTES,
    FIXED64,
    VARINT,
    Field,
    read_messages,
    runs_of,
    texts_valid,
    write_messages,
)
from tidescore.schemas import DESCRIPTOR_SCHEMA, FEATURES, MODEL_TYPES, RECORD_SCHEMA

# Fixed value: the reason given for a model without inline content.
LOCATION_UNSUPPORTED = "Location based is not yet supported"

# Message fields beside the reason for refusal; all fields are null when there is one.
_ERROR = T.StructField("error", T.StringType())
RECORD_RESULT = T.StructType([*RECORD_SCHEMA.fields, _ERROR])
DESCRIPTOR_RESULT = T.StructType([*DESCRIPTOR_SCHEMA.fields, _ERROR])

RECORD_FIELDS = [*[Field(n, FIXED64) for n in range(1, len(FEATURES) + 1)], Field(len(FEATURES) + 1, BYTES)]
DESCRIPTOR_FIELDS = [Field(1, BYTES), Field(2, BYTES), Field(3, BYTES), Field(4, VARINT), Field(5, BYTES, "content"),
                     Field(6, BYTES, "content")]
DATA_NUMBER, LOCATION_NUMBER = 5, 6


@lru_cache(maxsize=1)
def message_classes():
    """Record and descriptor message classes, built from their field lists; once per task."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as exc:
        raise RuntimeError("the protobuf codec needs the google.protobuf package on the workers") from exc

    kind = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="tidescore.proto", package="tidescore", syntax="proto3")

    record = file.message_type.add(name="Record")
    for tag, name in enumerate(FEATURES, start=1):
        record.field.add(name=name, number=tag, type=kind.TYPE_DOUBLE, label=kind.LABEL_OPTIONAL)
    record.field.add(name="dataType", number=12, type=kind.TYPE_STRING, label=kind.LABEL_OPTIONAL)

    model = file.message_type.add(name="ModelDescriptor")
    types = model.enum_type.add(name="ModelType")
    for name, number in MODEL_TYPES.items():
        types.value.add(name=name, number=number)
    for tag, name in enumerate(["name", "description", "dataType"], start=1):
        model.field.add(name=name, number=tag, type=kind.TYPE_STRING, label=kind.LABEL_OPTIONAL)
    model.field.add(name="modeltype", number=4, type=kind.TYPE_ENUM, label=kind.LABEL_OPTIONAL,
                    type_name=".tidescore.ModelDescriptor.ModelType")
    model.oneof_decl.add(name="content")
    model.field.add(name="data", number=5, type=kind.TYPE_BYTES, label=kind.LABEL_OPTIONAL, oneof_index=0)
    model.field.add(name="location", number=6, type=kind.TYPE_STRING, label=kind.LABEL_OPTIONAL, oneof_index=0)

    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    get = message_factory.GetMessageClass
    return (
        get(pool.FindMessageTypeByName("tidescore.Record")),
        get(pool.FindMessageTypeByName("tidescore.ModelDescriptor")),
    )


def _parse(cls, payload):
    if payload is None:
        return None, "null message"
    try:
        return cls.FromString(bytes(payload)), None
    except Exception as exc:  # the library raises its own DecodeError type
        return None, f"undecodable message: {type(exc).__name__}"


def _with_odd(plain: pa.StructArray, odd: np.ndarray, row) -> pa.StructArray:
    """The rows read side by side, with those that were not put in by `row` (position -> values)."""
    at = np.flatnonzero(odd)
    if not len(at):
        return plain
    kinds = [plain.type.field(i).type for i in range(plain.type.num_fields)]
    columns = list(zip(*[row(int(i)) for i in at]))
    single = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.name for f in plain.type])
    place = np.arange(len(plain))
    place[at] = len(plain) + np.arange(len(at))
    return pa.concat_arrays([plain, single]).take(pa.array(place))


def records_from(messages: pa.Array) -> pa.StructArray:
    """A column of messages to one of RECORD_RESULT."""
    runs = runs_of(messages)
    (*features, kind), _, odd = read_messages(runs, RECORD_FIELDS)
    odd |= ~texts_valid(kind) | messages.is_null().to_numpy(zero_copy_only=False)
    kind.size = np.where(odd, 0, kind.size)
    columns = [pa.array(x, pa.float64(), from_pandas=False) for x in features]  # a NaN stays a value
    plain = pa.StructArray.from_arrays(
        [*columns, kind.array(pa.string()), pa.nulls(len(messages), pa.string())], RECORD_RESULT.names)
    read, gap = attrgetter(*RECORD_SCHEMA.names), (None,) * len(RECORD_SCHEMA.names)

    def row(i: int) -> tuple:
        found, error = _parse(message_classes()[0], messages[i].as_py())
        return (*(gap if found is None else read(found)), error)

    return _with_odd(plain, odd, row)


def decode_record(value: Column) -> Column:
    """bytes -> struct of RECORD_RESULT. An empty message is a valid record of zeros."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield records_from(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Marked nondeterministic so that a filter on the outcome does not decode a second time.
    return F.arrow_udf(run, RECORD_RESULT).asNondeterministic()(value)


def descriptors_from(messages: pa.Array) -> pa.StructArray:
    """A column of messages to one of DESCRIPTOR_RESULT."""
    names = {number: name for name, number in MODEL_TYPES.items()}
    runs = runs_of(messages)
    (name, description, data_type, kind, data, location), chosen, odd = read_messages(runs, DESCRIPTOR_FIELDS)
    for text in (name, description, data_type, location):
        odd |= ~texts_valid(text)
    odd |= messages.is_null().to_numpy(zero_copy_only=False) | (kind > 0x7FFFFFFF)
    for found in (name, description, data_type, data, location):
        found.size = np.where(odd, 0, found.size)
    has_data, has_location = chosen["content"] == DATA_NUMBER, chosen["content"] == LOCATION_NUMBER
    codes, inverse = np.unique(kind, return_inverse=True)
    labels = pa.array([names.get(int(c), str(int(c))) for c in codes], pa.string())
    plain = pa.StructArray.from_arrays(
        [name.array(pa.string()), description.array(pa.string()), data_type.array(pa.string()), labels.take(pa.array(inverse)),
         data.array(pa.binary(), ~has_data), location.array(pa.string(), ~has_location),
         pa.array(np.where(has_data, None, LOCATION_UNSUPPORTED), pa.string())], DESCRIPTOR_RESULT.names)

    def row(i: int) -> tuple:
        found, error = _parse(message_classes()[1], messages[i].as_py())
        if found is None:
            return (None,) * len(DESCRIPTOR_SCHEMA.names) + (error,)
        content = found.WhichOneof("content")
        return (
            found.name, found.description, found.dataType, names.get(found.modeltype, str(found.modeltype)),
            found.data if content == "data" else None, found.location if content == "location" else None,
            None if content == "data" else LOCATION_UNSUPPORTED,
        )

    return _with_odd(plain, odd, row)


def decode_descriptor(value: Column) -> Column:
    """bytes -> struct of DESCRIPTOR_RESULT. Location-based and empty-content models carry an error."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield descriptors_from(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, DESCRIPTOR_RESULT).asNondeterministic()(value)


def messages_of_records(rows: pa.StructArray) -> pa.Array:
    """A column of RECORD_SCHEMA to messages; null values are the defaults, which are not written."""
    columns = []
    for f, name in zip(RECORD_FIELDS, FEATURES):
        values = np.ascontiguousarray(rows.field(name).fill_null(0.0).to_numpy(zero_copy_only=False), np.float64)
        columns.append((f, values, values.view(np.uint64) != 0))  # minus zero is written
    kind = runs_of(rows.field("dataType"))
    return write_messages(len(rows), [*columns, (RECORD_FIELDS[-1], kind, kind.size > 0)])


def encode_record(rec: Column) -> Column:
    """struct of RECORD_SCHEMA -> bytes."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield messages_of_records(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.BinaryType())(rec)


def messages_of_descriptors(rows: pa.StructArray) -> pa.Array:
    """A column of DESCRIPTOR_SCHEMA to messages; content wins over a location."""
    columns = []
    for f, name in zip(DESCRIPTOR_FIELDS[:3], ("name", "description", "dataType")):
        text = runs_of(rows.field(name))
        columns.append((f, text, text.size > 0))
    coded = rows.field("modeltype").dictionary_encode()
    numbers = np.array([MODEL_TYPES[k] for k in coded.dictionary.to_pylist()], np.int64)
    if coded.indices.null_count:
        raise KeyError("a model without a type")
    kind = numbers[coded.indices.to_numpy(zero_copy_only=False)] if len(rows) else np.zeros(0, np.int64)
    has_data = rows.field("data").is_valid().to_numpy(zero_copy_only=False)
    has_location = rows.field("location").is_valid().to_numpy(zero_copy_only=False) & ~has_data
    return write_messages(len(rows), [
        *columns, (DESCRIPTOR_FIELDS[3], kind, kind > 0), (DESCRIPTOR_FIELDS[4], runs_of(rows.field("data")), has_data),
        (DESCRIPTOR_FIELDS[5], runs_of(rows.field("location")), has_location)])


def encode_descriptor(rec: Column) -> Column:
    """struct of DESCRIPTOR_SCHEMA -> bytes."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield messages_of_descriptors(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.BinaryType())(rec)
