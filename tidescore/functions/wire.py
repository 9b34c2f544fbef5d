"""Protobuf's wire format on whole Arrow columns: all messages of a batch are read and written side by side.

Reading steps through the fields: each round takes the next field of every message that has one. A message
with anything but the expected fields in their plain form (an unknown field, a wrong wire type, a length or
number of more than five bytes, a cut end, bytes that are no text) is left to the caller as odd.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Wire types.
VARINT, FIXED64, BYTES = 0, 1, 2
LONGEST_VARINT = 5


@dataclass
class Field:
    """A field of a message: its number and wire type; members of one `group` exclude each other."""

    number: int
    wire: int
    group: str | None = None

    @property
    def tag(self) -> int:
        return self.number << 3 | self.wire


@dataclass
class Runs:
    """Byte strings as places in a buffer."""

    buffer: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """(all bytes behind each other, ends with a leading 0)."""
        ends = np.r_[0, np.cumsum(self.size)]
        moved = np.repeat(self.start - ends[:-1], self.size)
        moved += np.arange(len(moved))
        return self.buffer[moved], ends

    def array(self, kind: pa.DataType, mask: np.ndarray | None = None) -> pa.Array:
        flat, ends = self.packed()
        plain = pa.Array.from_buffers(
            pa.large_binary(), len(self.size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)])
        if mask is not None:
            plain = pc.if_else(pa.array(mask), pa.scalar(None, pa.large_binary()), plain)
        return plain.cast(kind)


def runs_of(column: pa.Array) -> Runs:
    """A binary or string column; null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buffer = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    if column.null_count:
        size = np.where(column.is_valid().to_numpy(zero_copy_only=False), size, 0)
    return Runs(buffer, offsets[:-1].copy(), size)


def read_varints(buffer: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, places behind them, whether they end within five bytes and the message)."""
    value, good = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    behind, left = at.copy(), np.arange(len(at))
    for k in range(LONGEST_VARINT):
        left = left[behind[left] < end[left]]
        byte = buffer[behind[left]].astype(np.int64)
        value[left] |= (byte & 127) << 7 * k
        behind[left] += 1
        good[left[byte < 128]] = True
        left = left[byte >= 128]
        if not len(left):
            break
    return value, behind, good


def texts_valid(runs: Runs) -> np.ndarray:
    """Whether each run is UTF-8."""
    flat, ends = runs.packed()
    try:
        flat.tobytes().decode()
    except UnicodeDecodeError:
        whole = flat.tobytes()
        return np.array([_is_text(whole[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())], bool)
    # The whole is text; a run that begins inside a letter is none, and neither is the run before it.
    inside = np.zeros(len(flat) + 1, bool)
    inside[:-1] = (flat & 0xC0) == 0x80
    return ~(inside[ends[:-1]] & (runs.size > 0)) & ~inside[ends[1:]]


def _is_text(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


def read_messages(messages: Runs, fields: Sequence[Field]) -> tuple[list, dict[str, np.ndarray], np.ndarray]:
    """(values per field: doubles, integers or runs; per group the number of the field set last; odd messages)."""
    buffer, n = messages.buffer, len(messages.size)
    by_tag = {f.tag: i for i, f in enumerate(fields)}
    column_of = np.full(256, -1)
    for tag, i in by_tag.items():
        column_of[tag] = i
    at, end = messages.start.copy(), messages.start + messages.size
    values = [np.zeros(n) if f.wire == FIXED64 else np.zeros(n, np.int64) for f in fields]
    starts = {i: np.zeros(n, np.int64) for i, f in enumerate(fields) if f.wire == BYTES}
    chosen = {f.group: np.zeros(n, np.int64) for f in fields if f.group}
    odd, live = np.zeros(n, bool), np.flatnonzero(messages.size > 0)
    while len(live):
        column = column_of[buffer[at[live]]]
        odd[live[column < 0]] = True
        for i in np.unique(column[column >= 0]).tolist():
            f, rows = fields[i], live[column == i]
            place = at[rows] + 1
            if f.wire == FIXED64:
                good = place + 8 <= end[rows]
                rows, place = _kept(rows, place, good, odd)
                values[i][rows] = buffer[place[:, None] + np.arange(8)].view("<f8")[:, 0]
                at[rows] = place + 8
            else:
                number, behind, good = read_varints(buffer, place, end[rows])
                if f.wire == BYTES:
                    good &= number <= end[rows] - behind
                kept = np.flatnonzero(good)
                odd[rows[~good]] = True
                rows = rows[kept]
                values[i][rows] = number[kept]
                if f.wire == BYTES:
                    starts[i][rows] = behind[kept]
                at[rows] = behind[kept] + (number[kept] if f.wire == BYTES else 0)
            if f.group:
                chosen[f.group][rows] = f.number
        live = live[~odd[live]]
        live = live[at[live] < end[live]]
    return [Runs(buffer, starts[i], np.where(odd, 0, v)) if i in starts else v for i, v in enumerate(values)], chosen, odd


def _kept(rows: np.ndarray, place: np.ndarray, good: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    odd[rows[~good]] = True
    return rows[good], place[good]


def varint_sizes(values: np.ndarray) -> np.ndarray:
    sizes, rest = np.ones(len(values), np.int64), values >> 7
    while rest.any():
        sizes += rest > 0
        rest = rest >> 7
    return sizes


def write_messages(count: int, columns: Sequence[tuple[Field, np.ndarray | Runs, np.ndarray]]) -> pa.Array:
    """Messages from (field, values, which messages have it), the fields in the order of their numbers."""
    sizes = np.zeros(count, np.int64)
    for f, values, has in columns:
        if f.wire == FIXED64:
            sizes += has * 9
        elif f.wire == VARINT:
            sizes += has * (1 + varint_sizes(values))
        else:
            sizes += has * (1 + varint_sizes(values.size) + values.size)
    ends = np.r_[0, np.cumsum(sizes)]
    out, at = np.zeros(ends[-1], np.uint8), ends[:-1].copy()
    for f, values, has in columns:
        rows = np.flatnonzero(has)
        out[at[rows]] = f.tag
        at[rows] += 1
        if f.wire == FIXED64:
            out[at[rows][:, None] + np.arange(8)] = np.ascontiguousarray(values[rows], "<f8").view(np.uint8).reshape(-1, 8)
            at[rows] += 8
            continue
        numbers, left = (values.size if f.wire == BYTES else values)[rows], rows
        while len(left):
            more = numbers > 127
            out[at[left]] = (numbers & 127) | more * 128
            at[left] += 1
            left, numbers = left[more], numbers[more] >> 7
        if f.wire == BYTES:
            flat, cuts = Runs(values.buffer, values.start[rows], values.size[rows]).packed()
            moved = np.repeat(at[rows] - cuts[:-1], values.size[rows])
            moved += np.arange(len(moved))
            out[moved] = flat
            at[rows] += values.size[rows]
    return Runs(out, ends[:-1], sizes).array(pa.binary())
