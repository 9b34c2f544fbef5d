"""Keys in buckets: one call for many keys, the same answers as one call per key."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tests.test_streaming import frame, loop, rows
from tidescore.streaming import keyed


class Entries:
    def __init__(self):
        self.held, self.reads = {}, 0

    def getMapState(self, name, key, value):
        return self

    def getValue(self, key):
        self.reads += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value


def block(batch, names):
    df = frame(batch)
    table = pa.table({
        "data_type": pa.array([names[r["id"] % len(names)] for r in batch], pa.string()), "shard": pa.array([0] * len(df), pa.int32()),
        "is_model": df["is_model"], "ts": df["ts"].to_numpy("datetime64[us]").astype(np.int64), "id": df["id"],
        "weights": pa.array(df["weights"], pa.list_(pa.float64())), "features": pa.array(df["features"], pa.list_(pa.float64())),
        "duration": pa.array([r["duration"] for r in batch], pa.int64())})
    return keyed.to_block(table.select(keyed.BLOCK.names).cast(keyed.BLOCK))


@pytest.mark.parametrize("swap", ["immediate", "next_record"])
@pytest.mark.parametrize("seed", range(4))
def test_many_keys_in_one_call(swap, seed):
    names = ["a", None, "b", "", "c"]
    messages = rows(seed, 300)
    batches = [messages[:100], messages[100:210], messages[210:]]
    scorer, entries = keyed.BucketScorer(swap), Entries()
    scorer.init(entries)
    got = {}
    for batch in batches:
        before, mixed = entries.reads, random.Random(seed).sample(batch, len(batch))
        chunks = iter([pd.DataFrame({"rows": [block(mixed[:40], names)]}), pd.DataFrame({"rows": [block(mixed[40:], names)]})])
        frames = list(scorer.handleInputRows((0,), chunks, None))
        assert len(frames) == 1 and entries.reads - before == len(names)
        for r in keyed.from_blocks(list(frames[0]["rows"])).to_pylist():
            assert r["data_type"] == names[r["id"] % len(names)]
            got[r["id"]] = (r["version"], r["result"])
    for k, name in enumerate(names):
        mine = [[m for m in batch if m["id"] % len(names) == k] for batch in batches]
        want, current, pending, stats = loop(mine, swap)
        assert {i: v[0] for i, v in got.items() if i % len(names) == k} == {i: v[0] for i, v in want.items()}
        assert all(got[i][1] == pytest.approx(v[1]) for i, v in want.items())
        held = entries.held[(name, 0)]
        assert (held[0] or (None,))[0] == (current["id"] if current else None)
        assert (held[1] or (None,))[0] == (pending["id"] if pending else None)
        assert not stats or held[2][3:5] == stats[:2]


def test_models_replaced_at_their_instant_do_not_travel():
    fields = {"data_type": pa.string(), "shard": pa.int32(), "is_model": pa.bool_(), "ts": pa.int64(), "id": pa.int64(),
              "weights": pa.list_(pa.float64()), "features": pa.list_(pa.float64()), "duration": pa.int64(), "buckets": pa.list_(pa.int32())}
    made = [("a", 0, True, 5, 1, [1.0], None, None, [3, 4]), ("a", 0, True, 5, 2, [2.0], None, None, [3, 4]),
            ("b", 0, True, 5, 1, [1.0], None, None, [4, 7]), ("a", 1, False, 6, 9, None, [1.0], 2, [4])]
    batch = pa.RecordBatch.from_pylist([dict(zip(fields, m)) for m in made], pa.schema(fields.items()))
    for keep, count in ((False, 5), (True, 7)):
        out = list(keyed.packer(keep)(iter([batch])))[0].to_pylist()
        found = [(r["bucket"], x["data_type"], x["shard"], x["id"]) for r in out for x in keyed.from_blocks([r["rows"]]).to_pylist()]
        assert len(found) == count and {(3, "a", 0, 2), (4, "a", 1, 2), (4, "a", 1, 9), (4, "b", 0, 1), (7, "b", 1, 1)} <= set(found)
