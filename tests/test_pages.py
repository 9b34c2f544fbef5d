"""Entries in pages, all keys of a bucket at once: the answers of one call per key, and few calls to the state."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tests.test_buckets import block
from tests.test_event_time import START, Mark, Rows
from tests.test_streaming import loop, rows
from tidescore.streaming import event_time, keyed


class Pages:
    """Stand-in for the state of a bucket: a map of pages, a waiting list and timers."""

    def __init__(self):
        self.held, self.calls, self.rows, self.timers = {}, 0, Rows(), set()

    def getMapState(self, name, key, value):
        return self

    def getListState(self, name, schema):
        return self.rows

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def entries(self):
        out = [e for v in self.held.values() for e in keyed.from_blocks([v[0]]).to_pylist()]
        assert len({(e["data_type"], e["shard"]) for e in out}) == len(out)
        return {e["data_type"]: e for e in out}


def run(scorer, batches, names, seed=0):
    got = {}
    for batch in batches:
        mixed = random.Random(seed).sample(batch, len(batch))
        chunks = iter([pd.DataFrame({"rows": [block(part, names)]}) for part in (mixed[: len(mixed) // 2], mixed[len(mixed) // 2 :]) if part])
        for out in scorer.handleInputRows((0,), chunks, None):
            for r in keyed.from_blocks(list(out["rows"])).to_pylist():
                if not r["is_model"]:
                    got[r["id"]] = (r["data_type"], r["version"], r["result"])
    return got


@pytest.mark.parametrize("swap", ["immediate", "next_record"])
@pytest.mark.parametrize("seed", range(8))
def test_pages_equal_a_loop(swap, seed):
    names = ["a", None, "b", "", *[f"k{i}" for i in range(random.Random(seed).choice([1, 12]))]]
    messages = rows(seed, 300)
    batches = [messages[:100], messages[100:110], messages[110:210], messages[210:]]
    scorer, pages = keyed.PagedScorer(swap), Pages()
    scorer.init(pages)
    got, held = run(scorer, batches, names, seed), pages.entries()
    for k, name in enumerate(names):
        mine = [[m for m in batch if m["id"] % len(names) == k] for batch in batches]
        want, current, pending, stats = loop(mine, swap)
        assert {i: v[:2] for i, v in got.items() if i % len(names) == k} == {i: (name, v[0]) for i, v in want.items()}
        assert all(got[i][2] == pytest.approx(v[1]) for i, v in want.items())
        entry = held.get(name, {})
        assert entry.get("current_version") == (current["id"] if current else None)
        assert entry.get("pending_version") == (pending["id"] if pending else None)
        if stats and entry:
            found = [entry[f"stats_{n}"] for n in ("usage", "duration", "min_duration", "max_duration")]
            assert found[:2] == list(stats[:2]) and (not found[0] or found[2:] == list(stats[2:]))
            assert (entry["stats_since_first_use"] is None) == (found[0] == 0)


def test_calls_to_the_state_do_not_grow_with_the_keys():
    names = [f"user-{i}" for i in range(500)]
    scorer, pages = keyed.PagedScorer(), Pages()
    scorer.init(pages)
    run(scorer, [rows(1, 3000)], names)
    assert len(pages.entries()) > 300 and pages.calls <= 2 * keyed.PAGES


def test_touched_keys_and_kept_inputs():
    names = [f"n{i}" for i in range(40)]
    scorer, pages = keyed.PagedScorer(emit_models=True), Pages()
    scorer.init(pages)
    model = lambda i, weights: {"is_model": True, "ts": 1, "id": i, "weights": weights, "features": None, "duration": None}
    run(scorer, [[model(i, None if i == 3 else [1.0, 2.0]) for i in range(40)]], names)
    record = {"is_model": False, "ts": 2, "id": 43, "weights": None, "features": [7.0], "duration": 1}
    nan = dict(record, id=44, features=[float("nan")])
    table = pa.concat_tables(
        keyed.from_blocks(list(out["rows"])) for out in scorer.score(keyed.from_blocks([block([record, nan], names)])))
    done = {r["id"]: r for r in table.to_pylist()}
    assert (done[43]["version"], done[43]["result"], done[43]["features"]) == (3, None, [7.0])
    assert (done[44]["version"], done[44]["result"], done[44]["features"]) == (4, None, None)
    entries, written = pages.entries(), {keyed.page_of(n, 0) for n in ("n3", "n4")}
    assert all(e["touched"] == (n in ("n3", "n4")) for n, e in entries.items() if keyed.page_of(n, 0) in written)
    assert len(entries) == 40


def test_first_entries_come_in_parts():
    scorer, pages = keyed.PagedScorer(), Pages()
    scorer.init(pages)
    for name in ("a", "b"):
        scorer.handleInitialState((0,), pd.DataFrame({
            "bucket": [0], "data_type": [name], "shard": [0], "version": [-1], "valid_from": [START], "weights": [np.array([0.0, 1.0])]}), None)
    record = {"is_model": False, "ts": 2, "id": 1, "weights": None, "features": [7.0], "duration": 1}
    assert run(scorer, [[record]], ["a", "b"]) == {1: ("b", -1, 7.0)}
    assert {n: e["stats_usage"] for n, e in pages.entries().items()} == {"a": 0, "b": 1}


@pytest.mark.parametrize("seed", range(4))
def test_event_time_of_many_keys(seed):
    """Rows of 20 keys shuffled over batches, one timer and one waiting list for all of them."""
    rng = random.Random(seed)
    messages = [(rng.random() < 0.4, rng.randrange(300), i, f"k{rng.randrange(20)}") for i in range(400)]
    want = {}
    for m, s, i, k in messages:
        if not m:
            models = [(t, j) for q, t, j, n in messages if q and t <= s and n == k]
            want[i] = max(models)[1] if models else None
    scorer, state = event_time.BucketEventTimeScorer(), Pages()
    scorer.init(state)
    arrival, got = sorted(messages, key=lambda r: r[1] + rng.randrange(60)), {}
    base = int(pd.Timestamp(START).value // 1_000_000)
    for low in range(0, 400, 50):
        part = arrival[low : low + 50]
        rows_in = pd.DataFrame({
            "data_type": [r[3] for r in part], "shard": np.zeros(len(part), np.int32), "is_model": [r[0] for r in part],
            "ts": [START + pd.Timedelta(seconds=r[1]) for r in part], "id": [r[2] for r in part],
            "weights": [np.array([0.0, 1.0]) if r[0] else None for r in part],
            "features": [None if r[0] else np.array([1.0]) for r in part],
            "duration": pd.Series([None if r[0] else 1.0 for r in part], dtype=float), "bucket": 0})
        before = state.calls
        assert list(scorer.handleInputRows((0,), iter([rows_in[:20], rows_in[20:]]), None)) == []
        mark = base + 1000 * (max(r[1] for r in arrival[: low + 50]) - 60) if low + 50 < 400 else base + 10**6
        for at in [t for t in state.listTimers() if t <= mark]:
            state.deleteTimer(at)
            for out in scorer.handleExpiredTimer((0,), Mark(mark), None):
                got |= {r["id"]: r["version"] for r in keyed.from_blocks(list(out["rows"])).to_pylist()}
        assert state.calls - before <= 2 * keyed.PAGES and len(state.timers) <= 1
    assert got == want and state.rows.held == [] and not state.timers
