import random
import re

import numpy as np
import pytest
import xxhash

from tidescore.llm import simhash as S
from tidescore.llm.links import components


def plain_print(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) for i in range(len(ids))]


def test_texts(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    texts = base + [b.replace("w7", "W8", 1) for b in base] + [b.upper() for b in base[:4]] + base[:3]
    texts += [None, "", " \n\t", "one", "One", "one two", "É è", "é è", "a\x0bb\x0cc d", "x " * 20_000, "a\x85b \u2003c d"]
    rows = [(i if i % 9 else None, t, "clash") for i, t in enumerate(texts)]
    rows += rows[:2]
    frame = spark.createDataFrame(rows, "doc_id long, text string, print string")
    got = S.near_duplicates(frame).collect()
    prints = [plain_print(t, 3) for _, t, _ in rows]
    want = plain_components([r[0] for r in rows], prints, 3)
    expected = sorted((str(r[0]), format(p, "016x"), str(c)) for r, p, c in zip(rows, prints, want))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    kept = S.keep_first(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == {c for c in want if c is not None}
    assert S.near_duplicates(frame.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    a, b, c, d = (" ".join(rng.choices(words, k=80)) for _ in range(4))
    rows = [(3, a), (7, a), (7, b), (None, a), (None, a.upper()), (None, c), (None, c.upper()), (None, c), (9, d), (9, d.upper()),
            (None, None), (None, ""), (None, b)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, (r.text or "").lower()) for r in S.keep_first(frame).collect()]
    assert sorted(got, key=str) == sorted([(3, a), (7, b), (None, c), (9, d), (None, "")], key=str)


@pytest.mark.parametrize("bits", [22, 21])
def test_words_one_bit_apart_share_a_key(bits):
    words = np.random.default_rng(bits).integers(0, 1 << bits, 3000)
    own = S.segment_keys(words, bits)
    for bit in range(bits):
        other = S.segment_keys(words ^ 1 << bit, bits)
        assert ((own[:, :, None] == other[:, None, :]) & (own[:, :, None] >= 0)).any(axis=(1, 2)).all()


def test_the_code_is_perfect():
    _, errors, weights = S.golay_tables()
    assert sorted(np.bincount(weights).tolist()) == sorted([1, 23, 253, 1771]) and len(set(errors.tolist())) == 2048


def test_every_near_pair_shares_a_bucket():
    rng = np.random.default_rng(5)
    for distance in (1, 2, 3):
        a = rng.integers(0, 1 << 63, 2000, dtype=np.int64)
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(64, distance, replace=False):
                b[i] ^= np.int64(np.uint64(1 << int(bit)).view(np.int64))
        keys = [set(zip(*(x.tolist() for x in S.bucket_keys(v)[::-1]))) for v in (a, b)]
        assert {i for i, _ in keys[0] & keys[1]} == set(range(2000))


def test_a_dense_group_over_many_blocks(spark, monkeypatch):
    """A third of all fingerprints in one ball: components as by brute force, links far below all pairs."""
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 62))
    ball = {centre}
    while len(ball) < 700:
        ball.add(centre ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 4), replace=False)))
    prints = sorted(ball) + rng.integers(0, 1 << 62, 700).tolist()
    monkeypatch.setattr(S, "BLOCK", 64)
    monkeypatch.setattr(S, "SHORT_RUN", 8)
    out = []
    keyed = sorted(zip(*(x.tolist() for x in S.bucket_keys(np.array(prints, np.int64)))))
    import pyarrow as pa

    buckets, places = np.array([b for b, _ in keyed]), np.array([prints[p] for _, p in keyed])
    batches = [pa.RecordBatch.from_arrays([pa.array(buckets[i : i + 1000]), pa.array(places[i : i + 1000])], ["bucket", "print"])
               for i in range(0, len(buckets), 1000)]
    for batch in S.links_of_runs(3)(iter(batches)):
        out += batch.to_pylist()
    edges = [(r["a"], r["b"]) for r in out if r["b"] is not None]
    deferred = [(r["bucket"], r["block"], r["a"]) for r in out if r["b"] is None]
    assert deferred and sorted({(b, k) for b, k, _ in deferred})[0][1] == 0
    members = {}
    for b, p in zip(buckets.tolist(), places.tolist()):
        members.setdefault(b, set()).add(p)
    for bucket in {b for b, _, _ in deferred}:
        assert {p for b, _, p in deferred if b == bucket} == members[bucket]
    frame = spark.createDataFrame(deferred, "bucket long, block int, a long")
    more = [(r.a, r.b) for r in S.block_pairs(frame, 3).collect()]
    want = plain_components(prints, prints, 3)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges + more, "a long, b long")).collect()}
    assert [found.get(p, p) for p in prints] == want


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(500)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5), (2000, 1999)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(501)) and all(got[1000 + i] == 1000 for i in range(300)) and got[2000] == 1999
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
