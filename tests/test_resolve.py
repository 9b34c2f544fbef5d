"""As-of resolution and statistics against a plain loop, with ties, hot keys and gaps."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidescore.operators import dispatch, resolve, stats
from tidescore.plans import models as rules
from tidescore.schemas import FEATURES, MODEL_VERSION_SCHEMA

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def scene(seed, n_models, n_records, span, types):
    """Most rows on one type; times repeat; some types never get a model."""
    rng = random.Random(seed)
    pick = lambda: types[0] if rng.random() < 0.6 else rng.choice(types)
    models = [(pick(), i, at(rng.randrange(span))) for i in range(n_models)]
    models = [m for m in models if m[0] != "never"]
    records = [(pick(), at(rng.randrange(span)), i, rng.randrange(50)) for i in range(n_records)]
    return models, records


def expected(models, records):
    out = {}
    for kind, ts, rid, _ in records:
        usable = [(m[2], m[1]) for m in models if m[0] == kind and m[2] <= ts]
        out[rid] = max(usable)[1] if usable else None
    return out


def frames(spark, models, records):
    m = spark.createDataFrame(models, "data_type string, version long, valid_from timestamp")
    r = spark.createDataFrame(records, "data_type string, ts timestamp, id long, duration long")
    return m, r


SCENES = {
    "ties": (1, 60, 300, 20, ["a", "b", "never"]),
    "sparse": (2, 5, 200, 100_000, ["a", "b", "c"]),
    "dense": (3, 400, 300, 5_000, ["a", "never"]),
    "one instant": (4, 30, 100, 1, ["a", "b"]),
    "one model": (5, 1, 50, 100, ["a"]),
}


@pytest.mark.parametrize("name", SCENES)
@pytest.mark.parametrize("form", [resolve.resolve, resolve.resolve_sorted], ids=["lookup", "sorted"])
def test_resolution(spark, name, form):
    models, records = scene(*SCENES[name])
    m, r = frames(spark, models, records)
    want = expected(models, records)
    assert {x.id: x.version for x in form(r, m, "null").collect()} == want
    dropped = {x.id: x.version for x in form(r, m, "drop").collect()}
    assert dropped == {k: v for k, v in want.items() if v is not None}


def test_no_models_at_all(spark):
    m, r = frames(spark, [("x", 1, START)], [("a", START, 1, 1)])
    none = m.where("version < 0")
    for form in (resolve.resolve, resolve.resolve_sorted):
        assert form(r, none).count() == 0
        assert form(r, none, "null").first().version is None


def test_crowded_or_large_models_take_the_sorted_form(spark, monkeypatch):
    models, records = scene(*SCENES["dense"])
    m, r = frames(spark, models, records)
    want = expected(models, records)
    for limit in ("MAX_BROADCAST_MODELS", "MAX_BUCKET_MODELS"):
        with monkeypatch.context() as patch:
            patch.setattr(resolve, limit, 0)
            assert {x.id: x.version for x in resolve.resolve(r, m, "null").collect()} == want
    spark.conf.set("spark.tidescore.broadcastBytes", "10")
    try:
        assert {x.id: x.version for x in resolve.resolve(r, m, "null").collect()} == want
    finally:
        spark.conf.unset("spark.tidescore.broadcastBytes")


def test_lookup_plan_moves_no_record(spark, tmp_path):
    models, records = scene(*SCENES["ties"])
    m, r = frames(spark, models, records)
    r.write.parquet(str(tmp_path / "r"))
    plan = resolve.resolve(spark.read.parquet(str(tmp_path / "r")), m)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_running_stats(spark):
    models, records = scene(*SCENES["ties"])
    m, r = frames(spark, models, records)
    scored = resolve.resolve(r, m)
    got = {x.id: (x.usage, x.duration, x.min_duration, x.max_duration)
           for x in stats.running_stats(scored, ["id"]).collect()}
    by_version = {}
    version = expected(models, records)
    for kind, ts, rid, d in sorted(records, key=lambda x: (x[1], x[2])):
        if version[rid] is None:
            continue
        seen = by_version.setdefault((kind, version[rid]), [])
        seen.append(d)
        assert got.pop(rid) == (len(seen), sum(seen), min(seen), max(seen))
    assert not got


def test_merge_stats_equals_one_pass(spark):
    models, records = scene(*SCENES["dense"])
    m, r = frames(spark, models, records)
    scored = resolve.resolve(r, m)
    halves = [stats.serving_stats(scored.where(F.col("id") % 2 == k)) for k in (0, 1)]
    merged = stats.merge_stats(halves[0].unionByName(halves[1]))
    key = lambda x: (x.data_type, x.version)
    assert sorted(merged.collect(), key=key) == sorted(stats.serving_stats(scored).collect(), key=key)


def test_current_stats_defaults(spark):
    m, r = frames(spark, [("a", 1, START)], [("a", at(1), 1, 5), ("b", at(1), 2, 5)])
    described = m.selectExpr("*", "'n' AS name", "'d' AS description", "'PMML' AS modeltype")
    used = stats.serving_stats(resolve.resolve(r, m))
    out = {x.data_type: x for x in stats.current_stats(r, used, described).collect()}
    assert out["a"].usage == 1 and out["a"].name == "n"
    assert (out["b"].name, out["b"].usage, out["b"].duration, out["b"].since) == ("None", 0, 0.0, 0)


@pytest.fixture(scope="module")
def mixed(spark):
    """Versions of every kind on two types, and records for them."""
    product = rules.linear("glm")
    product["terms"] = [{"beta": 0.01, "exponents": [1.0, 1.0] + [0.0] * (len(FEATURES) - 2)}]
    kinds = [rules.linear(), rules.tree_classifier(), product, rules.forest(3, 3), rules.perceptron(),
             rules.dense(len(FEATURES), 3), rules.linear("glm", "log", 0.05)]
    rows = [("a" if i % 2 else "b", i, f"m{i}", "", "PMML", at(i * 10), bytearray(b""), p) for i, p in enumerate(kinds)]
    rng = random.Random(5)
    data = [("a" if rng.random() < 0.8 else "b", at(rng.randrange(90)), i, *[rng.uniform(0, 12) for _ in FEATURES])
            for i in range(500)]
    schema = "data_type string, ts timestamp, id long, " + ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame(rows, MODEL_VERSION_SCHEMA), spark.createDataFrame(data, schema), kinds, data


def same(df, want):
    got = {r.id: r.result for r in df.select("id", "result").collect()}
    assert {k for k, v in got.items() if v is None} == {k for k, v in want.items() if v is None}
    known = {k: v for k, v in want.items() if v is not None}
    assert {k: got[k] for k in known} == pytest.approx(known, rel=1e-9)


def test_mixed_kinds(spark, mixed, monkeypatch):
    import numpy as np

    from tidescore.operators.batch_scoring import batch_scorer

    versions, records, kinds, data = mixed
    want = {}
    for kind, ts, rid, *x in data:
        usable = [i for i in range(len(kinds)) if ("a" if i % 2 else "b") == kind and at(i * 10) <= ts]
        want[rid] = float(batch_scorer(kinds[usable[-1]])(np.array([x]))[0]) if usable else None
    scored = dispatch.score_with_versions(records, versions, "null")
    same(scored, want)
    monkeypatch.setattr(dispatch, "ROWS_PER_GROUP", 40)
    resolved = scored.drop("result")
    shuffled = dispatch.score_cogrouped(resolved, versions.select("version", "params"))
    same(shuffled, want)


def test_order_columns_are_not_written(spark):
    """What only serves the order stays out of the chunks, and positions keep the order it made."""
    from tidescore.operators.ordering import ordered_chunks

    rows = spark.range(500).select((F.col("id") % 7).alias("ts"), F.xxhash64("id").alias("tie"), "id")
    chunks = ordered_chunks(rows, [F.col("ts"), F.col("tie")], "slim", drop=["tie"])
    assert chunks.columns == ["ts", "id", "_chunk", "_offset"]
    found = [(r.ts, r.id) for r in chunks.orderBy("_chunk", "_offset").collect()]
    assert found == [(r.ts, r.id) for r in rows.orderBy("ts", "tie").collect()]
