"""Scoring by shuffle: records move once, with each input once; nulls, NaN and other number types read as in the other form."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.test_models import constant, stump, versions_of
from tidescore.operators import dispatch
from tidescore.schemas import FEATURES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, n=600):
    values = {c: F.rand(i) * 20 for i, c in enumerate(FEATURES[:-3])}
    values[FEATURES[-3]] = F.when(F.col("id") % 5 != 0, F.lit(2.0))
    values[FEATURES[-2]] = F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.lit(1.5))
    values[FEATURES[-1]] = (F.col("id") % 9).cast("int")
    version = F.when(F.col("id") % 4 > 0, F.col("id") % 4)
    return spark.range(n).select("id", version.cast("long").alias("version"), *[v.alias(c) for c, v in values.items()])


def models_of(spark):
    sums = {**constant(1.0), "coefs": [0.5] * len(FEATURES)}
    return versions_of(spark, [("a", 1, 0, sums), ("a", 2, 1, stump(3.0)), ("a", 3, 2, {**sums, "kind": "glm", "link": "inverse"})])


def test_both_forms_agree_on_odd_numbers(spark, monkeypatch):
    monkeypatch.setattr(dispatch, "ROWS_PER_GROUP", 50)  # several buckets, some of them salted
    rows, models = rows_of(spark), models_of(spark).select("version", "params")
    want = {r.id: r.result for r in dispatch.score_resolved(rows, models).collect()}
    done = dispatch.score_cogrouped(rows, models)
    got = {r.id: r.result for r in done.collect()}
    assert done.columns == [*rows.columns, "result"] and set(got) == set(want) and len(got) == 600
    for i, value in want.items():
        if value is None or math.isnan(value):
            assert (got[i] is None) == (value is None) and (value is None or math.isnan(got[i]))
        else:
            assert got[i] == pytest.approx(value)
    assert any(v is not None and math.isnan(v) for v in want.values()) and None in want.values()
    kept = {r.id: r for r in rows.collect()}
    for r in done.collect():
        assert r.version == kept[r.id].version and r[FEATURES[-1]] == kept[r.id][FEATURES[-1]] and r[FEATURES[-3]] == kept[r.id][FEATURES[-3]]


def test_records_are_shuffled_once_with_each_input_once(spark):
    done = dispatch.score_cogrouped(rows_of(spark), models_of(spark).select("version", "params"))
    text = plan(done)
    assert "SortMergeJoin" not in text and "CoGroup" in text
    # Of eleven inputs ten are doubles that the rows have already.
    assert "_x10" in text and "_x0#" not in text and "_x9#" not in text


def test_inputs_that_are_missing_read_as_zero(spark):
    rows = rows_of(spark, 40).drop(FEATURES[0])
    models = models_of(spark).select("version", "params")
    want = {r.id: r.result for r in dispatch.score_resolved(rows, models).where("NOT isnan(result)").collect()}
    got = {r.id: r.result for r in dispatch.score_cogrouped(rows, models).where("NOT isnan(result)").collect()}
    assert want and got == pytest.approx(want)


def test_no_rows_with_a_model(spark):
    rows = rows_of(spark, 40).withColumn("version", F.lit(None).cast("long"))
    done = dispatch.score_cogrouped(rows, models_of(spark).select("version", "params"))
    assert done.count() == 40 and done.where("result IS NOT NULL").count() == 0
