"""A kind added from outside: read, checked, served and scored like those of the package."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import nearest_label
from tests.test_models import START, constant, records_of, versions_of
from tidescore.functions import codec
from tidescore.operators import dispatch, kinds, scoring
from tidescore.schemas import DESCRIPTOR_SCHEMA, FEATURES, RECORD_SCHEMA
from tidescore.session import scratch_path
from tidescore.sources.staged import play, read_staged
from tidescore.streaming import serve

KIND = kinds.Kind("nearest", "TENSORFLOWSAVED", "tests.nearest_label:parse", "tests.nearest_label:batch",
                  "tests.nearest_label:check", "tests.nearest_label:column")


@pytest.fixture
def nearest():
    kinds.register(KIND)
    yield KIND
    kinds.forget(KIND.name)


def document(*centres):
    return json.dumps({"centres": [[label, *[at] * len(FEATURES)] for label, at in centres]}).encode()


def served(spark, models):
    sent = spark.createDataFrame([(f"m{i}", "", "a", t, bytearray(d), None) for i, (t, d) in enumerate(models)], DESCRIPTOR_SCHEMA)
    at = F.substring("name", F.lit(2), F.lit(9)).cast("int")
    first = sent.select(
        F.lit("models").alias("topic"), codec.encode_descriptor(F.struct(*DESCRIPTOR_SCHEMA.names)).alias("value"),
        (F.lit(START) + F.make_interval(mins=at)).alias("timestamp"), F.lit(0).alias("partition"), at.cast("long").alias("offset"))
    lines = spark.range(40).select("id", F.lit("a").alias("dataType"), *[(F.col("id") % 10).cast("double").alias(c) for c in FEATURES])
    second = lines.select(
        F.lit("mdata").alias("topic"), codec.encode_record(F.struct(*RECORD_SCHEMA.names)).alias("value"),
        (F.lit(START) + F.make_interval(mins=F.lit(30) + F.col("id").cast("int"))).alias("timestamp"), F.lit(0).alias("partition"),
        (F.col("id") + 100).alias("offset"))
    source, target, checkpoint = (scratch_path(spark, f"kinds-{n}") for n in ("stage", "workspace", "checkpoint"))
    play(first.unionByName(second).select(*serve.MESSAGE_SCHEMA.names), source, ts="timestamp")
    writer = serve.serve(read_staged(spark, source, serve.MESSAGE_SCHEMA), target)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return target


def test_served_beside_the_others(spark, nearest):
    good, bad = document((3, 0.0), (7, 9.0)), [b"no json", b'{"centres": [[1, 2.0], [2, 3.0, 4.0]]}', b'{"centres": [["x", 1.0]]}', b"{}"]
    target = served(spark, [("TENSORFLOWSAVED", d) for d in (good, *bad)])
    got = {r.offset - 100: r.result for r in serve.read(spark, target, "scored").collect()}
    assert got == {i: 3.0 if i % 10 < 4.5 else 7.0 for i in range(40)}
    errors = [r.error for r in serve.read(spark, target, "dead").collect()]
    assert len(errors) == 4 and all(e.startswith("Bad model: ") for e in errors) and "Bad model: centres of other sizes" in errors


def test_refused_where_it_is_not_known(spark):
    target = served(spark, [("TENSORFLOWSAVED", document((3, 0.0)))])
    assert [r.error for r in serve.read(spark, target, "dead").collect()] == ["Bad model type"]
    assert serve.read(spark, target, "scored").count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_all_forms_agree(spark, monkeypatch, nearest, shuffled):
    if shuffled:
        monkeypatch.setattr(dispatch, "fits_broadcast", lambda df: False)
    params, error = kinds.read_model(document((1, -1.0), (2, 5.0), (4, 5.0)), KIND)
    assert error is None
    records = records_of(spark, [("a", 1, i, float(i)) for i in range(8)] + [("b", 1, 9, 1.0)])
    many = dispatch.score_with_versions(records, versions_of(spark, [("a", 1, 0, params), ("b", 1, 0, constant(6.0))]))
    want = {i: 1.0 if i <= 2 else 2.0 for i in range(8)}  # of equal distances the first centre
    assert {r.id: r.result for r in many.collect()} == want | {9: 6.0}
    one = scoring.score(records.where("data_type = 'a'"), params)
    assert {r.id: r.result for r in one.collect()} == want
    assert nearest_label.batch(params)(np.full((1, len(FEATURES)), 4.0)).tolist() == [2.0]


@pytest.mark.parametrize("change", [
    {"name": "linear"}, {"modeltype": "PMML"}, {"modeltype": "OTHER"}, {"batch": "tests.nearest_label:missing"}, {"parser": "json"}])
def test_wrong_kinds_are_refused(change):
    with pytest.raises(ValueError):
        kinds.register(kinds.Kind(**{**KIND.__dict__, **change}))
    assert KIND.name not in kinds.registered()
