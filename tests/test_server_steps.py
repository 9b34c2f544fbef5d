"""What a slice and a model message cost the server: a row is made once, a slice has readers, a sum needs no trial."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidescore.operators import batch_scoring
from tidescore.schemas import FEATURES
from tidescore.sources import staged
from tidescore.sources.pmml import empty_params


def test_rows_are_made_once_and_cut_by_time(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def make(n):
        made.add(1)
        return n

    rows = spark.range(900).select(
        F.udf(make, "long")("id").alias("id"),
        F.when(F.col("id") >= 3, F.timestamp_seconds(F.floor(F.col("id") / 10))).alias("ts"))
    assert staged.play(rows, str(tmp_path), at_least=4) == 4
    assert made.value == 900
    slices = spark.read.parquet(str(tmp_path))
    spans = slices.groupBy("slice").agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("slice").collect()
    assert [s.slice for s in spans] == [0, 1, 2, 3] and all(200 < s.n < 250 for s in spans)
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))  # equal times share a slice
    assert {r.slice for r in slices.where("ts IS NULL").collect()} == {0}
    assert slices.count() == 900 and all(len(glob.glob(f"{tmp_path}/slice={i}/*.parquet")) == 1 for i in range(4))


def test_times_that_cannot_be_cut(spark, tmp_path):
    rows = spark.range(10).select("id", F.lit(None).cast("timestamp").alias("ts"))
    staged.play(rows, str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 10
    staged.play(rows.withColumn("ts", F.timestamp_seconds(F.lit(5))), str(tmp_path / "one"))
    assert spark.read.parquet(str(tmp_path / "one")).count() == 10


def test_a_slice_has_several_row_groups(spark, tmp_path):
    rows = spark.range(300_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"), F.timestamp_seconds("id").alias("ts"))
    staged.play(rows, str(tmp_path), at_least=1)
    (file,) = glob.glob(f"{tmp_path}/slice=0/*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 2


def test_sums_need_no_trial(monkeypatch):
    good = empty_params("linear") | {"intercept": 1.0, "coefs": [1.0] * len(FEATURES), "link": "identity", "terms": []}
    assert batch_scoring.trial(good | {"link": "none such"}) == "Bad model: cannot be scored (KeyError)"
    assert batch_scoring.trial(good | {"terms": [{"beta": 1.0, "exponents": [1.0] * len(FEATURES)}]}) is None
    monkeypatch.setattr(batch_scoring, "batch_scorer", lambda params: 1 / 0)
    assert batch_scoring.trial(good) is None and batch_scoring.trial(good | {"kind": "glm", "link": "log"}) is None
