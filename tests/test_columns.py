"""Column functions and the two or three forms of each scorer against each other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidescore.functions import codec, features, maths, text, vectors
from tidescore.operators import batch_scoring, clean, leaf_join, scoring
from tidescore.plans import models
from tidescore.schemas import DESCRIPTOR_SCHEMA, FEATURES, PARAMS_TYPE, RECORD_SCHEMA


def scan_best(values):
    best = 0
    for i, v in enumerate(values):
        if v > values[best]:
            best = i
    return float(best)


@pytest.mark.parametrize(
    "values",
    [[1.0, 3.0, 2.0], [2.0, 2.0, 1.0], [math.nan, 5.0], [1.0, math.nan, 0.5], [-1.0, -1.0], [7.0]],
)
def test_argmax_matches_a_scan(spark, values):
    df = spark.createDataFrame([(values,)], "a array<double>")
    assert df.select(vectors.argmax_index(F.col("a"))).first()[0] == scan_best(values)


def test_probabilities_and_means(spark):
    df = spark.createDataFrame([([1.0, 3.0], [5.0, 5.0])], "a array<double>, b array<double>")
    out = df.select(
        vectors.class_probabilities(F.col("a")).alias("p"), vectors.mean_arrays([F.col("a"), F.col("b")]).alias("m"),
        maths.softmax(F.col("b")).alias("s"),
    ).first()
    assert out.p == [0.25, 0.75] and out.m == [3.0, 4.0] and out.s == [0.5, 0.5]


def test_cast_raises_and_lenient_gives_null(spark):
    df = spark.createDataFrame([("1.5", "5"), ("x", "5")], "a string, quality string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        features.cast_columns(df, ["a"]).collect()
    assert [r.a for r in features.cast_columns(df, ["a"], lenient=True).collect()] == [1.5, None]
    bad = spark.createDataFrame([("5.0",)], "quality string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        features.cast_label(bad, "quality", "int").collect()


def test_binding(spark):
    df = spark.createDataFrame([(3.0, None)], "pH double, alcohol double")
    zero = df.select(*[c.alias(f"c{i}") for i, c in enumerate(features.bind_fields(["pH", "alcohol", "?"], df.columns))])
    assert list(zero.first()) == [3.0, 0.0, 0.0]
    null = df.select(*features.bind_fields(["alcohol"], df.columns, missing="null"))
    assert null.first()[0] is None
    with pytest.raises(KeyError):
        features.bind_fields(["?"], df.columns, strict=True)


def test_names(spark):
    df = spark.createDataFrame([("data/a.pmml", "data/b.pb", "x:0")], "p string, t string, n string")
    out = df.select(
        text.pmml_model_name(F.col("p")), text.tensor_model_name(F.col("t")), text.before_colon(F.col("n")),
        text.format_millis(F.lit(0).cast("long")),
    ).first()
    assert list(out) == ["a", "data/b", "x", "1970/01/01 00:00:00"]


def test_empty_and_bad_messages(spark):
    df = spark.createDataFrame([(1, bytearray(b"")), (2, bytearray(b"\x09\x01")), (3, None)], "i int, value binary")
    out = {r.i: r for r in clean.parse_records(df).collect()}
    assert out[1].error is None and out[1].dataType == "" and out[1].alcohol == 0.0
    assert out[2].error.startswith("undecodable") and out[2].alcohol is None
    assert out[3].error == "null message"
    models_out = {r.i: r for r in clean.parse_descriptors(df).collect()}
    assert models_out[1].error == codec.LOCATION_UNSUPPORTED and models_out[1].modeltype == "TENSORFLOW"


def test_descriptor_content_is_one_of(spark):
    rows = [("a", "d", "wine", "PMML", bytearray(b"\xff\x00x"), None), ("b", "d", "wine", "PMML", None, "/x")]
    df = spark.createDataFrame(rows, DESCRIPTOR_SCHEMA)
    raw = df.select(codec.encode_descriptor(F.struct(*df.columns)).alias("value"))
    out = {r.name: r for r in clean.parse_descriptors(raw).collect()}
    assert bytes(out["a"].data) == b"\xff\x00x" and out["a"].error is None
    assert out["b"].location == "/x" and out["b"].error == codec.LOCATION_UNSUPPORTED


def test_good_and_bad_records_round_trip(spark):
    rows = [tuple(float(i) for i in range(11)) + ("wine",)]
    df = spark.createDataFrame(rows, RECORD_SCHEMA)
    raw = df.select(codec.encode_record(F.struct(*df.columns)).alias("value"))
    good, bad = clean.split_valid(clean.parse_records(raw))
    assert [tuple(r) for r in good.drop("value").collect()] == rows and bad.count() == 0


@pytest.fixture(scope="module")
def records(spark):
    rng = np.random.default_rng(3)
    rows = [tuple(float(v) for v in r) for r in rng.uniform(0, 20, (400, len(FEATURES)))]
    # Rows that sit exactly on split values.
    for node in models.tree_nodes(1, 4):
        if node["feature"] >= 0:
            row = [5.0] * len(FEATURES)
            row[node["feature"]] = node["threshold"]
            rows.append(tuple(row))
    schema = "id long, " + ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def results(df):
    return {r.id: r.result for r in df.select("id", "result").collect()}


KINDS = {
    "linear": models.linear(),
    "glm": models.linear("glm", "log", 0.1),
    "tree": models.tree_classifier(),
    "regressor": models.tree_regressor(),
    "forest": models.forest(3, 3),
}


@pytest.mark.parametrize("name", KINDS)
def test_column_form_equals_batch_form(records, name):
    a = results(scoring.score(records, KINDS[name]))
    b = results(batch_scoring.score_batches(records, KINDS[name]))
    assert a.keys() == b.keys()
    np.testing.assert_allclose([a[k] for k in a], [b[k] for k in a], rtol=1e-9)


def test_join_forms_equal_case_form(spark, records):
    params = models.tree_classifier()
    row = spark.createDataFrame([(1, params)], "version long, params " + PARAMS_TYPE.simpleString())
    df = records.withColumn("version", F.lit(1).cast("long"))
    expected = results(scoring.score(records, params))
    assert results(leaf_join.score_tree_by_leaves(df, leaf_join.leaf_table(row))) == expected
    down = leaf_join.descend(df.withColumn("tree", F.lit(0)), row)
    assert results(down.withColumnRenamed("leaf_score", "result")) == expected


def test_forest_join_equals_batches(spark, records):
    params = models.forest(3, 3)
    row = spark.createDataFrame([(1, params)], "version long, params " + PARAMS_TYPE.simpleString())
    df = records.withColumn("version", F.lit(1).cast("long"))
    out = leaf_join.score_forest_by_leaves(df, leaf_join.leaf_table(row), models.LABELS, ["id"])
    assert results(out) == results(batch_scoring.score_batches(records, params))


def test_missing_inputs(spark, records):
    params = models.linear()
    gap = records.limit(1).withColumn("alcohol", F.lit(None).cast("double"))
    assert scoring.score(gap, params, missing="null").first().result is None
    assert scoring.score(gap, params).first().result is not None
    assert scoring.score(gap, models.perceptron(), missing="null").first().result is None


def test_linear_model_prunes_the_scan(spark, records, tmp_path):
    path = str(tmp_path / "records")
    records.write.parquet(path)
    params = models.linear()
    params["coefs"] = [0.0] * len(FEATURES)
    params["coefs"][FEATURES.index("alcohol")] = 1.0
    plan = scoring.score(spark.read.parquet(path), params).select("id", "result")
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "alcohol" in text_plan and "sulphates" not in text_plan
