"""One model, one answer: paired forms agree, bad models are refused, names do not collide."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidescore.functions import codec
from tidescore.operators import batch_scoring, dispatch, resolve, scoring, stats
from tidescore.operators.leaf_join import descend
from tidescore.plans import inputs, models
from tidescore.schemas import FEATURES, MODEL_VERSION_SCHEMA, PARAMS_TYPE, RECORD_SCHEMA
from tidescore.sources import registry
from tidescore.sources.pmml import ModelError, empty_params, parse_pmml
from tidescore.sources.tensor import dense_params

START = datetime(2024, 1, 1)


def constant(value, kind="linear"):
    return {**empty_params(kind), "intercept": value, "coefs": [0.0] * len(FEATURES), "link": "identity", "terms": []}


def stump(value):
    leaf = {"tree": 0, "feature": -1, "threshold": None, "left": -1, "right": -1, "probs": None}
    root = {"tree": 0, "node": 0, "feature": 0, "threshold": 5.0, "left": 1, "right": 2, "score": None, "probs": None}
    nodes = [root, {**leaf, "node": 1, "score": value}, {**leaf, "node": 2, "score": value}]
    return {**empty_params("tree"), "nodes": nodes}


def versions_of(spark, rows):
    full = [(t, v, "n", "d", "PMML", START + timedelta(minutes=at), bytearray(b""), p) for t, v, at, p in rows]
    return spark.createDataFrame(full, MODEL_VERSION_SCHEMA)


def records_of(spark, rows):
    schema = "data_type string, ts timestamp, id long, " + ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame([(t, START + timedelta(minutes=at), i, *[x] * len(FEATURES)) for t, at, i, x in rows], schema)


@pytest.mark.parametrize("shuffled", [False, True])
def test_a_version_number_belongs_to_its_data_type(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(dispatch, "fits_broadcast", lambda df: False)
    versions = versions_of(spark, [("a", 1, 0, constant(10.0)), ("b", 1, 0, constant(20.0)), ("c", 1, 0, stump(30.0)),
                                   ("d", 1, 0, stump(40.0)), ("", 1, 0, stump(50.0))])
    records = records_of(spark, [(t, 1, i, 1.0) for i, t in enumerate(["a", "b", "c", "d", ""])])
    got = {r.id: r.result for r in dispatch.score_with_versions(records, versions).collect()}
    assert got == {0: 10.0, 1: 20.0, 2: 30.0, 3: 40.0, 4: 50.0}


def test_tree_joins_use_the_data_type(spark):
    versions = versions_of(spark, [("a", 1, 0, stump(1.0)), ("b", 1, 0, stump(2.0))])
    records = records_of(spark, [("a", 1, 0, 1.0), ("b", 1, 1, 9.0)]).withColumns({"version": F.lit(1), "tree": F.lit(0)})
    assert {r.id: r.leaf_score for r in descend(records, versions).collect()} == {0: 1.0, 1: 2.0}


def test_sums_do_not_depend_on_other_models(spark):
    """The same records and sums, alone and beside a tree of another type: equal to the last bit."""
    reciprocal = {**constant(0.0, "glm"), "link": "inverse"}
    own = [("a", 1, 0, reciprocal), ("b", 1, 0, {**constant(1.0), "coefs": [1.0] * len(FEATURES)})]
    records = records_of(spark, [("a", 1, 0, 1.0), ("b", 1, 1, float("nan")), ("b", 1, 2, 0.1), ("b", -5, 3, 1.0)])
    alone = dispatch.score_with_versions(records, versions_of(spark, own), "null")
    beside = dispatch.score_with_versions(records, versions_of(spark, [*own, ("c", 1, 0, stump(1.0))]), "null")
    text = lambda df: sorted((r.id, str(r.result)) for r in df.collect())
    assert text(alone) == text(beside)
    assert dict(text(alone))[0] == "inf" and dict(text(alone))[1] == "nan" and dict(text(alone))[3] == "None"


@pytest.mark.parametrize("form", [resolve.resolve, resolve.resolve_sorted])
def test_forms_agree_on_null_times_and_names(spark, monkeypatch, form):
    models_ = spark.createDataFrame(
        [("a", 9, None), ("a", 1, START), (None, 5, START), ("b", 7, None)], "data_type string, version long, valid_from timestamp")
    names = ["bucket", "width", "origin", "buckets", "chunk", "offset", "side", "tie", "model", "rec", "own", "g_type"]
    rows = [("a", START + timedelta(minutes=1), *[777] * len(names)), ("b", START, *[777] * len(names)),
            ("a", START - timedelta(minutes=1), *[777] * len(names))]
    records = spark.createDataFrame(rows, "data_type string, ts timestamp, " + ", ".join(f"{n} int" for n in names))
    got = form(records, models_, "null").collect()
    assert sorted((r.data_type, r.ts, r.version) for r in got) == sorted(
        [("a", rows[0][1], 1), ("b", START, None), ("a", rows[2][1], None)], key=lambda r: (r[0], r[1]))
    assert all(r[n] == 777 for r in got for n in names)
    with pytest.raises(ValueError, match="taken"):
        form(records.withColumn("version", F.lit(1)), models_)


def test_snapshot_applies_before_arrivals_and_keeps_its_time(spark):
    schema = "data_type string, version long, valid_from timestamp"
    snapshot = spark.createDataFrame([("a", 1, START - timedelta(days=900)), ("b", 2, START)], schema)
    arrived = spark.createDataFrame([("a", i, START + timedelta(minutes=i)) for i in range(10, 1010)], schema)
    records = spark.createDataFrame(
        [("a", START - timedelta(days=5000)), ("a", START + timedelta(minutes=500, seconds=1)), ("b", START), ("c", START)],
        "data_type string, ts timestamp")
    got = resolve.resolve_after(records, snapshot, arrived, "null")
    assert sorted((r.data_type, r.version, r.valid_from) for r in got.collect() if r.version) == [
        ("a", 1, START - timedelta(days=900)), ("a", 500, START + timedelta(minutes=500)), ("b", 2, START)]
    assert resolve.resolve_after(records, snapshot, arrived).count() == 3
    # A thousand arrivals and an old snapshot still leave the records where they are.
    plan = resolve.resolve(records, arrived)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan


def test_running_statistics_of_columns_named_offset_and_chunk(spark):
    rows = [("a", 1, START + timedelta(minutes=i), i, i, 3, START) for i in range(5)]
    scored = spark.createDataFrame(rows, "data_type string, version long, ts timestamp, offset long, chunk long, duration long, "
                                         "valid_from timestamp")
    got = stats.running_stats(scored, ["offset", "chunk"]).orderBy("offset").collect()
    assert [(r.usage, r.duration, r.min_duration, r.max_duration) for r in got] == [(i + 1, 3 * i + 3, 3, 3) for i in range(5)]


def dense_error(spark, document):
    row = spark.createDataFrame([(bytearray(document.encode()),)], "d binary").select(dense_params(F.col("d")).cast(PARAMS_TYPE).alias("p"))
    return row.select(F.when(F.col("p").isNull(), "no layers").otherwise(batch_scoring.scoring_error(F.col("p"))).alias("e")).first().e


def test_unscorable_models_are_refused(spark):
    (_, selu), (_, ragged), (_, narrow), (_, categorical) = inputs.UNSCORABLE
    assert "ValueError" in dense_error(spark, selu) and "shapes" in dense_error(spark, ragged)
    assert "ValueError" in dense_error(spark, narrow)
    with pytest.raises(ModelError, match="CategoricalPredictor"):
        parse_pmml(categorical.encode())
    good = inputs.layers_document("identity", f"[{inputs._ROW},{inputs._ROW}]", 2)
    assert dense_error(spark, good) is None
    assert batch_scoring.trial(constant(1.0)) is None and batch_scoring.trial(models.forest()) is None
    assert "leaf" in batch_scoring.trial(stump(None))


def test_forest_leaf_without_distribution(spark):
    """Its class counts as certain, in columns, in batches and beside leaves with distributions."""
    forest = models.forest(3, 3)
    first = min(n["tree"] for n in forest["nodes"])
    bare = {**forest, "nodes": [{**n, "probs": None if n["tree"] == first else n["probs"],
                                 "score": float(forest["labels"][2]) if n["tree"] == first and n["feature"] < 0 else n["score"]}
                                for n in forest["nodes"]]}
    sure = [float(i == 2) for i in range(len(forest["labels"]))]
    full = {**forest, "nodes": [{**n, "probs": sure if n["tree"] == first and n["feature"] < 0 else n["probs"]}
                                for n in forest["nodes"]]}
    records = records_of(spark, [("a", 1, i, i / 3) for i in range(60)])
    answers = [
        [r.result for r in f(records, p).orderBy("id").collect()]
        for p in (bare, full) for f in (scoring.score, batch_scoring.score_batches)
    ]
    assert answers[0] == answers[1] == answers[2] == answers[3]


def test_null_vectors_score_null(spark):
    params = models.dense()
    rows = spark.createDataFrame([(0, [1.0] * len(params["layers"][0]["weights"][0])), (1, None)], "id long, v array<double>")
    got = rows.select("id", batch_scoring.score_vector(F.col("v"), params).alias("r"),
                      batch_scoring.network_outputs(F.col("v"), params).alias("o")).orderBy("id").collect()
    assert got[0].r is not None and got[0].o and got[1].r is None and got[1].o is None


def test_nan_and_absent_stay_apart(spark):
    row = {c: 1.0 for c in FEATURES} | {"alcohol": float("nan"), "dataType": "a"}
    rows = spark.createDataFrame([tuple(row[c] for c in RECORD_SCHEMA.names), tuple(None for _ in RECORD_SCHEMA.names)], RECORD_SCHEMA)
    back = rows.select(codec.decode_record(codec.encode_record(F.struct(*RECORD_SCHEMA.names))).alias("r")).select("r.*")
    got = back.orderBy(F.desc("dataType")).collect()
    assert str(got[0].alcohol) == "nan" and got[0].error is None and got[1].alcohol == 0.0 and got[1].dataType == ""


def test_empty_data_type_survives_the_registry(spark, tmp_path):
    versions = versions_of(spark, [("", 1, 0, constant(1.0)), ("a", 2, 0, constant(2.0))])
    registry.append_versions(versions, str(tmp_path / "r"))
    back = registry.read_versions(spark, str(tmp_path / "r"))
    assert sorted((r.data_type, r.version) for r in back.select("data_type", "version").collect()) == [("", 1), ("a", 2)]
    assert back.where("data_type = ''").count() == 1


def test_publishing_sorts_no_documents(spark, tmp_path):
    """A task's documents are written as they come, for few data types; those of further ones are all there too."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    spark.sql(f"CREATE TABLE published_here (version LONG, data_type STRING) USING parquet PARTITIONED BY (data_type) LOCATION '{tmp_path}/t'")
    try:
        text = "EXPLAIN INSERT INTO published_here SELECT id, CAST(id % 3 AS STRING) FROM range(9)"
        assert "Sort" in spark.sql(text).first()[0]
        with registry.unsorted_writes(spark):
            assert "Sort" not in spark.sql(text).first()[0]
    finally:
        spark.sql("DROP TABLE published_here")
    assert spark.conf.get(key, "0") == before
    one = spark.createDataFrame([("a", 1, "n", "d", "PMML", START, bytearray(b"x"), constant(1.0))], MODEL_VERSION_SCHEMA)
    many = spark.range(200).coalesce(1).select((F.col("id") % 40).cast("string").alias("data_type"), F.col("id").alias("version"))
    path = f"{tmp_path}/registry"
    registry.append_versions(many.crossJoin(one.drop("data_type", "version")), path)
    back = registry.read_versions(spark, path)
    assert back.count() == 200 and back.select("data_type").distinct().count() == 40
