"""The model registry: descriptors -> valid model versions + dead letters; append and read back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.operators.batch_scoring import scoring_error
from tidescore.operators.clean import descriptor_error, split_valid
from tidescore.operators.kinds import read_models, registered
from tidescore.schemas import MODEL_VERSION_SCHEMA, PARAMS_TYPE
from tidescore.sources.pmml import parse_documents
from tidescore.sources.tensor import dense_params, fitting_layers


def checked_versions(descriptors: DataFrame) -> DataFrame:
    """Add `params` and `error` to descriptor rows (version, valid_from, and the descriptor fields).

    Each row gets either params or an error, in one pass; a row already refused for its type or
    location does not reach the document parser.
    """
    early = descriptors.withColumn("error", F.coalesce(F.col("error"), descriptor_error())
                                   if "error" in descriptors.columns else descriptor_error())
    sound, kind = F.col("error").isNull(), F.col("modeltype")
    dense = F.when(sound & (kind == "TENSORFLOW"), dense_params(F.col("data"))).cast(PARAMS_TYPE)
    layered = early.withColumn("_dense", dense).withColumn("_fits", fitting_layers(F.col("_dense.layers")))
    parsed = layered.withColumn("_p", parse_documents(F.when(sound & (kind == "PMML"), F.col("data"))))
    found, refused = [F.col("_p.params"), F.col("_dense")], [F.col("error"), F.col("_p.error")]
    if registered():
        parsed = parsed.withColumn("_k", read_models(F.when(sound, F.col("data")), kind))
        found.append(F.col("_k.params"))
        refused.append(F.col("_k.error"))
    read = parsed.withColumn("params", F.coalesce(*found)).withColumn("error", F.coalesce(*refused)).drop("_k")
    # As the document parser does: a model that cannot score one row is refused. Layers that plainly fit need no trial.
    doubtful = (F.col("params.kind") == "dense") & ~F.col("_fits")
    tried = read.withColumn("_tried", scoring_error(F.when(doubtful, F.col("params"))))
    missing = F.when(F.col("params").isNull(), F.coalesce("error", F.lit("Bad model: no layers")))
    return tried.withColumn("error", F.coalesce(missing, "_tried")).withColumn(
        "params", F.when(F.col("error").isNull(), F.col("params"))).drop("_p", "_tried", "_dense", "_fits")


def model_versions(descriptors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid versions of MODEL_VERSION_SCHEMA, dead letters with their reason)."""
    good, bad = split_valid(checked_versions(descriptors))
    return version_rows(good), bad


def version_rows(good: DataFrame) -> DataFrame:
    return good.select(
        F.col("dataType").alias("data_type"), "version", "name", "description", "modeltype", "valid_from",
        F.col("data").alias("content"), "params",
    )


OPEN_FILES = 16  # data types that a task writes side by side; it sorts only the rows of any further ones


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file open per partition value instead of sorting a task's rows, documents and all."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    spark.conf.set(key, str(max(OPEN_FILES, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append_versions(versions: DataFrame, path: str, mode: str = "append") -> None:
    """Publish model versions; the table is partitioned by data type so that readers prune."""
    with unsorted_writes(versions.sparkSession):
        versions.select(*MODEL_VERSION_SCHEMA.names).write.mode(mode).partitionBy("data_type").parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions. A folder name cannot hold the empty data type; it comes back as null and is put right."""
    df = spark.read.schema(MODEL_VERSION_SCHEMA).parquet(path).select(*MODEL_VERSION_SCHEMA.names)
    empty = df.where(F.col("data_type").isNull()).withColumn("data_type", F.lit(""))
    return df.where(F.col("data_type").isNotNull()).unionByName(empty)


def params_table(versions: DataFrame, part: str) -> DataFrame:
    """Relational views of model parameters: `coefficients`, `tree_nodes`, `layers`, `class_labels`."""
    p = F.col("params")
    if part == "coefficients":
        pairs = F.arrays_zip(F.sequence(F.lit(0), F.size(p["coefs"]) - 1).alias("i"), p["coefs"].alias("c"))
        terms = F.concat(
            F.array(F.struct(F.lit(-1).alias("position"), p["intercept"].alias("coef"))),
            F.transform(pairs, lambda e: F.struct(e["i"].alias("position"), e["c"].alias("coef"))),
        )
        return (
            versions.where(p["kind"].isin("linear", "glm"))
            .select("version", p["link"].alias("link"), F.explode(terms).alias("t"))
            .select("version", "t.position", "t.coef", "link")
        )
    if part == "tree_nodes":
        return versions.select("version", F.explode(p["nodes"]).alias("n")).select("version", "n.*")
    if part == "layers":
        return versions.select("version", F.posexplode(p["layers"]).alias("layer", "l")).select(
            "version", "layer", "l.*"
        )
    if part == "class_labels":
        return versions.select("version", F.posexplode(p["labels"]).alias("idx", "label"))
    raise ValueError(f"no part {part!r}")
