"""Model messages to registry: decode, refuse, parse, publish, score by any version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.functions import codec, text
from tidescore.operators import clean, dispatch
from tidescore.operators.ordering import with_key_index
from tidescore.operators.resolve import resolve
from tidescore.plans import inputs, sqltext
from tidescore.plans.catalogue import query
from tidescore.schemas import DESCRIPTOR_SCHEMA, FEATURES
from tidescore.session import scratch_path
from tidescore.sources import artifacts, registry

KEYS = ", ".join(inputs.LINE_KEYS)
VALID = "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as encoded model messages, decoded again: what a topic would deliver."""
    raw = inputs.order_descriptors(spark, folder).select(
        "version", "valid_from", codec.encode_descriptor(F.struct(*DESCRIPTOR_SCHEMA.names)).alias("value")
    )
    return clean.parse_descriptors(raw).drop("value")


def published(spark: SparkSession, folder: str) -> DataFrame:
    """The valid versions, written to a registry table and read back."""
    versions, _ = registry.model_versions(messages(spark, folder))
    path = scratch_path(spark, "registry")
    registry.append_versions(versions, path)
    return registry.read_versions(spark, path)


@query(
    "descriptor_roundtrip",
    "SELECT o_orderkey AS version, 'order-' || o_orderkey AS name, o_orderpriority AS description, "
    "o_orderstatus AS \"dataType\", CASE o_orderpriority WHEN '3-MEDIUM' THEN 'TENSORFLOW' WHEN '5-LOW' "
    "THEN 'TENSORFLOWSAVED' ELSE 'PMML' END AS modeltype, "
    "CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice > 250000 THEN '/models/' || o_orderkey END AS location "
    "FROM orders",
)
def descriptor_roundtrip(spark, folder):
    return messages(spark, folder).select("version", "name", "description", "dataType", "modeltype", "location")


@query(
    "dead_letter",
    "SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Bad model: broken document' "
    "WHEN o_totalprice > 250000 THEN 'Location based is not yet supported' ELSE 'Bad model type' END AS error, "
    f"count(*) AS n FROM orders WHERE NOT ({VALID}) GROUP BY 1",
)
def dead_letter(spark, folder):
    _, bad = registry.model_versions(messages(spark, folder))
    return clean.count_by_reason(clean.dead_letters(bad, "data", "models"))


@query(
    "registry_versions",
    "SELECT o_orderstatus AS data_type, o_orderkey AS version, 'order-' || o_orderkey AS name, "
    "CASE o_orderpriority WHEN '3-MEDIUM' THEN 'TENSORFLOW' ELSE 'PMML' END AS modeltype, "
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'linear' WHEN '2-HIGH' THEN 'glm' ELSE 'dense' END AS kind "
    f"FROM orders WHERE {VALID}",
)
def registry_versions(spark, folder):
    return published(spark, folder).select(
        "data_type", "version", "name", "modeltype", F.col("params.kind").alias("kind")
    )


def _coefficients_sql() -> str:
    rows = []
    for kind, link, intercept, coef in (
        ("1-URGENT", "identity", inputs.ORDER_INTERCEPT, inputs.coefficient_sql),
        ("2-HIGH", "log", inputs.GLM_INTERCEPT, inputs.glm_coefficient_sql),
    ):
        values = [(-1, intercept)] + [(i, coef(i)) for i in range(len(FEATURES))]
        for position, value in values:
            rows.append(
                f"SELECT o_orderkey AS version, {position} AS position, round({value}, 9) AS coef, '{link}' AS link "
                f"FROM orders WHERE o_orderpriority = '{kind}'"
            )
    return " UNION ALL ".join(rows)


@query("registry_coefficients", _coefficients_sql())
def registry_coefficients(spark, folder):
    return registry.params_table(published(spark, folder), "coefficients").withColumn("coef", F.round("coef", 9))


@query(
    "registry_layers",
    f"SELECT o_orderkey AS version, 0 AS layer, round({inputs.DENSE_THRESHOLD}, 6) AS threshold, 2 AS outputs "
    "FROM orders WHERE o_orderpriority = '3-MEDIUM'",
)
def registry_layers(spark, folder):
    layers = registry.params_table(published(spark, folder), "layers")
    return layers.select(
        "version", "layer", F.round(F.col("bias")[0], 6).alias("threshold"), F.size("weights").alias("outputs")
    )


def _mixed_sql(version: str = "o_orderkey", join: str = "ASOF JOIN", otherwise: tuple[str, str] | None = None) -> str:
    eta = "intercept" + "".join(f" + c{i} * {name}" for i, name in enumerate(FEATURES))
    number, default = "m.version", ""
    if otherwise:
        number, default = f"coalesce(m.version, {otherwise[0]}) AS version", f"WHEN m.version IS NULL THEN {otherwise[1]} "
    choose = lambda a, b: f"CASE WHEN o_orderpriority = '2-HIGH' THEN {b} ELSE {a} END"
    coefs = ", ".join(
        f"{choose(inputs.coefficient_sql(i), inputs.glm_coefficient_sql(i))} AS c{i}" for i in range(len(FEATURES))
    )
    return (
        f"WITH {sqltext.WINE}, models AS (SELECT o_orderstatus AS data_type, {version} AS version, "
        f"o_orderdate AS valid_from, o_orderpriority AS kind, {inputs.DENSE_THRESHOLD} AS threshold, "
        f"{choose(inputs.ORDER_INTERCEPT, inputs.GLM_INTERCEPT)} AS intercept, {coefs} FROM orders WHERE {VALID} "
        "QUALIFY row_number() OVER (PARTITION BY o_orderstatus, o_orderdate ORDER BY o_orderkey DESC) = 1) "
        f"SELECT {KEYS}, {number}, CASE {default}WHEN m.kind = '1-URGENT' THEN round({eta}, 5) "
        f"WHEN m.kind = '2-HIGH' THEN round(exp({eta}), 5) "
        "ELSE CASE WHEN CAST(w.alcohol AS FLOAT) > CAST(m.threshold AS FLOAT) THEN 1e0 ELSE 0e0 END END AS result "
        f"FROM wine w {join} models m ON w.data_type = m.data_type AND w.ts >= m.valid_from"
    )


MIXED = _mixed_sql()


@query("score_mixed_kinds", MIXED)
def score_mixed_kinds(spark, folder):
    """Every record is scored by the version valid at its time; refused models never take effect."""
    scored = dispatch.score_with_versions(inputs.wine(spark, folder), published(spark, folder))
    return scored.select(*inputs.LINE_KEYS, "version", F.round("result", 5).alias("result"))


@query("score_mixed_kinds_shuffled", MIXED)
def score_mixed_kinds_shuffled(spark, folder):
    """The form for models too large to send to every executor."""
    versions = published(spark, folder)
    resolved = resolve(inputs.wine(spark, folder), versions.select("data_type", "version", "valid_from"))
    # What comes in is shuffled and comes out again: no more than is asked for.
    needed = resolved.select(*inputs.LINE_KEYS, "version", *FEATURES)
    scored = dispatch.score_cogrouped(needed, versions.select("version", "params"))
    return scored.select(*inputs.LINE_KEYS, "version", F.round("result", 5).alias("result"))


@query(
    "mixed_kinds_per_type_versions",
    _mixed_sql("row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey)"),
)
def mixed_kinds_per_type_versions(spark, folder):
    """Every data type numbers its own versions from one, so a version alone names no model."""
    # Scoring reads no documents, so they are not written again with the numbers.
    models = published(spark, folder).drop("content")
    numbered = with_key_index(models, ["data_type"], [F.col("version")], "_nth")
    versions = numbered.withColumn("version", F.col("_nth") + 1).drop("_nth")
    scored = dispatch.score_with_versions(inputs.wine(spark, folder), versions)
    return scored.select(*inputs.LINE_KEYS, "version", F.round("result", 5).alias("result"))


@query(
    "dead_letter_unscorable",
    "SELECT CASE o_orderkey % 4 WHEN 1 THEN 'Bad model: layer shapes do not fit' "
    "WHEN 3 THEN 'Bad model: CategoricalPredictor is not supported' "
    "ELSE 'Bad model: cannot be scored (ValueError)' END AS error, count(*) AS n FROM orders GROUP BY 1",
)
def dead_letter_unscorable(spark, folder):
    """Documents that parse and still cannot score a record are refused before they take effect."""
    raw = inputs.unscorable_descriptors(spark, folder).select(
        "version", "valid_from", codec.encode_descriptor(F.struct(*DESCRIPTOR_SCHEMA.names)).alias("value")
    )
    _, bad = registry.model_versions(clean.parse_descriptors(raw).drop("value"))
    return clean.count_by_reason(clean.dead_letters(bad, "data", "models"))


@query(
    "model_names",
    "SELECT p_partkey, p_name || '-' || p_partkey AS pmml_name, 'data/' || p_name || '-' || p_partkey AS tensor_name "
    "FROM part",
)
def model_names(spark, folder):
    stem = F.concat(F.lit("data/"), "p_name", F.lit("-"), F.col("p_partkey").cast("string"))
    parts = inputs.table(spark, folder, "part").select(
        "p_partkey", F.concat(stem, F.lit(".pmml")).alias("pmml"), F.concat(stem, F.lit(".pb")).alias("pb")
    )
    none = F.lit(None).cast("binary")
    return parts.select(
        "p_partkey",
        artifacts.pmml_descriptor(F.col("pmml"), none)["name"].alias("pmml_name"),
        artifacts.tensor_descriptor(F.col("pb"), none)["name"].alias("tensor_name"),
    )


@query(
    "model_signature",
    "SELECT p_partkey, 'serving' AS signature, 'input' AS side, p_type AS tensor, 'DT_FLOAT' AS dtype, "
    "p_size AS width FROM part UNION ALL SELECT p_partkey, 'serving', 'output', p_brand, 'DT_FLOAT', 1 FROM part",
)
def model_signature(spark, folder):
    parameter = lambda name, width: F.struct(
        F.concat(F.col(name), F.lit(":0")).alias("name"), F.lit("DT_FLOAT").alias("dtype"),
        F.array(F.lit(-1), width).alias("shape"),
    )
    signature = F.struct(
        F.array(parameter("p_type", F.col("p_size").cast("int"))).alias("inputs"),
        F.array(parameter("p_brand", F.lit(1))).alias("outputs"),
    )
    manifest = F.to_json(F.struct(F.create_map(F.lit("serving"), signature).alias("signatures")))
    parts = inputs.table(spark, folder, "part").select("p_partkey", manifest.alias("manifest"))
    rows = artifacts.model_signatures(parts, "manifest", ["p_partkey"])
    return rows.select("p_partkey", "signature", "side", "tensor", "dtype", F.col("dimensions")[1].alias("width"))


@query(
    "artifact_scan",
    "SELECT replace(p_brand, '#', '_') AS brand, count(*) AS documents, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS length "
    "FROM part GROUP BY 1",
)
def artifact_scan(spark, folder):
    """One document per brand, written, found again by its suffix and read; other files are passed over."""
    path = scratch_path(spark, "documents")
    parts = inputs.table(spark, folder, "part").select("p_name", F.translate("p_brand", "#", "_").alias("brand"))
    parts.repartition("brand").write.partitionBy("brand").text(path)
    parts.limit(1).select("p_name").write.json(f"{path}/brand=none")
    files = artifacts.scan_artifacts(spark, path, ".txt")
    lines = F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1
    return files.groupBy(F.regexp_extract("path", "brand=([^/]+)/", 1).alias("brand")).agg(
        F.sum(lines).alias("documents"), F.sum("length").alias("length"))
