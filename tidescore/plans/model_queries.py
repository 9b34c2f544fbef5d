"""One model over a whole table, every kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.functions import vectors
from tidescore.functions.features import bind_fields, double_vector
from tidescore.operators import batch_scoring, bit_vectors, evaluate, leaf_join, scoring
from tidescore.operators.batch_scoring import network_outputs, score_vector
from tidescore.plans import inputs, models, sqltext
from tidescore.plans.catalogue import query
from tidescore.schemas import FEATURES, PARAMS_TYPE
from tidescore.sources import artifacts

KEYS = ", ".join(inputs.LINE_KEYS)
VECTOR = "[" + ", ".join(FEATURES) + "]"
LABELS = sqltext.numbers(float(v) for v in models.LABELS)
FIRST_BEST = "list_position(x, list_max(x))"

LINEAR = models.linear()
GLMS = {
    "identity": models.linear("glm", "identity"),
    "log": models.linear("glm", "log", 0.3),
    "inverse": models.linear("glm", "inverse", 0.3),
    "logit": models.linear("glm", "logit", 0.3),
    "sqrt": models.linear("glm", "sqrt"),
    "cloglog": models.linear("glm", "cloglog", 0.3),
}
TREE_CLASS = models.tree_classifier()
TREE_REG = models.tree_regressor()
FOREST = models.forest()
SMALL_FOREST = models.forest(3, 3)
PERCEPTRON = models.perceptron()
DENSE = models.dense()


def keyed(df: DataFrame, decimals: int | None = None) -> DataFrame:
    value = F.col("result") if decimals is None else F.round("result", decimals)
    return df.select(*inputs.LINE_KEYS, value.alias("result"))


def _select(value: str) -> str:
    return f"WITH {sqltext.WINE} SELECT {KEYS}, {value} AS result FROM wine"


@query("score_linear", _select(f"round({sqltext.linked(LINEAR)}, 6)"))
def score_linear(spark, folder):
    return keyed(scoring.score(inputs.wine(spark, folder), LINEAR), 6)


def _glm(name: str, params: dict) -> None:
    @query(f"score_glm_{name}", _select(f"round({sqltext.linked(params)}, 4)"))
    def run(spark, folder):
        return keyed(scoring.score(inputs.wine(spark, folder), params), 4)


for _name, _params in GLMS.items():
    _glm(_name, _params)


RECIPROCAL = {**GLMS["inverse"], "intercept": 0.0, "coefs": [float(c == "alcohol") for c in FEATURES]}


@query(
    "glm_inverse_zero",
    f"WITH {sqltext.WINE} SELECT {KEYS}, duration % 2 = 0 AS infinite, "
    "CASE WHEN duration % 2 = 1 THEN round(1e0 / alcohol, 6) END AS result FROM wine",
)
def glm_inverse_zero(spark, folder):
    """One over zero is infinite."""
    df = inputs.wine(spark, folder)
    df = df.withColumn("alcohol", F.when(F.col("duration") % 2 == 1, F.col("alcohol")).otherwise(0.0))
    scored = scoring.score(df, RECIPROCAL)
    infinite = F.col("result") == float("inf")
    return scored.select(
        *inputs.LINE_KEYS, infinite.alias("infinite"), F.when(~infinite, F.round("result", 6)).alias("result"))


def _tree(params: dict) -> str:
    nodes = scoring.trees_of(params)[0]
    return sqltext.tree_case(nodes, lambda r: sqltext.number(r["score"]))


@query("score_tree_class", _select(_tree(TREE_CLASS)))
def score_tree_class(spark, folder):
    return keyed(scoring.score(inputs.wine(spark, folder), TREE_CLASS))


@query("score_tree_reg", _select(f"round({_tree(TREE_REG)}, 6)"))
def score_tree_reg(spark, folder):
    return keyed(scoring.score(inputs.wine(spark, folder), TREE_REG), 6)


def _probabilities() -> str:
    nodes = scoring.trees_of(TREE_CLASS)[0]
    parts = []
    for k, label in enumerate(models.LABELS):
        case = sqltext.tree_case(nodes, lambda r, k=k: sqltext.number(r["probs"][k]))
        parts.append(f"round({case}, 6) AS p{label}")
    return f"WITH {sqltext.WINE} SELECT {KEYS}, {', '.join(parts)} FROM wine"


@query("tree_probabilities", _probabilities())
def tree_probabilities(spark, folder):
    df = inputs.wine(spark, folder)
    columns = scoring.tree_probability_columns(TREE_CLASS, bind_fields(FEATURES, df.columns))
    return df.select(*inputs.LINE_KEYS, *[F.round(c, 6).alias(f"p{label}") for label, c in columns.items()])


def _forest_sql(params: dict, value: str) -> str:
    leaves, means = sqltext.forest_select(params, scoring.trees_of(params))
    return (
        f"WITH {sqltext.WINE}, leaves AS (SELECT {KEYS}, {leaves} FROM wine), "
        f"means AS (SELECT {KEYS}, {means} AS x FROM leaves) SELECT {KEYS}, {value} FROM means"
    )


@query("score_forest", _forest_sql(FOREST, f"({LABELS})[{FIRST_BEST}] AS result"))
def score_forest(spark, folder):
    return keyed(scoring.score(inputs.wine(spark, folder), FOREST))


@query("score_forest_small", _forest_sql(SMALL_FOREST, f"({LABELS})[{FIRST_BEST}] AS result"))
def score_forest_small(spark, folder):
    return keyed(scoring.score(inputs.wine(spark, folder), SMALL_FOREST))


@query(
    "forest_probabilities",
    _forest_sql(SMALL_FOREST, ", ".join(f"round(x[{k + 1}], 6) AS p{v}" for k, v in enumerate(models.LABELS))),
)
def forest_probabilities(spark, folder):
    df = inputs.wine(spark, folder)
    frame = scoring.forest_frame(df, SMALL_FOREST, bind_fields(FEATURES, df.columns))
    return frame.select(
        *inputs.LINE_KEYS, *[F.round(F.col("_probs")[k], 6).alias(f"p{v}") for k, v in enumerate(models.LABELS)]
    )


def leaves_of(spark, params: dict, version: int) -> DataFrame:
    row = spark.createDataFrame([(version, params)], "version long, params " + PARAMS_TYPE.simpleString())
    return leaf_join.leaf_table(row)


@query(
    "tree_leaf_join",
    f"WITH {sqltext.WINE} SELECT {KEYS}, round(CASE WHEN data_type = 'F' THEN {_tree(TREE_REG)} "
    f"ELSE {_tree(TREE_CLASS)} END, 6) AS result FROM wine",
)
def tree_leaf_join(spark, folder):
    """Two tree versions scored in one join: one for finished lines, one for open ones."""
    df = inputs.wine(spark, folder).withColumn(
        "version", F.when(F.col("data_type") == "F", F.lit(1)).otherwise(F.lit(2)).cast("long")
    )
    leaves = leaves_of(spark, TREE_REG, 1).unionByName(leaves_of(spark, TREE_CLASS, 2))
    return keyed(leaf_join.score_tree_by_leaves(df, leaves), 6)


@query(
    "tree_descent_join",
    f"WITH {sqltext.WINE} SELECT {KEYS}, round(CASE WHEN data_type = 'F' THEN {_tree(TREE_REG)} "
    f"ELSE {_tree(TREE_CLASS)} END, 6) AS result FROM wine",
)
def tree_descent_join(spark, folder):
    """The same two versions, followed level by level through the node table."""
    df = inputs.wine(spark, folder).select(
        "*", F.when(F.col("data_type") == "F", F.lit(1)).otherwise(F.lit(2)).cast("long").alias("version"),
        F.lit(0).alias("tree"),
    )
    rows = spark.createDataFrame([(1, TREE_REG), (2, TREE_CLASS)], "version long, params " + PARAMS_TYPE.simpleString())
    out = leaf_join.descend(df, rows)
    return out.select(*inputs.LINE_KEYS, F.round("leaf_score", 6).alias("result"))


@query("forest_leaf_join", _forest_sql(SMALL_FOREST, f"({LABELS})[{FIRST_BEST}] AS result"))
def forest_leaf_join(spark, folder):
    # Line keys may repeat, but lines with equal keys and inputs score alike: count them, score one.
    lines = inputs.wine(spark, folder).groupBy(*inputs.LINE_KEYS, *FEATURES).agg(F.count(F.lit(1)).alias("lines"))
    df = lines.withColumn("version", F.lit(1).cast("long"))
    leaves = leaves_of(spark, SMALL_FOREST, 1)
    scored = leaf_join.score_forest_by_leaves(df, leaves, models.LABELS, [*inputs.LINE_KEYS, *FEATURES, "lines"])
    return scored.select(*inputs.LINE_KEYS, "result", F.explode(F.sequence(F.lit(1), F.col("lines").cast("int")))).drop("col")


@query("forest_bitvector_join", _forest_sql(FOREST, f"({LABELS})[{FIRST_BEST}] AS result"))
def forest_bitvector_join(spark, folder):
    """The whole forest of 320 leaves: a row meets one interval of thresholds per feature."""
    df = inputs.wine(spark, folder).withColumn("version", F.lit(1).cast("long"))
    rows = spark.createDataFrame([(1, FOREST)], "version long, params " + PARAMS_TYPE.simpleString())
    return bit_vectors.score_forest_by_bits(df, rows, models.LABELS).select(*inputs.LINE_KEYS, "result")


@query("tree_bitvector_join", _select(f"round({_tree(TREE_REG)}, 6)"))
def tree_bitvector_join(spark, folder):
    df = inputs.wine(spark, folder).withColumn("version", F.lit(1).cast("long"))
    rows = spark.createDataFrame([(1, TREE_REG), (2, TREE_CLASS)], "version long, params " + PARAMS_TYPE.simpleString())
    return bit_vectors.score_tree_by_bits(df, rows).select(*inputs.LINE_KEYS, F.round("result", 6).alias("result"))


@query(
    "score_mlp",
    f"WITH {sqltext.WINE}, {sqltext.network_ctes(PERCEPTRON, 'wine', VECTOR, KEYS)} "
    f"SELECT {KEYS}, ({LABELS})[{FIRST_BEST}] AS result FROM layer3",
)
def score_mlp(spark, folder):
    return keyed(scoring.score(inputs.wine(spark, folder), PERCEPTRON))


@query(
    "mlp_probabilities",
    f"WITH {sqltext.WINE}, {sqltext.network_ctes(PERCEPTRON, 'wine', VECTOR, KEYS)}, "
    f"shifted AS (SELECT {KEYS}, list_transform(x, lambda y: exp(y - list_max(x))) AS e FROM layer3) "
    f"SELECT {KEYS}, "
    + ", ".join(f"round(e[{k + 1}] / list_sum(e), 5) AS p{v}" for k, v in enumerate(models.LABELS))
    + " FROM shifted",
)
def mlp_probabilities(spark, folder):
    df = inputs.wine(spark, folder).withColumn("p", network_outputs(double_vector(), PERCEPTRON))
    return df.select(
        *inputs.LINE_KEYS, *[F.round(F.col("p")[k], 5).alias(f"p{v}") for k, v in enumerate(models.LABELS)]
    )


_EMBEDDED = "CAST(embedding AS DOUBLE[])"


@query(
    "score_dense",
    f"WITH {sqltext.network_ctes(DENSE, 'embeddings', _EMBEDDED, 'vec_id')} "
    f"SELECT vec_id, CAST({FIRST_BEST} - 1 AS DOUBLE) AS result FROM layer3",
)
def score_dense(spark, folder):
    df = inputs.table(spark, folder, "embeddings")
    return df.select("vec_id", score_vector(F.col("embedding"), DENSE).alias("result"))


@query(
    "score_bundle",
    f"WITH {sqltext.network_ctes(DENSE, 'embeddings', _EMBEDDED, 'vec_id')} "
    f"SELECT vec_id, CAST({FIRST_BEST} - 1 AS DOUBLE) AS label FROM layer3",
)
def score_bundle(spark, folder):
    """Input and output names come from a signature listing: here, the table's own columns."""
    df = inputs.table(spark, folder, "embeddings")
    parameter = lambda n: F.array(F.struct(
        F.lit(f"{n}:0").alias("name"), F.lit("DT_FLOAT").alias("dtype"), F.array(F.lit(-1)).alias("shape")
    ))
    signature = F.struct(parameter("embedding").alias("inputs"), parameter("label").alias("outputs"))
    manifest = F.to_json(F.struct(F.create_map(F.lit("serving"), signature).alias("signatures")))
    listing = artifacts.model_signatures(df.agg(F.count(F.lit(1)).alias("n")).select("n", manifest.alias("m")), "m", ["n"])
    return batch_scoring.score_bundle(df, DENSE, listing).select("vec_id", "label")


@query("score_timed", f"WITH {sqltext.WINE} SELECT quality, count(*) AS n, true AS timed FROM wine GROUP BY quality")
def score_timed(spark, folder):
    """Every record carries a scoring time above zero."""
    out = batch_scoring.score_timed(inputs.wine(spark, folder), PERCEPTRON)
    return out.groupBy("quality").agg(
        F.count("result").alias("n"), (F.min("duration_ms") > 0.0).alias("timed")
    )


@query(
    "argmax_index",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS DOUBLE) AS best FROM embeddings",
)
def argmax_index(spark, folder):
    df = inputs.table(spark, folder, "embeddings")
    return df.select("vec_id", vectors.argmax_index(F.col("embedding")).alias("best"))


_SIZE = 64


@query(
    "ensemble_average",
    "SELECT label, pos, round(avg(v), 6) AS mean FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS pos, "
    "CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) AS s GROUP BY label, pos",
)
def ensemble_average(spark, folder):
    """Mean vector per class: one average per position, combined on the map side."""
    df = inputs.table(spark, folder, "embeddings")
    means = df.groupBy("label").agg(vectors.elementwise_avg(F.col("embedding"), _SIZE).alias("m"))
    return means.select("label", F.posexplode("m").alias("pos", "v")).select(
        "label", F.col("pos").cast("long").alias("pos"), F.round("v", 6).alias("mean")
    )


_CLASSES = [3, 4, 5, 6, 7, 8]


@query(
    "class_probability",
    f"WITH {sqltext.WINE} SELECT data_type, "
    + ", ".join(f"round(sum(CASE WHEN quality = {c} THEN 1e0 ELSE 0e0 END) / count(*), 6) AS p{c}" for c in _CLASSES)
    + " FROM wine GROUP BY data_type",
)
def class_probability(spark, folder):
    counts = F.array(*[F.sum((F.col("quality") == c).cast("long")) for c in _CLASSES])
    df = inputs.wine(spark, folder).groupBy("data_type").agg(counts.alias("counts"))
    probs = df.select("data_type", vectors.class_probabilities(F.col("counts")).alias("p"))
    return probs.select("data_type", *[F.round(F.col("p")[i], 6).alias(f"p{c}") for i, c in enumerate(_CLASSES)])


def _pairs(spark, folder, params) -> DataFrame:
    return evaluate.expected_pairs(scoring.score(inputs.wine(spark, folder), params), label="quality")


@query(
    "expected_vs_result",
    f"WITH {sqltext.WINE} SELECT {_tree(TREE_CLASS)} AS result, CAST(quality AS DOUBLE) AS expected FROM wine",
)
def expected_vs_result(spark, folder):
    return _pairs(spark, folder, TREE_CLASS)


@query(
    "accuracy",
    f"WITH {sqltext.WINE}, p AS (SELECT {_tree(TREE_CLASS)} AS result, CAST(quality AS DOUBLE) AS expected FROM wine) "
    "SELECT count(*) AS n, sum(CASE WHEN result = expected THEN 1e0 ELSE 0e0 END) AS correct, "
    "round(avg(CASE WHEN result = expected THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM p",
)
def accuracy(spark, folder):
    return evaluate.accuracy(_pairs(spark, folder, TREE_CLASS)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "rmse_r2",
    f"WITH {sqltext.WINE}, p AS (SELECT {sqltext.linked(LINEAR)} AS result, CAST(quality AS DOUBLE) AS expected "
    "FROM wine) SELECT count(*) AS n, round(sqrt(avg((expected - result) * (expected - result))), 6) AS rmse, "
    "round(1e0 - sum((expected - result) * (expected - result)) / (var_pop(expected) * count(*)), 6) AS r2 FROM p",
)
def rmse_r2(spark, folder):
    out = evaluate.regression_error(_pairs(spark, folder, LINEAR))
    return out.select("n", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@query(
    "residuals",
    f"WITH {sqltext.WINE}, p AS (SELECT {sqltext.linked(LINEAR)} AS result, CAST(quality AS DOUBLE) AS expected "
    "FROM wine) SELECT round(result, 6) AS result, expected, round(expected - result, 6) AS residual FROM p",
)
def residuals(spark, folder):
    out = evaluate.residuals(_pairs(spark, folder, LINEAR))
    return out.select(F.round("result", 6).alias("result"), "expected", F.round("residual", 6).alias("residual"))
