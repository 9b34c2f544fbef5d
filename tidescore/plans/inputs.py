"""Record and model streams derived from the tables of a data folder.

The derivations are SQL text that Spark and other SQL engines read alike, so that a check in
another engine starts from the same inputs.

  events     users are data types; a `signup` delivers that user's next model (weight = value),
             every other event is a record to score
  orders     order status is the data type; each order delivers a model for it
  lineitem   line status is the data type; each line is a record with eleven features
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.schemas import FEATURES
from tidescore.session import spread

# Lower and upper end of each synthetic feature.
FEATURE_RANGES = {
    "fixed_acidity": (4.7, 13.4),
    "volatile_acidity": (0.2, 1.0),
    "citric_acid": (0.04, 0.74),
    "residual_sugar": (1.0, 4.9),
    "chlorides": (0.03, 0.19),
    "free_sulfur_dioxide": (1.0, 36.0),
    "total_sulfur_dioxide": (0.0, 121.0),
    "density": (0.992, 1.0014),
    "pH": (2.93, 3.63),
    "sulphates": (0.37, 1.14),
    "alcohol": (8.6, 12.5),
}
# Multipliers and moduli that spread the keys over each range.
SPREAD = [
    (31, 7, 3, 997),
    (37, 11, 5, 983),
    (41, 13, 7, 977),
    (43, 17, 11, 971),
    (47, 19, 13, 967),
    (53, 23, 17, 953),
    (59, 29, 19, 947),
    (61, 31, 23, 941),
    (67, 37, 29, 937),
    (71, 41, 31, 929),
    (73, 43, 37, 919),
]


def number(value: float) -> str:
    """A double literal in both engines: the exponent keeps it from reading as a decimal."""
    text = repr(float(value))
    return text if "e" in text else f"{text}e0"


def feature_sql(name: str) -> str:
    lo, hi = FEATURE_RANGES[name]
    a, b, c, n = SPREAD[FEATURES.index(name)]
    key = f"(l_orderkey * {a} + l_partkey * {b} + l_linenumber * {c}) % {n}"
    return f"({number(lo)} + CAST({key} AS DOUBLE) / {number(n)} * {number(round(hi - lo, 6))})"


def _unit(name: str) -> str:
    lo, hi = FEATURE_RANGES[name]
    return f"(({name} - {number(lo)}) / {number(round(hi - lo, 6))})"


LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_STREAM_SQL = ", ".join(
    [*LINE_KEYS, "l_returnflag", "l_linestatus AS data_type", "l_shipdate AS ts",
     "CAST(floor(l_quantity) AS BIGINT) AS duration",
     *[f"{feature_sql(c)} AS {c}" for c in FEATURES]]
)
QUALITY_SQL = (
    f"CAST(floor(3e0 + 2.5e0 * {_unit('alcohol')} + 1.9e0 * {_unit('sulphates')}"
    f" + 1.5e0 * (1e0 - {_unit('volatile_acidity')})) AS INTEGER)"
)
WINE_SQL = f"SELECT *, {QUALITY_SQL} AS quality FROM (SELECT {LINE_STREAM_SQL} FROM lineitem) AS s"

EVENT_MODELS_SQL = (
    "SELECT CAST(user_id AS VARCHAR(20)) AS data_type, event_id AS version, ts AS valid_from, value AS weight "
    "FROM events WHERE event_type = 'signup'"
)
EVENT_RECORDS_SQL = (
    "SELECT CAST(user_id AS VARCHAR(20)) AS data_type, ts, event_id, event_type, value, "
    "CAST(floor(value) AS BIGINT) AS duration FROM events WHERE event_type <> 'signup'"
)
# Multipliers that turn a customer key into eleven coefficients.
COEFFICIENT_SPREAD = [3, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41]


def coefficient_sql(i: int) -> str:
    return f"(CAST((o_custkey * {COEFFICIENT_SPREAD[i]}) % 100 AS DOUBLE) / 100e0)"


ORDER_MODELS_SQL = (
    "SELECT o_orderstatus AS data_type, o_orderkey AS version, o_orderdate AS valid_from, "
    "(o_totalprice / 100000e0) AS intercept, "
    + ", ".join(f"{coefficient_sql(i)} AS c{i}" for i in range(len(FEATURES)))
    + " FROM orders"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SPREAD_KEYS = {"lineitem": LINE_KEYS, "orders": ["o_orderkey"]}


def _run(spark: SparkSession, folder: str, name: str, sql: str) -> DataFrame:
    source = table(spark, folder, name)
    if name in SPREAD_KEYS:
        source = spread(source, *SPREAD_KEYS[name])
    text = sql.replace("{", "{{").replace("}", "}}").replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(text, **{name: source})


def wine(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as records: keys, return flag, data_type, ts, duration, eleven features, quality."""
    return _run(spark, folder, "lineitem", WINE_SQL)


def event_models(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, "events", EVENT_MODELS_SQL)


def event_records(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, "events", EVENT_RECORDS_SQL)


def order_models(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, "orders", ORDER_MODELS_SQL)


def named_event_models(spark: SparkSession, folder: str) -> DataFrame:
    """Event models with the descriptive columns of a registry row."""
    return event_models(spark, folder).select(
        "*",
        F.concat(F.lit("model-"), F.col("version").cast("string")).alias("name"),
        F.lit("weight delivered by a signup").alias("description"),
        F.lit("PMML").alias("modeltype"),
    )


# --- orders as model messages ----------------------------------------------------------------
#
# The order priority decides what is delivered:
#   1-URGENT         linear regression document
#   2-HIGH           generalized linear document with log link
#   3-MEDIUM         dense layers: class 1 when alcohol exceeds a threshold, else class 0
#   4-NOT SPECIFIED  a document cut short
#   5-LOW            a location instead of content, or an unsupported type
_HEAD = (
    '<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3"><DataDictionary>'
    '<DataField name="quality" optype="continuous" dataType="double"/></DataDictionary>'
)
_TARGET = '<MiningSchema><MiningField name="quality" usageType="target"/></MiningSchema>'


def _attribute(value) -> str:
    return f"CAST({value} AS STRING)"


def _concat(parts: list[str]) -> str:
    return "concat(" + ", ".join(parts) + ")"


def _quoted(text: str) -> str:
    return "'" + text + "'"


def linear_document_sql(intercept: str, coefs: list[str]) -> str:
    """Spark SQL text of a linear regression document per row."""
    parts = [
        _quoted(f'{_HEAD}<RegressionModel functionName="regression">{_TARGET}<RegressionTable intercept="'),
        _attribute(intercept), _quoted('">'),
    ]
    for name, coef in zip(FEATURES, coefs):
        spaced = name.replace("_", " ")
        parts += [_quoted(f'<NumericPredictor name="{spaced}" coefficient="'), _attribute(coef), _quoted('"/>')]
    return _concat([*parts, _quoted("</RegressionTable></RegressionModel></PMML>")])


def glm_document_sql(intercept: str, coefs: list[str], link: str) -> str:
    cells = "".join(
        f'<PPCell value="1" predictorName="{name.replace("_", " ")}" parameterName="p{i}"/>'
        for i, name in enumerate(FEATURES, start=1)
    )
    parts = [
        _quoted(f'{_HEAD}<GeneralRegressionModel modelType="generalizedLinear" functionName="regression" '
                f'linkFunction="{link}">{_TARGET}<PPMatrix>{cells}</PPMatrix><ParamMatrix>'
                '<PCell parameterName="p0" beta="'),
        _attribute(intercept), _quoted('"/>'),
    ]
    for i, coef in enumerate(coefs, start=1):
        parts += [_quoted(f'<PCell parameterName="p{i}" beta="'), _attribute(coef), _quoted('"/>')]
    return _concat([*parts, _quoted("</ParamMatrix></GeneralRegressionModel></PMML>")])


ORDER_INTERCEPT = "(o_totalprice / 100000e0)"
GLM_INTERCEPT = "(o_totalprice / 1000000e0)"
DENSE_THRESHOLD = "(8.6e0 + CAST(o_custkey % 40 AS DOUBLE) / 10e0)"


def glm_coefficient_sql(i: int) -> str:
    return f"({coefficient_sql(i)} / 1000e0)"


def dense_document_sql() -> str:
    zeros = ",".join(["0.0"] * (len(FEATURES) - 1))
    return _concat(
        [
            _quoted('{"layers":[{"activation":"identity","normalization":"none","bias":['),
            _attribute(DENSE_THRESHOLD),
            _quoted(f',0.0],"weights":[[{zeros},0.0],[{zeros},1.0]]}}]}}'),
        ]
    )


def layers_document(activation: str, weights: str, biases: int) -> str:
    bias = ",".join(["0.0"] * biases)
    return f'{{"layers":[{{"activation":"{activation}","normalization":"none","bias":[{bias}],"weights":{weights}}}]}}'


_ROW = "[" + ",".join(["1.0"] * len(FEATURES)) + "]"
# Documents that read well and cannot score a record: an unknown activation, rows of unequal length,
# a layer for three inputs, a predictor that is not a number.
UNSCORABLE = [
    ("TENSORFLOW", layers_document("selu", f"[{_ROW},{_ROW}]", 2)),
    ("TENSORFLOW", layers_document("identity", f"[{_ROW},[1.0,2.0]]", 2)),
    ("TENSORFLOW", layers_document("identity", "[[1.0,2.0,3.0],[1.0,2.0,3.0]]", 2)),
    ("PMML", f'{_HEAD}<RegressionModel functionName="regression">{_TARGET}<RegressionTable intercept="1">'
             '<CategoricalPredictor name="alcohol" value="high" coefficient="50"/></RegressionTable>'
             "</RegressionModel></PMML>"),
]


def unscorable_descriptors(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as model messages of which none can score: the order key decides on the fault."""
    turn = "o_orderkey % 4"
    kind = f"CASE {turn} " + " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _) in enumerate(UNSCORABLE)) + " END"
    text = f"CASE {turn} " + " ".join(f"WHEN {i} THEN '{d}'" for i, (_, d) in enumerate(UNSCORABLE)) + " END"
    return _run(
        spark, folder, "orders",
        "SELECT o_orderkey AS version, o_orderdate AS valid_from, 'unscorable' AS name, o_orderpriority AS description, "
        f"o_orderstatus AS dataType, {kind} AS modeltype, CAST({text} AS BINARY) AS data, "
        "CAST(NULL AS STRING) AS location FROM orders",
    )


def order_descriptors(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as model messages: version, valid_from and the descriptor fields."""
    every = range(len(FEATURES))
    linear = linear_document_sql(ORDER_INTERCEPT, [coefficient_sql(i) for i in every])
    glm = glm_document_sql(GLM_INTERCEPT, [glm_coefficient_sql(i) for i in every], "log")
    text = (
        f"CASE o_orderpriority WHEN '1-URGENT' THEN {linear} WHEN '2-HIGH' THEN {glm} "
        f"WHEN '3-MEDIUM' THEN {dense_document_sql()} WHEN '4-NOT SPECIFIED' THEN substring({linear}, 1, 400) "
        "WHEN '5-LOW' THEN IF(o_totalprice > 250000, NULL, 'graph') END"
    )
    return _run(
        spark, folder, "orders",
        "SELECT o_orderkey AS version, o_orderdate AS valid_from, concat('order-', CAST(o_orderkey AS STRING)) AS name, "
        "o_orderpriority AS description, o_orderstatus AS dataType, "
        "CASE o_orderpriority WHEN '3-MEDIUM' THEN 'TENSORFLOW' WHEN '5-LOW' THEN 'TENSORFLOWSAVED' ELSE 'PMML' END "
        f"AS modeltype, CAST({text} AS BINARY) AS data, "
        "IF(o_orderpriority = '5-LOW' AND o_totalprice > 250000, concat('/models/', CAST(o_orderkey AS STRING)), NULL) "
        "AS location FROM orders",
    )
