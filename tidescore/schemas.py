"""Column names, schemas and defaults shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# The eleven record fields in message order (tags 1..11).
FEATURES = [
    "fixed_acidity",
    "volatile_acidity",
    "citric_acid",
    "residual_sugar",
    "chlorides",
    "free_sulfur_dioxide",
    "total_sulfur_dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
]

# Names used inside model documents and CSV headers -> record fields.
MODEL_FIELD_NAMES = {name.replace("_", " "): name for name in FEATURES}
FEATURE_INDEX = {name: i for i, name in enumerate(FEATURES)}

RECORD_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in FEATURES]
    + [T.StructField("dataType", T.StringType())]
)

# Model type numbers of the descriptor message.
MODEL_TYPES = {"TENSORFLOW": 0, "TENSORFLOWSAVED": 1, "PMML": 2}
SCORABLE_TYPES = ("PMML", "TENSORFLOW")

DESCRIPTOR_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("dataType", T.StringType()),
        T.StructField("modeltype", T.StringType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("location", T.StringType()),
    ]
)

# A model as data. One struct covers every kind; unused parts stay null.
#   linear   coefs over the eleven fields, link applied to the sum
#   terms    product terms beta * prod(x^e), for models that are not plain sums
#   trees    flat node table; feature -1 marks a leaf
#   layers   dense layers, weights[out][in]
NODE_TYPE = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("probs", T.ArrayType(T.DoubleType())),
    ]
)
TERM_TYPE = T.StructType(
    [
        T.StructField("beta", T.DoubleType()),
        T.StructField("exponents", T.ArrayType(T.DoubleType())),
    ]
)
LAYER_TYPE = T.StructType(
    [
        T.StructField("activation", T.StringType()),
        T.StructField("normalization", T.StringType()),
        T.StructField("bias", T.ArrayType(T.DoubleType())),
        T.StructField("weights", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ]
)
PARAMS_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("coefs", T.ArrayType(T.DoubleType())),
        T.StructField("link", T.StringType()),
        T.StructField("terms", T.ArrayType(TERM_TYPE)),
        T.StructField("nodes", T.ArrayType(NODE_TYPE)),
        T.StructField("layers", T.ArrayType(LAYER_TYPE)),
        T.StructField("inputs", T.ArrayType(T.IntegerType())),
        T.StructField("labels", T.ArrayType(T.StringType())),
    ]
)

MODEL_VERSION_SCHEMA = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("modeltype", T.StringType()),
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("params", PARAMS_TYPE),
    ]
)

# The statistics row shown when nothing has been served yet.
EMPTY_STATS = {
    "name": "None",
    "description": "None",
    "modeltype": "None",
    "since": 0,
    "usage": 0,
    "duration": 0.0,
    "min_duration": 0,
    "max_duration": 0,
}
LONG_MAX = 9223372036854775807
LONG_MIN = -9223372036854775808
