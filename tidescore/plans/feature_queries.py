"""Text sources, casts, vectors, replay, codec."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.functions import codec, features
from tidescore.operators import clean
from tidescore.plans import inputs, sqltext
from tidescore.plans.catalogue import query
from tidescore.schemas import FEATURES, MODEL_FIELD_NAMES, RECORD_SCHEMA
from tidescore.session import scratch_path
from tidescore.sources import delimited, replay

KEYS = ", ".join(inputs.LINE_KEYS)
WINE_FEATURES = ", ".join(FEATURES)


def text_rows(df: DataFrame) -> DataFrame:
    """Eleven features and quality as one `;` line, as in the headerless files."""
    return df.select(F.concat_ws(" ; ", *[F.col(c).cast("string") for c in [*FEATURES, "quality"]]).alias("value"))


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*inputs.LINE_KEYS, *[F.col(c).cast("string").alias(c) for c in [*FEATURES, "quality"]])


@query(
    "cast_features",
    f"WITH {sqltext.WINE} SELECT {KEYS}, {', '.join(f'round({c}, 6) AS {c}' for c in FEATURES)}, quality FROM wine",
)
def cast_features(spark, folder):
    text = as_text(inputs.wine(spark, folder))
    numbers = features.cast_label(features.cast_columns(text, FEATURES), "quality", "int")
    return numbers.select(*inputs.LINE_KEYS, *[F.round(c, 6).alias(c) for c in FEATURES], "quality")


@query(
    "cast_lenient",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, TRY_CAST(CASE WHEN l_returnflag = 'N' THEN 'n/a' "
    "ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE) AS value FROM lineitem",
)
def cast_lenient(spark, folder):
    """Text in a number becomes null where the lenient form is asked for."""
    df = inputs.table(spark, folder, "lineitem").select(
        *inputs.LINE_KEYS,
        F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_linenumber").cast("string")).alias("value"),
    )
    return features.cast_columns(df, ["value"], lenient=True)


_SPLIT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"] * 3


@query(
    "split_trim_slice",
    f"SELECT {KEYS}, " + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(_SPLIT[:11]))
    + f", CAST({_SPLIT[11]} AS DOUBLE) AS label FROM lineitem",
)
def split_trim_slice(spark, folder):
    line = F.concat_ws(" ;  ", *[F.col(c).cast("string") for c in _SPLIT])
    df = inputs.table(spark, folder, "lineitem").select(*inputs.LINE_KEYS, features.split_fields(line).alias("f"))
    first, label = features.features_and_label(F.col("f"))
    return df.select(
        *inputs.LINE_KEYS, *[first[i].cast("double").alias(f"f{i}") for i in range(11)], label.cast("double").alias("label")
    )


@query(
    "float_vector",
    f"WITH {sqltext.WINE} SELECT {KEYS}, "
    + ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS v{i}" for i, c in enumerate(FEATURES)) + " FROM wine",
)
def float_vector(spark, folder):
    df = inputs.wine(spark, folder).select(*inputs.LINE_KEYS, features.float_vector().alias("v"))
    return df.select(*inputs.LINE_KEYS, *[F.col("v")[i].cast("double").alias(f"v{i}") for i in range(len(FEATURES))])


@query(
    "bind_fields",
    f"WITH {sqltext.WINE} SELECT {KEYS}, "
    + ", ".join(f"{c} AS {c}" for c in reversed(FEATURES)) + ", 0e0 AS unknown FROM wine",
)
def bind_fields(spark, folder):
    """Model input names bind to record fields in the model's order; an unknown name reads as 0.0."""
    df = inputs.wine(spark, folder)
    names = [*reversed(list(MODEL_FIELD_NAMES)), "no such field"]
    bound = features.bind_fields(names, df.columns)
    aliases = [*reversed(FEATURES), "unknown"]
    return df.select(*inputs.LINE_KEYS, *[c.alias(a) for c, a in zip(bound, aliases)])


_ROUNDED = ", ".join(f"round({c}, 5) AS {c}" for c in FEATURES)


@query(
    "csv_roundtrip_dropmalformed",
    f"WITH {sqltext.WINE} SELECT {_ROUNDED}, quality FROM wine WHERE data_type = 'F'",
)
def csv_roundtrip_dropmalformed(spark, folder):
    """Finished lines are written whole, open lines lose their last column; the reader drops the latter."""
    path = scratch_path(spark, "csv")
    text = as_text(inputs.wine(spark, folder).where("data_type = 'F'")).drop(*inputs.LINE_KEYS)
    short = as_text(inputs.wine(spark, folder).where("data_type = 'O'")).drop(*inputs.LINE_KEYS, "quality")
    header = [c.replace("_", " ") for c in FEATURES]
    text.toDF(*header, "quality").write.option("header", True).option("sep", ";").mode("append").csv(path)
    short.toDF(*header).write.option("header", True).option("sep", ";").mode("append").csv(path)
    df = delimited.read_training_csv(spark, path).toDF(*FEATURES, "quality")
    numbers = features.cast_label(features.cast_columns(df, FEATURES), "quality", "int")
    return numbers.select(*[F.round(c, 5).alias(c) for c in FEATURES], "quality")


_FLOATS = ", ".join(f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 4) AS {c}" for c in FEATURES)


@query("failfast_lines", f"WITH {sqltext.WINE} SELECT {_FLOATS}, CAST(quality AS DOUBLE) AS label FROM wine")
def failfast_lines(spark, folder):
    path = scratch_path(spark, "lines")
    text_rows(inputs.wine(spark, folder)).write.text(path)
    df = delimited.read_lines(spark, path)
    return df.select(
        *[F.round(F.col("features")[i].cast("double"), 4).alias(c) for i, c in enumerate(FEATURES)],
        F.col("label").cast("double").alias("label"),
    )


@query("header_lines", f"WITH {sqltext.WINE} SELECT {_FLOATS}, CAST(quality AS DOUBLE) AS label FROM wine")
def header_lines(spark, folder):
    path = scratch_path(spark, "header")
    as_text(inputs.wine(spark, folder)).drop(*inputs.LINE_KEYS).write.option("header", True).option("sep", ";").csv(path)
    df = delimited.read_lines_with_header(spark, path)
    return df.select(
        *[F.round(F.col("features")[i].cast("double"), 4).alias(c) for i, c in enumerate(FEATURES)],
        F.col("label").cast("double").alias("label"),
    )


@query("read_records", f"WITH {sqltext.WINE} SELECT {_FLOATS}, 'wine' AS \"dataType\" FROM wine")
def read_records(spark, folder):
    path = scratch_path(spark, "records")
    text_rows(inputs.wine(spark, folder)).write.text(path)
    df = delimited.read_records(spark, path)
    return df.select(*[F.round(c, 4).alias(c) for c in FEATURES], "dataType")


@query(
    "protobuf_roundtrip",
    f"WITH {sqltext.WINE} SELECT {KEYS}, {WINE_FEATURES}, data_type AS \"dataType\" FROM wine",
)
def protobuf_roundtrip(spark, folder):
    df = inputs.wine(spark, folder).withColumnRenamed("data_type", "dataType")
    raw = df.select(*inputs.LINE_KEYS, codec.encode_record(F.struct(*RECORD_SCHEMA.names)).alias("value"))
    good, _ = clean.split_valid(clean.parse_records(raw))
    return good.drop("value")


@query(
    "protobuf_nan_roundtrip",
    f"WITH {sqltext.WINE} SELECT {KEYS}, duration % 3 = 0 AS unknown, CASE WHEN duration % 3 <> 0 THEN alcohol END AS alcohol "
    "FROM wine",
)
def protobuf_nan_roundtrip(spark, folder):
    """A NaN in a message stays one; only an absent field reads as zero."""
    df = inputs.wine(spark, folder).withColumnRenamed("data_type", "dataType")
    gaps = df.withColumn("alcohol", F.when(F.col("duration") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("alcohol")))
    raw = gaps.select(*inputs.LINE_KEYS, codec.encode_record(F.struct(*RECORD_SCHEMA.names)).alias("value"))
    good, _ = clean.split_valid(clean.parse_records(raw))
    unknown = F.isnan("alcohol")
    return good.select(*inputs.LINE_KEYS, unknown.alias("unknown"), F.when(~unknown, F.col("alcohol")).alias("alcohol"))


@query(
    "record_dead_letters",
    "SELECT CASE WHEN l_returnflag = 'N' THEN 'undecodable message: DecodeError' WHEN l_returnflag = 'A' "
    "THEN 'null message' ELSE 'good' END AS error, count(*) AS n FROM lineitem GROUP BY 1",
)
def record_dead_letters(spark, folder):
    """Some messages are cut short, some missing; an empty message would still be a valid record."""
    df = inputs.wine(spark, folder).withColumnRenamed("data_type", "dataType")
    raw = df.select("l_returnflag", codec.encode_record(F.struct(*RECORD_SCHEMA.names)).alias("value"))
    broken = raw.withColumn(
        "value",
        F.when(F.col("l_returnflag") == "N", F.substring("value", F.lit(1), F.length("value") - 1))
        .when(F.col("l_returnflag") == "R", F.col("value")),
    )
    parsed = clean.parse_records(broken)
    return parsed.groupBy(F.coalesce("error", F.lit("good")).alias("error")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "replay_sequence",
    "SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1 AS position FROM events",
)
def replay_sequence(spark, folder):
    df = inputs.table(spark, folder, "events").select("ts", "event_id")
    return replay.replay_table(df, ["ts", "event_id"]).select("event_id", "position")


@query(
    "replay_alternating_models",
    "WITH p AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS pair FROM part) "
    "SELECT 2 * pair AS position, p_partkey, 'pmml-' || p_name AS model FROM p "
    "UNION ALL SELECT 2 * pair + 1, p_partkey, 'tensor-' || p_name FROM p",
)
def replay_alternating_models(spark, folder):
    parts = inputs.table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("pmml-"), "p_name").alias("pmml"),
        F.concat(F.lit("tensor-"), "p_name").alias("tensor"),
    )
    return replay.alternating_models(parts, ["p_partkey"])
