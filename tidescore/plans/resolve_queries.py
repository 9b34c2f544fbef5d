"""Records meet models: as-of joins, statistics, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.functions.text import as_json
from tidescore.operators import resolve as R
from tidescore.operators import stats as S
from tidescore.plans import inputs, sqltext
from tidescore.plans.catalogue import query
from tidescore.schemas import FEATURES

KEYS = ", ".join(inputs.LINE_KEYS)


def weighted(df: DataFrame) -> DataFrame:
    return df.withColumn("result", F.round(F.col("weight") * F.col("value"), 6))


def resolved_events(spark: SparkSession, folder: str, unscored: str = "drop") -> DataFrame:
    return R.resolve(inputs.event_records(spark, folder), inputs.event_models(spark, folder), unscored)


def resolved_lines(spark: SparkSession, folder: str) -> DataFrame:
    return R.resolve(inputs.wine(spark, folder), inputs.order_models(spark, folder))


EVENT_SCORE = (
    f"WITH {sqltext.EVENT_ASOF} SELECT data_type, event_id, version, round(weight * value, 6) AS result "
    "FROM resolved WHERE version IS NOT NULL"
)


@query("asof_linear_score", EVENT_SCORE)
def asof_linear_score(spark, folder):
    return weighted(resolved_events(spark, folder)).select("data_type", "event_id", "version", "result")


@query("asof_window_form", EVENT_SCORE)
def asof_window_form(spark, folder):
    df = R.resolve_sorted(inputs.event_records(spark, folder), inputs.event_models(spark, folder))
    return weighted(df).select("data_type", "event_id", "version", "result")


NULL_TIMES = (
    f"WITH {sqltext.EVENT_ASOF.replace('ASOF LEFT JOIN models m', 'ASOF LEFT JOIN timed m')} SELECT data_type, event_id, "
    "version, round(weight * value, 6) AS result FROM resolved"
).replace(", resolved AS (", ", timed AS (SELECT * FROM models WHERE version % 3 <> 0), resolved AS (")


@query("asof_null_times", NULL_TIMES)
def asof_null_times(spark, folder):
    """A model without a time never applies."""
    models = inputs.event_models(spark, folder)
    models = models.withColumn("valid_from", F.when(F.col("version") % 3 != 0, F.col("valid_from")))
    df = R.resolve(inputs.event_records(spark, folder), models, "null")
    return weighted(df).select("data_type", "event_id", "version", "result")


@query(
    "asof_reserved_names",
    f"WITH {sqltext.EVENT_ASOF} SELECT event_id, version, event_id % 7 AS bucket, event_id % 5 AS width, "
    "event_id % 3 AS origin, event_id % 2 AS buckets, event_id % 11 AS chunk, event_id % 13 AS \"offset\" FROM resolved",
)
def asof_reserved_names(spark, folder):
    """Record columns keep their values whatever they are called."""
    names = {"bucket": 7, "width": 5, "origin": 3, "buckets": 2, "chunk": 11, "offset": 13}
    records = inputs.event_records(spark, folder).withColumns({n: F.col("event_id") % k for n, k in names.items()})
    return R.resolve(records, inputs.event_models(spark, folder), "null").select("event_id", "version", *names)


HOT_SCORE = (
    f"WITH {sqltext.ORDER_ASOF} SELECT {KEYS}, version, round({sqltext.ORDER_SCORE}, 6) AS result "
    "FROM resolved WHERE version IS NOT NULL"
)


def order_scored(df: DataFrame) -> DataFrame:
    total = F.col("intercept")
    for i, name in enumerate(FEATURES):
        total = total + F.col(f"c{i}") * F.col(name)
    return df.withColumn("result", F.round(total, 6))


@query("asof_hot_keys", HOT_SCORE)
def asof_hot_keys(spark, folder):
    """Two data types hold all records; each has thousands of models."""
    return order_scored(resolved_lines(spark, folder)).select(*inputs.LINE_KEYS, "version", "result")


@query("asof_hot_keys_sorted", HOT_SCORE)
def asof_hot_keys_sorted(spark, folder):
    # Columns that the answer does not use would be sorted, written and shuffled with the rest.
    records = inputs.wine(spark, folder).select(*inputs.LINE_KEYS, "data_type", "ts", *FEATURES)
    return order_scored(R.resolve_sorted(records, inputs.order_models(spark, folder))).select(*inputs.LINE_KEYS, "version", "result")


@query(
    "unscored_drop",
    f"WITH {sqltext.EVENT_ASOF} SELECT data_type, count(*) AS n FROM resolved WHERE version IS NOT NULL GROUP BY 1",
)
def unscored_drop(spark, folder):
    return resolved_events(spark, folder).groupBy("data_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "unscored_null",
    f"WITH {sqltext.EVENT_ASOF} SELECT data_type, event_id, version, round(weight * value, 6) AS result FROM resolved",
)
def unscored_null(spark, folder):
    return weighted(resolved_events(spark, folder, "null")).select("data_type", "event_id", "version", "result")


@query(
    "broadcast_latest_score",
    f"WITH {sqltext.EVENTS}, cur AS (SELECT * FROM models QUALIFY row_number() OVER "
    "(PARTITION BY data_type ORDER BY valid_from DESC, version DESC) = 1) "
    "SELECT r.data_type, r.event_id, c.version, round(c.weight * r.value, 6) AS result "
    "FROM records r JOIN cur c ON r.data_type = c.data_type",
)
def broadcast_latest_score(spark, folder):
    df = R.resolve_latest(inputs.event_records(spark, folder), inputs.event_models(spark, folder))
    return weighted(df).select("data_type", "event_id", "version", "result")


@query(
    "single_model_score",
    f"WITH {sqltext.EVENTS}, one AS (SELECT * FROM models ORDER BY valid_from DESC, version DESC LIMIT 1) "
    "SELECT r.event_id, one.version, round(one.weight * r.value, 6) AS result FROM records r, one",
)
def single_model_score(spark, folder):
    """One unkeyed model for every record: the newest delivery of all."""
    df = R.resolve_single(inputs.event_records(spark, folder), inputs.event_models(spark, folder))
    return weighted(df).select("event_id", "version", "result")


@query(
    "union_tagged",
    f"WITH {sqltext.EVENTS} SELECT data_type, true AS is_model, version AS id, weight AS amount FROM models "
    "UNION ALL SELECT data_type, false, event_id, value FROM records",
)
def union_tagged(spark, folder):
    both = R.tagged_union(inputs.event_records(spark, folder), inputs.event_models(spark, folder))
    return both.select(
        "data_type", "is_model",
        F.coalesce("model.version", "data.event_id").alias("id"),
        F.coalesce("model.weight", "data.value").alias("amount"),
    )


def _stats_sql(asof: str) -> str:
    return (
        f"WITH {asof} SELECT data_type, version, min(valid_from) AS since_arrival, min(ts) AS since_first_use, "
        "count(*) AS usage, CAST(sum(duration) AS BIGINT) AS duration, min(duration) AS min_duration, "
        "max(duration) AS max_duration, round(sum(duration) / CAST(count(*) AS DOUBLE), 6) AS avg_duration "
        "FROM resolved WHERE version IS NOT NULL GROUP BY data_type, version"
    )


def rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumn("avg_duration", F.round("avg_duration", 6))


@query("serving_stats", _stats_sql(sqltext.EVENT_ASOF))
def serving_stats(spark, folder):
    return rounded(S.serving_stats(resolved_events(spark, folder)))


@query("serving_stats_hot", _stats_sql(sqltext.ORDER_ASOF))
def serving_stats_hot(spark, folder):
    return rounded(S.serving_stats(resolved_lines(spark, folder)))


def _running_sql(asof: str, ids: str) -> str:
    w = f"OVER (PARTITION BY data_type, version ORDER BY ts, {ids} ROWS UNBOUNDED PRECEDING)"
    return (
        f"WITH {asof} SELECT data_type, version, ts, {ids}, count(*) {w} AS usage, "
        f"CAST(sum(duration) {w} AS BIGINT) AS duration, min(duration) {w} AS min_duration, "
        f"max(duration) {w} AS max_duration FROM resolved WHERE version IS NOT NULL"
    )


@query("running_stats", _running_sql(sqltext.EVENT_ASOF, "event_id"))
def running_stats(spark, folder):
    return S.running_stats(resolved_events(spark, folder), ["event_id"])


# The newest order of each status serves all its lines, so a version's group is as large as can be.
LATEST_LINES = (
    f"{sqltext.WINE}, all_models AS ({inputs.ORDER_MODELS_SQL}), cur AS (SELECT * FROM all_models QUALIFY "
    "row_number() OVER (PARTITION BY data_type ORDER BY valid_from DESC, version DESC) = 1), "
    "resolved AS (SELECT w.*, c.version FROM wine w JOIN cur c ON w.data_type = c.data_type)"
)


@query("running_stats_hot", _running_sql(LATEST_LINES, KEYS))
def running_stats_hot(spark, folder):
    models = inputs.order_models(spark, folder).select("data_type", "version", "valid_from")
    scored = R.resolve_latest(inputs.wine(spark, folder), models)
    return S.running_stats(scored, inputs.LINE_KEYS)


CURRENT = (
    f"{sqltext.EVENT_ASOF}, used AS (SELECT data_type, version, min(valid_from) AS since_arrival, count(*) AS usage, "
    "CAST(sum(duration) AS BIGINT) AS duration, min(duration) AS lo, max(duration) AS hi FROM resolved "
    "WHERE version IS NOT NULL GROUP BY 1, 2), newest AS (SELECT * FROM used QUALIFY row_number() OVER "
    "(PARTITION BY data_type ORDER BY since_arrival DESC, version DESC) = 1), "
    "types AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS data_type FROM events)"
)


@query(
    "current_stats",
    f"WITH {CURRENT} SELECT t.data_type, n.version, "
    "CASE WHEN n.version IS NULL THEN 'None' ELSE 'model-' || n.version END AS name, "
    "CASE WHEN n.version IS NULL THEN 'None' ELSE 'weight delivered by a signup' END AS description, "
    "CASE WHEN n.version IS NULL THEN 'None' ELSE 'PMML' END AS modeltype, "
    "coalesce(epoch_us(n.since_arrival) // 1000, 0) AS since, coalesce(n.usage, 0) AS usage, "
    "CAST(coalesce(n.duration, 0) AS DOUBLE) AS duration, coalesce(n.lo, 0) AS min_duration, "
    "coalesce(n.hi, 0) AS max_duration FROM types t LEFT JOIN newest n ON t.data_type = n.data_type",
)
def current_stats(spark, folder):
    types = inputs.table(spark, folder, "events").select(F.col("user_id").cast("string").alias("data_type"))
    stats = S.serving_stats(resolved_events(spark, folder))
    return S.current_stats(types, stats, inputs.named_event_models(spark, folder))


def _report(spark, folder) -> DataFrame:
    described = S.describe_stats(
        S.serving_stats(resolved_events(spark, folder)), inputs.named_event_models(spark, folder)
    )
    return S.stats_report(described)


@query(
    "stats_report",
    f"WITH {CURRENT} SELECT 'model-' || version AS name, 'weight delivered by a signup' AS description, "
    "strftime(since_arrival, '%Y/%m/%d %H:%M:%S') AS since, usage, "
    'round(duration / CAST(usage AS DOUBLE), 6) AS average, lo AS "min", hi AS "max" FROM used',
)
def stats_report(spark, folder):
    return _report(spark, folder).withColumn("average", F.round("average", 6))


@query(
    "stats_json",
    f"WITH {CURRENT} SELECT 'model-' || version AS name, 'weight delivered by a signup' AS description, "
    "strftime(since_arrival, '%Y/%m/%d %H:%M:%S') AS since, usage, "
    'round(duration / CAST(usage AS DOUBLE), 6) AS average, lo AS "min", hi AS "max" FROM used',
)
def stats_json(spark, folder):
    """The report as JSON text, read back field by field."""
    report = _report(spark, folder)
    lines = as_json(report)
    fields = lines.select(F.from_json(lines.columns[0], report.schema).alias("r")).select("r.*")
    return fields.withColumn("average", F.round("average", 6))
