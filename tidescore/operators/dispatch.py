"""Records scored by whichever version applies to them, versions of any kind."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidescore.functions.features import bind_fields
from tidescore.functions.maths import inverse_link_by_name
from tidescore.operators.batch_scoring import INVERSE_LINKS, batch_scorer
from tidescore.operators.kinds import registered
from tidescore.operators.resolve import newest_per_instant, resolve_after
from tidescore.schemas import FEATURES, MODEL_FIELD_NAMES
from tidescore.session import checked_broadcast, fits_broadcast, measured_bytes, scratch_table, side_by_side

ROWS_PER_GROUP = 100_000
ROWS_PER_CLOCK = 1024  # rows that are scored between two looks at the clock
MODEL_BYTES_PER_GROUP = 32 * 1024 * 1024


def version_key(columns: Sequence[str]) -> Column:
    """What names a model: its data type and its version, as far as the table has both."""
    kind = [F.coalesce(F.col("data_type"), F.lit(""))] if "data_type" in columns else []
    return F.when(F.col("version").isNotNull(), F.concat_ws("|", F.col("version").cast("string"), *kind))


def is_sum(params: Column) -> Column:
    """Whether a model is a weighted sum with a link: scored as columns whatever else is in the registry."""
    return params["kind"].isin("linear", "glm") & (F.size(F.coalesce(params["terms"], F.array())) == 0)


def score_with_versions(records: DataFrame, versions: DataFrame, unscored: str = "drop",
                        columns: Sequence[str] = FEATURES, snapshot: DataFrame | None = None,
                        duration: str | None = None) -> DataFrame:
    """Resolve each record's version and score it. Adds `version, valid_from, result`.

    Coefficients of sums ride along with the version and their score is JVM arithmetic. Models of
    other kinds are looked up by data type and version in Arrow batches. `snapshot` holds the
    models in force before `versions` arrived, one row per data type.

    With `duration`, a column of that name holds the milliseconds a record's scoring took: its share of
    the time of its slice of a batch (sums; of its slice's rows of its version, other kinds). Sums are
    then scored in Arrow batches too.
    """
    def light(table: DataFrame) -> DataFrame:
        p = F.col("params")
        plain = is_sum(p)
        return table.select(
            "data_type", "version", "valid_from", plain.alias("_sum"), F.when(plain, p["intercept"]).alias("_b"),
            F.when(plain, p["coefs"]).alias("_w"), F.when(plain, p["link"]).alias("_l"))

    every = versions if snapshot is None else versions.unionByName(snapshot.select(*versions.columns))
    resolved, others = side_by_side(
        records.sparkSession,
        lambda: resolve_after(records, None if snapshot is None else light(snapshot), light(versions), unscored),
        lambda: _other_kinds(every))
    if duration:
        pair = _timed_sum(columns, records.columns)
        scored = resolved.withColumn("_pair", pair).withColumns(
            {"_value": F.col("_pair.value"), "_spent": F.col("_pair.spent")}).drop("_pair", "_b", "_w", "_l")
    else:
        eta = F.col("_b")
        for i, x in enumerate(bind_fields(columns, records.columns)):
            eta = eta + F.col("_w")[i] * x
        scored = resolved.withColumn("_value", inverse_link_by_name(eta, F.col("_l"))).drop("_b", "_w", "_l")
    keep = [*records.columns, *[c for c in ("version", "valid_from") if c not in records.columns]]
    took = [F.when(F.col("_sum"), F.col("_spent")).alias(duration)] if duration else []
    if others is None:
        return scored.select(*keep, F.col("_value").alias("result"), *took)
    key = F.when(~F.col("_sum"), version_key(scored.columns))
    rest = _score_with(scored, key, *others, columns, timed=duration is not None)
    took = [F.when(F.col("_sum"), F.col("_spent")).otherwise(F.col("_took")).alias(duration)] if duration else []
    return rest.select(*keep, F.when(F.col("_sum"), F.col("_value")).otherwise(F.col("result")).alias("result"), *took)


def _other_kinds(every: DataFrame) -> tuple[DataFrame, Broadcast | None] | None:
    """The models that are no sums and can apply, by key, and what the workers get of them; None if there are none."""
    others = every.where(~is_sum(F.col("params")))
    # Versions replaced at the instant they arrived never apply and need not travel.
    times = newest_per_instant(every.select("data_type", "version", "valid_from").distinct())
    others = others.join(times.select("data_type", "version"), ["data_type", "version"], "left_semi")
    # Written once: they are measured, and then sent to the workers or joined.
    models = scratch_table(_keyed_models(others), "others")
    shared = _shared_models(models)
    return None if shared is not None and not shared.value else (models, shared)


def _timed_sum(columns: Sequence[str], available: Sequence[str]) -> Column:
    """Struct (value, spent) of rows with the coefficients of a sum in `_b`, `_w` and `_l`; other rows have neither."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for b, w, link, *inputs in batches:
            value, spent = np.full(len(b), np.nan), np.full(len(b), np.nan)
            known = b.is_valid().to_numpy(zero_copy_only=False)
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in inputs])
            for low in range(0, len(b), ROWS_PER_CLOCK):
                start = time.perf_counter()
                rows = low + np.flatnonzero(known[low : low + ROWS_PER_CLOCK])
                if not len(rows):
                    continue
                chosen = pa.array(rows)
                weights = w.take(chosen).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
                eta = b.take(chosen).to_numpy(zero_copy_only=False).copy()
                for i in range(weights.shape[1]):
                    eta += weights[:, i] * x[rows, i]
                links = np.array([k or "identity" for k in link.take(chosen).to_pylist()], dtype=object)
                with np.errstate(all="ignore"):
                    for k in set(links):
                        value[rows[links == k]] = INVERSE_LINKS[k](eta[links == k])
                spent[rows] = (time.perf_counter() - start) * 1000.0 / len(rows)
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.float64(), mask=~known) for c in (value, spent)], ["value", "spent"])

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    kind = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("spent", T.DoubleType())])
    # Two runs of a clock differ, so the pair is made once for both of its fields.
    return F.arrow_udf(run, kind).asNondeterministic()("_b", "_w", "_l", *bind_fields(columns, available))


class VersionScorer:
    """Scores rows of many versions at once.

    Versions that are plain sums share one weight matrix, so a batch with thousands of them
    costs one gather; the other kinds are scored version by version.
    """

    def __init__(self, params_of, known: dict | None = None) -> None:
        self.params_of = params_of
        self.known = known  # added kinds
        self.place: dict[str, int] = {}
        self.sums: list[list[float]] = []
        self.links: list[str] = []
        self.scorers: dict[str, object] = {}

    def _learn(self, key: str) -> None:
        params = self.params_of(key)
        if params["kind"] in ("linear", "glm") and not params["terms"]:
            self.place[key] = len(self.sums)
            self.sums.append([params["intercept"], *params["coefs"]])
            self.links.append(params["link"] or "identity")
        else:
            self.place[key] = -1
            self.scorers[key] = batch_scorer(params, self.known)

    def __call__(self, keys: pd.Series, x: np.ndarray) -> np.ndarray:
        inverse, found = pd.factorize(keys)
        for v in found:
            if v not in self.place:
                self._learn(v)
        places = np.array([self.place[v] for v in found], dtype=np.int64)
        row_place = places[inverse]
        out = np.full(len(x), np.nan)
        plain = np.flatnonzero(row_place >= 0)
        if len(plain):
            weights = np.array(self.sums)[row_place[plain]]
            eta = weights[:, 0].copy()
            for i in range(x.shape[1]):
                eta += weights[:, i + 1] * x[plain, i]
            links = np.array(self.links, dtype=object)[row_place[plain]]
            for link in set(links):
                chosen = links == link
                out[plain[chosen]] = INVERSE_LINKS[link](eta[chosen])
        other = np.flatnonzero(row_place < 0)
        order = other[np.argsort(inverse[other], kind="stable")]
        codes, starts = np.unique(inverse[order], return_index=True)
        for code, part in zip(codes, np.split(order, starts[1:])):
            out[part] = self.scorers[found[code]](x[part])
        return out

    def timed(self, keys: pd.Series, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and each row's share of the milliseconds its version took in its slice."""
        out, spent = np.full(len(x), np.nan), np.zeros(len(x))
        codes, found = pd.factorize(keys)
        for low in range(0, len(x), ROWS_PER_CLOCK):
            part = codes[low : low + ROWS_PER_CLOCK]
            order = np.argsort(part, kind="stable")
            for rows in np.split(low + order, np.flatnonzero(np.diff(part[order])) + 1):
                start = time.perf_counter()
                out[rows] = self._of_one(found[codes[rows[0]]], x[rows])
                spent[rows] = (time.perf_counter() - start) * 1000.0 / len(rows)
        return out, spent

    def _of_one(self, key: str, x: np.ndarray) -> np.ndarray:
        """Scores of rows of one version."""
        if key not in self.place:
            self._learn(key)
        place = self.place[key]
        if place < 0:
            return self.scorers[key](x)
        weights = self.sums[place]
        eta = np.full(len(x), weights[0], dtype=float)
        for i in range(x.shape[1]):
            eta += weights[i + 1] * x[:, i]
        return INVERSE_LINKS[self.links[place]](eta)


def _keyed_models(versions: DataFrame) -> DataFrame:
    return versions.select(version_key(versions.columns).alias("_key"), "params")


def score_resolved(resolved: DataFrame, versions: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with `data_type` and `version` -> rows with `result`, any mix of kinds."""
    key = version_key([c for c in resolved.columns if c != "data_type" or c in versions.columns])
    return _score_keyed(resolved, key, _keyed_models(versions), columns)


def _shared_models(models: DataFrame) -> Broadcast | None:
    """The parameters of `models` (_key, params) by key, for all workers; None if they are too many for that."""
    if not fits_broadcast(models):
        return None
    # The check above bounds what passes through the driver here.
    return models.sparkSession.sparkContext.broadcast({r["_key"]: r["params"].asDict(True) for r in models.collect()})


def _score_keyed(rows: DataFrame, key: Column, models: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _score_with(rows, key, models, _shared_models(models), columns)


def _score_with(rows: DataFrame, key: Column, models: DataFrame, shared: Broadcast | None, columns: Sequence[str],
                timed: bool = False) -> DataFrame:
    """Adds `result` where `key` names one of `models` (_key, params); null where it is null. `timed` adds `_took`."""
    if shared is None:
        return _score_cogrouped(rows, key, models, columns, timed)
    known_kinds = registered()

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        scorer = VersionScorer(lambda v: shared.value[v], known_kinds)
        for keys, *inputs in batches:
            out, took = np.full(len(keys), np.nan), np.full(len(keys), np.nan)
            known = np.flatnonzero(keys.notna().to_numpy())
            x = np.column_stack([c.to_numpy(dtype=float) for c in inputs])
            with np.errstate(all="ignore"):
                if timed:
                    out[known], took[known] = scorer.timed(keys.iloc[known], x[known])
                else:
                    out[known] = scorer(keys.iloc[known], x[known])
            yield pd.DataFrame({"value": out, "took": took})

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    # A null from pandas is a NaN score; rows without a key are the only ones without a value.
    pair = F.pandas_udf(run, "value double, took double").asNondeterministic()(key, *bind_fields(columns, rows.columns))
    took = [F.when(F.col("_key").isNotNull(), F.col("_r.took")).alias("_took")] if timed else []
    return rows.withColumn("_key", key).withColumn("_r", pair).select(
        *rows.columns, F.when(F.col("_key").isNotNull(), F.coalesce("_r.value", F.lit(float("nan")))).alias("result"), *took
    )


def score_cogrouped(resolved: DataFrame, models: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """The same where the models are too large to send everywhere: each meets its records by shuffle."""
    key = version_key([c for c in resolved.columns if c != "data_type" or c in models.columns])
    return _score_cogrouped(resolved, key, _keyed_models(models), columns)


def _score_cogrouped(rows: DataFrame, key: Column, models: DataFrame, columns: Sequence[str], timed: bool = False) -> DataFrame:
    """Keys are hashed into buckets whose number follows the rows and the model bytes. A bucket with
    many records, because one of its models is hot, is salted into groups of about ROWS_PER_GROUP
    rows, and only its model rows are repeated.

    The records are shuffled once, with each input once; what is known of their keys and the models they use are written once.
    """
    keep = rows.columns
    keyed = rows.withColumn("_key", key)
    x, inputs = _carried_inputs(rows, columns)
    scored = keyed.where(F.col("_key").isNotNull())
    keys = scratch_table(scored.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")), "used-keys")
    used = scratch_table(models.join(checked_broadcast(keys.select("_key")), "_key", "left_semi"), "used-models")
    total = keys.agg(F.sum("_rows").alias("n")).first().n or 0
    count = max(1, total // ROWS_PER_GROUP, measured_bytes(used) // MODEL_BYTES_PER_GROUP)
    bucket = F.pmod(F.xxhash64("_key"), F.lit(count))
    salts = keys.groupBy(bucket.alias("_bucket")).agg(F.ceil(F.sum("_rows") / ROWS_PER_GROUP).alias("_salts"))
    # Else Spark shuffles the records once more, before it sees how small this is.
    salts = checked_broadcast(salts)
    left = (
        scored.select("*", *x, bucket.alias("_bucket"))
        .join(salts, "_bucket")
        .withColumn("_salt", F.pmod(F.xxhash64(*keep), F.col("_salts")))
        .drop("_salts")
    )
    right = used.withColumn("_bucket", bucket).join(salts, "_bucket").select(
        "_bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_salt"), "_key", "params"
    )
    known_kinds = registered()
    added = ["result", "_took"] if timed else ["result"]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in added]])

    def run(rows: pa.Table, model: pa.Table) -> pa.Table:
        values = [np.zeros(0)] * len(added)
        if rows.num_rows:
            known = dict(zip(model["_key"].to_pylist(), model["params"].to_pylist()))
            scorer = VersionScorer(known.__getitem__, known_kinds)
            # A null reads as 0.0, a NaN stays one.
            x = np.column_stack([rows[n].fill_null(0.0).to_numpy() if n else np.zeros(rows.num_rows) for n in inputs])
            names = rows["_key"].to_pandas()
            with np.errstate(all="ignore"):
                values = scorer.timed(names, x) if timed else [scorer(names, x)]
        return pa.Table.from_arrays([*[rows[c] for c in keep], *[pa.array(v, pa.float64()) for v in values]], [*keep, *added])

    keys = ["_bucket", "_salt"]
    done = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)
    rest = keyed.where(F.col("_key").isNull()).select(*keep, *[F.lit(None).cast("double").alias(n) for n in added])
    return done.unionByName(rest)


def _carried_inputs(rows: DataFrame, columns: Sequence[str]) -> tuple[list[Column], list[str | None]]:
    """Columns to add for the inputs that are not doubles of `rows` already, and each input's column; None reads as 0.0."""
    added, names = [], []
    for i, (field, bound) in enumerate(zip(columns, bind_fields(columns, rows.columns))):
        field = MODEL_FIELD_NAMES.get(field, field)
        if field not in rows.columns:
            names.append(None)
        elif isinstance(rows.schema[field].dataType, T.DoubleType):
            names.append(field)
        else:
            added.append(bound.alias(f"_x{i}"))
            names.append(f"_x{i}")
    return added, names
