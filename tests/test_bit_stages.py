"""The joins of a forest by bit vectors are compiled: no chain of them makes a method that the JVM leaves uncompiled."""

import contextlib
import io
import random
import re

from pyspark.sql import functions as F

from tests.test_bit_vectors import random_tree
from tidescore.operators import bit_vectors
from tidescore.schemas import FEATURES, PARAMS_TYPE
from tidescore.sources.pmml import empty_params

LIMIT = 8000


def test_joins_are_compiled_in_short_stages(spark):
    rng = random.Random(5)
    nodes = [row for t in range(10) for row in random_tree(rng, t, 32)]
    for row in nodes:
        if row["feature"] >= 0:
            row["feature"] = rng.randrange(len(FEATURES))
    versions = spark.createDataFrame([(1, {**empty_params("forest"), "nodes": nodes})], "version long, params " + PARAMS_TYPE.simpleString())
    records = spark.range(100).select("id", F.lit(1).cast("long").alias("version"), *[F.rand(i).alias(c) for i, c in enumerate(FEATURES)])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found, text = bit_vectors.leaf_numbers(records, versions), io.StringIO()
        with contextlib.redirect_stdout(text):
            found.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    stages = re.split(r"== Subtree \d+ / \d+ ", text.getvalue())[1:]
    own = [(int(re.match(r"\(maxMethodCodeSize:(\d+)", s).group(1)), re.search(r"\*(\(\d+\)) ", s).group(1), s) for s in stages]
    joins = [(size, len(re.findall(rf"\*{re.escape(number)} BroadcastHashJoin", s.split("Generated code")[0]))) for size, number, s in own]
    joins = [(size, n) for size, n in joins if n]
    assert sum(n for _, n in joins) >= len(FEATURES)
    # All but the first, which has the records' own columns too.
    assert sum(size <= LIMIT for size, _ in joins) >= 5 and sum(size > LIMIT for size, _ in joins) <= 1
    assert found.rdd.getNumPartitions() == records.rdd.getNumPartitions() > 1  # nothing is put together
