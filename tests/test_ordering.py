"""Numbers within keys against a plain loop, with a key that spans several chunks."""

from pyspark.sql import functions as F

from tidescore.operators.ordering import ordered_chunks, with_key_index


def test_key_index_of_a_hot_key(spark):
    # One key has nine of ten rows, one is missing, one is a single row.
    kind = F.when(F.col("id") == 77, "one").when(F.col("id") % 20 == 0, F.lit(None)).when(F.col("id") % 20 == 1, "few").otherwise("hot")
    rows = spark.range(400).select(kind.alias("kind"), (F.col("id") * 7919 % 401).alias("version"), "id").repartition(5)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        hot = ordered_chunks(rows, [F.col("kind"), F.col("version")], "index").where("kind = 'hot'")
        assert hot.select("_chunk").distinct().count() > 1
        got = with_key_index(rows, ["kind"], [F.col("version")], "nth").collect()
    finally:
        spark.conf.set(key, before)
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.kind, []).append((r.version, r.id))
    want = {i: nth for group in groups.values() for nth, (_, i) in enumerate(sorted(group))}
    assert {r.id: r.nth for r in got} == want
    assert len(got) == 400
