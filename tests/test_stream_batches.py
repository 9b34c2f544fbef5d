"""Streams whose rows are keys and numbers do not add up a batch's bytes after every row."""

from tests.test_workspace import started
from tidescore.operators import dispatch
from tidescore.plans import stream_queries
from tidescore.session import BYTES_PER_BATCH
from tidescore.streaming import serve


def test_keyed_streams_cut_batches_by_rows(spark, folder, monkeypatch):
    seen, table, before = [], stream_queries.sinks.table, spark.conf.get(BYTES_PER_BATCH)
    monkeypatch.setattr(
        stream_queries.sinks, "table", lambda df, *a: seen.append(df.sparkSession.conf.get(BYTES_PER_BATCH)) or table(df, *a))
    rows = stream_queries.stream_keyed_score(spark, folder)
    assert rows.count() > 0 and seen == [str((1 << 31) - 1)]  # Spark's sign for no limit
    assert spark.conf.get(BYTES_PER_BATCH) == before


def test_a_server_scores_without_them(spark, monkeypatch):
    """Documents are read under the limit, keys and numbers are scored without; the session has it back."""
    seen, resolve, read = {}, dispatch.resolve_after, serve.decode_batch

    def note(name, df):
        seen.setdefault(name, set()).add(df.sparkSession.conf.get(BYTES_PER_BATCH))

    monkeypatch.setattr(dispatch, "resolve_after", lambda records, *a: note("scored", records) or resolve(records, *a))
    monkeypatch.setattr(serve, "decode_batch", lambda batch: note("decoded", batch) or read(batch))
    before = spark.conf.get(BYTES_PER_BATCH)
    target, running = started(spark, "by-rows", ["a"], 2, 60)
    running.awaitTermination()
    assert serve.read(spark, target, "scored").count() == 60
    assert seen == {"scored": {str((1 << 31) - 1)}, "decoded": {before}} and spark.conf.get(BYTES_PER_BATCH) == before
