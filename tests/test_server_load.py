"""Work of the server's batches: over all cores, and a version's rows scored without going round the others."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from tests.test_models import constant
from tidescore.operators.dispatch import VersionScorer
from tidescore.streaming import serve


def test_a_batch_of_one_file_is_dealt_over_the_cores(spark, tmp_path):
    """Models and records of a batch that came as one file are decoded by more than one task."""
    rows = [("mdata", bytearray(b"x"), datetime(2024, 1, 1), 0, i) for i in range(64)]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, serve.MESSAGE_SCHEMA).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(serve.MESSAGE_SCHEMA).parquet(source)
    writer = serve.serve(stream, target).option("checkpointLocation", str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    dead = serve.read(spark, target, "dead")
    assert dead.count() == 64 and len(dead.inputFiles()) > 1


def test_a_version_is_looked_up_once_a_slice():
    """Scoring with times goes to a version's own rows, without the way for mixed rows, and agrees with it."""
    known = {f"k{i}": constant(float(i)) for i in range(40)}
    keys = pd.Series([f"k{i % 40}" for i in range(4000)])
    x = np.zeros((4000, 11))
    mixed = VersionScorer(known.get)
    want = mixed(keys, x)
    scorer = VersionScorer(known.get)
    scorer.__class__ = type("Timed", (VersionScorer,), {"__call__": lambda self, *a: pytest.fail("the mixed way")})
    out, spent = scorer.timed(keys, x)
    assert out.tolist() == want.tolist() and (spent > 0).all()
