import collections
import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidescore.llm import substring_dedup as D
from tidescore.llm.queries import QUERIES, table


def by_hand(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("window, vocabulary", [(35, 400), (35, 3), (12, 30), (9, 8), (4, 6)])
def test_random_passages(spark, window, vocabulary):
    rng = random.Random(window * vocabulary)
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [rng.choices(words, k=rng.randint(window - 2, 3 * window)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choices(words, k=rng.randint(0, 2 * window)) if rng.random() < 0.6 else rng.choice(passages) for _ in range(rng.randint(0, 5))]
        texts.append(rng.choice([" ", "\n", " \t "]).join(" ".join(p) for p in parts))
    texts += [texts[0], None, "", "   ", "same " * (window - 1), "same " * (3 * window), "x", "é\x85ü \u2003 z\x0by\x0cx"]
    rows = [(i, t, "a", 5, "b") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_words int, key string")
    got = D.remove_duplicates(frame, window=window)
    assert set(frame.columns) <= set(got.columns)
    want = by_hand(texts, window)
    for r in got.collect():
        assert (r.n_words, r.n_removed, r.text) == want[r.doc_id], r.doc_id
        assert sum(s.high - s.low for s in r.spans) == r.n_removed and all(s.high - s.low >= window for s in r.spans)


def test_repeated_rows_null_ids_long_texts_and_empty_tables(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    long = " ".join(f"u{i}" for i in range(30_000))
    rows = [(1, passage), (1, passage), (None, f"a {passage} b"), (2, long), (None, None), (3, " ".join(f"q{i}" for i in range(40)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed) for r in D.remove_duplicates(frame).collect())
    assert got == collections.Counter([(1, 40, 40), (1, 40, 40), (None, 42, 40), (2, 30_000, 0), (None, 0, 0), (3, 40, 0)])
    assert D.remove_duplicates(frame.limit(0)).count() == 0


def test_thousands_of_equal_rows(spark):
    """Work grows with the rows, not with their square; every copy loses the same words."""
    text = " ".join(f"w{i}" for i in range(300))
    rows = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    start = time.monotonic()
    got = D.remove_duplicates(rows).groupBy("doc_id", "n_words", "n_removed", "text").count().collect()
    assert [tuple(r) for r in got] == [(7, 300, 300, "", 5000)] and time.monotonic() - start < 60


def test_false_hits_of_a_full_bitmap_change_nothing(spark, monkeypatch):
    texts = [" ".join(f"w{(i * 7 + j) % 90}" for j in range(80)) for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(D, "bitmap", lambda anchors: np.full(1 << D.BITMAP_BITS - 6, 2**64 - 1, np.uint64))
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in D.remove_duplicates(frame).collect()}
    assert [got[i] for i in range(40)] == by_hand(texts, 35)


def test_query_on_whole_tables(spark, folder):
    docs = table(spark, folder, "documents").orderBy("doc_id").collect()
    want = by_hand([d.text for d in docs], 35)
    got = {r.doc_id: r for r in QUERIES["op2_substring_dedup"](spark, folder).collect()}
    assert len(got) == len(docs)
    for d, (n, gone, kept) in zip(docs, want):
        r = got[d.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


def test_leftmost_minimum():
    values = np.random.default_rng(0).integers(0, 9, 300).astype(np.uint64)
    for width in (1, 2, 3, 7, 28):
        assert D.leftmost_minimum(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(301 - width)]
