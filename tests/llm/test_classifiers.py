import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidescore.llm import quality, toxicity
from tidescore.llm.labelled import fold_of, labelled_sample
from tidescore.llm.queries import QUERIES, table

CASES = [("op3_toxicity", "toxic", 5, 0), ("op10_quality", "quality", 3, 1)]


@pytest.mark.parametrize("name, label, folds, held", CASES)
def test_held_out_accuracy(spark, name, label, folds, held):
    folder = "/root/testdata/sf0.1"
    got = QUERIES[name](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == table(spark, folder, "documents").count()
    right, n, most = 0, 0, 0
    for r in table(spark, folder, "labels").collect():
        assert rows[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        if rows[r.doc_id].held_out:
            right, n, most = right + (rows[r.doc_id].predicted == r[label]), n + 1, most + r[label]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    assert right / n > 0.95 and right / n > max(most, n - most) / n + 0.04


@pytest.mark.parametrize("module, label, better", [(toxicity, "toxic", 0), (quality, "quality", 1)])
def test_odd_rows(spark, module, label, better):
    texts = [f"plain words number {i} here" for i in range(30)] + [f"HORRID!! HORRID!! {i}" for i in range(30)]
    docs = [(i, t, 0.1, "x", "y") for i, t in enumerate(texts)]
    docs += [(100, None, None, None, None), (101, "", 1.0, "", ""), (None, "plain", 1.0, "", ""), (3, texts[3], 0.1, "x", "y"),
             (102, "plain words " * 30_000, 1.0, "", "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double, predicted string, row string")
    marks = [(i, int(i < 30) if better else int(i >= 30), 0) for i in range(60)] + [(None, 1, 1), (5, None, 1), (999, 1, 1)]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int, text int")
    got = module.classify(frame, labels)
    rows = got.collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    kept = (module.keep_good if better else module.drop_toxic)(frame, labels)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r.predicted == better for r in rows)
    assert got.where("doc_id = 3").select("score").distinct().count() == 1

    # Nothing learnt rejects nothing.
    assert (module.keep_good if better else module.drop_toxic)(frame, labels.limit(0)).count() == len(docs)
    assert module.classify(frame.limit(0), labels).count() == 0


def test_folds_never_teach(spark):
    """Turning the held-out labels round changes no score."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    for module, label, folds, held in ((toxicity, "toxic", 5, 0), (quality, "quality", 3, 1)):
        turned = labels.withColumn(label, F.when(fold_of(F.col("doc_id"), folds) == held, 1 - F.col(label)).otherwise(F.col(label)))
        scores = [{r.doc_id: r.score for r in module.classify(docs, x).collect()} for x in (labels, turned)]
        assert scores[0] == scores[1]


def test_votes_against_brute_force():
    rng = np.random.default_rng(0)
    texts = ["abc abd", "", "ZZZ!! ZZZ!!", "12 34 56", "a b a b"]
    space = np.linalg.qr(rng.standard_normal((quality.TERMS, 8)))[0].astype(np.float32)
    vectors = quality.unit(rng.standard_normal((40, 8))).astype(np.float32)
    model = quality.Model(np.ones(quality.TERMS, np.float32), space, vectors, (rng.random(40) > 0.5).astype(np.float32))
    got = quality.votes(model, texts, 5, 2.0)
    for text, value in zip(texts, got):
        x = quality.unit(quality.weighted(quality.counts_of([text]), model.idf) @ space)[0]
        near = vectors @ x
        best = np.argsort(-near)[:5]
        weight = np.maximum(near[best], 1e-6).astype(float) ** 2
        assert value == pytest.approx((weight * model.labels[best]).sum() / weight.sum(), rel=1e-4)


def test_grams_are_distinct():
    grams = toxicity.Grams()
    found = grams("abcdefgh abcdefgh ABCDEFGH")
    assert len(found) == len(set(found.tolist())) and set(found.tolist()) == set(grams("abcdefgh ABCDEFGH abcdefgh").tolist())


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs = [(i, f"text {i}") for i in range(40)] + [(7, f"again {i}") for i in range(400)] + [(8, None)] * 50
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = [labelled_sample(frame.repartition(n), labels, "toxic", F.lit(True), 40, "doc_id", "text").collect() for n in (1, 5)]
    assert sorted(r.doc for r in got[0]) == list(range(40))
    assert {(r.doc, r.text, r.label) for r in got[0]} == {(r.doc, r.text, r.label) for r in got[1]}
    assert all((r.doc, r.text) in docs or (r.doc, r.text) == (8, "") for r in got[0])


def test_ties_go_to_the_first_neighbours():
    """Equal vectors in a sample: the nine first vote, whatever a partial sort would pick."""
    model = quality.Model(np.ones(quality.TERMS, np.float32), np.eye(quality.TERMS, 4, dtype=np.float32),
                          np.tile(np.float32([1, 0, 0, 0]), (3000, 1)), (np.arange(3000) >= 9).astype(np.float32))
    near = np.ones((3, 3000), np.float32)
    near[1, 2000:2004], near[2, 5] = 2, 0
    at = np.sort(quality.nearest(near, 9), axis=1)
    assert at[0].tolist() == list(range(9)) and at[1].tolist() == [*range(5), *range(2000, 2004)]
    assert at[2].tolist() == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    assert quality.nearest(near[:, :4], 9).tolist() == [[0, 1, 2, 3]] * 3
    values = np.random.default_rng(3).integers(0, 6, (200, 50)).astype(np.float32)
    for row, found in zip(values, quality.nearest(values, 7)):
        assert sorted(found) == sorted(np.argsort(-row, kind="stable")[:7])
    assert model.labels[:9].sum() == 0


def test_toxicity_against_a_plain_fit(spark):
    """Counts, ratios and the regression in plain Python over gram strings: the same scores."""
    rng = np.random.default_rng(8)
    kind, rude = "calm plain kind words about rivers and bread".split(), "vile nasty scum idiot trash".split()
    texts = [" ".join(rng.choice(kind, 12)) + (" " + " ".join(rng.choice(rude, 3)) if i % 3 == 0 else "") for i in range(120)]
    y = np.array([i % 3 == 0 for i in range(120)], float)
    frame = spark.createDataFrame([(t, int(v)) for t, v in zip(texts, y)], "text string, label int")
    score = toxicity.scorer(toxicity.fit(frame))()
    probes = [*texts[:20], "", "you vile idiot", "bread and rivers"]

    grams = toxicity.Grams()
    sets = [set(grams(t).tolist()) for t in texts]
    many = {g: (sum(g in s for s, v in zip(sets, y) if not v), sum(g in s for s, v in zip(sets, y) if v)) for g in set().union(*sets)}
    ratio = {g: np.log((t + 1) / (y.sum() + 2)) - np.log((p + 1) / ((1 - y).sum() + 2)) for g, (p, t) in many.items() if p + t >= 6}
    ratio = {g: r for g, r in ratio.items() if abs(r) >= 1.75}
    weight, seen, bias, seen_bias = dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 1e-12), np.log(y.mean() / (1 - y.mean())), 1e-12
    for _ in range(100):
        error = [1 / (1 + np.exp(-(bias + sum(ratio[g] * weight[g] for g in s & ratio.keys())))) - v for s, v in zip(sets, y)]
        for g in ratio:
            slope = ratio[g] * sum(e for e, s in zip(error, sets) if g in s) / len(sets) + 1e-4 * weight[g]
            seen[g] += slope * slope
            weight[g] -= 0.1 * slope / np.sqrt(seen[g])
        seen_bias += np.mean(error) ** 2
        bias -= 0.1 * np.mean(error) / np.sqrt(seen_bias)
    plain = [1 / (1 + np.exp(-(bias + sum(ratio[g] * weight[g] for g in set(grams(t).tolist()) & ratio.keys())))) for t in probes]
    assert np.allclose(score(probes), plain, atol=1e-4) and plain[-2] > 0.5 > plain[-1]


def test_buckets_of_grams():
    """A text's buckets are those of its distinct byte grams."""
    def bucket(data):
        value = int.from_bytes(data, "little") | len(data) << 56
        return value * int(toxicity.MIX) % 2**64 >> 64 - toxicity.BITS

    for text in ("", "a", "Größe, größe!", "x" * 50):
        data = f" {text.lower()}      ".encode()
        want = {bucket(data[i : i + n]) for n in (5, 7) for i in range(len(data) - 6)}
        assert want <= set(toxicity.Grams()(text).tolist())
