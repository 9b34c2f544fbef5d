"""The pipeline's stages on whole small tables, each against a plain version on the same input."""

import pytest

import corpus_pipeline
from tests.llm.test_simhash import plain_components, plain_print
from tests.llm.test_substring_dedup import by_hand
from tests.llm.test_tokens import check_packing
from tidescore.llm import quality, toxicity
from tidescore.llm.queries import table


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs, out = table(spark, folder, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder).cache()
        out.append((docs, after))
        docs = after
    return out


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_classifiers_take_effect(spark, folder, stages):
    for (before, after), (module, label, keep) in zip(stages, ((quality, "quality", 1), (toxicity, "toxic", 0))):
        predicted = {r.doc_id: r.predicted for r in module.classify(before, table(spark, folder, "labels")).collect()}
        assert after.columns == before.columns
        assert set(rows(after)) == {d for d, p in predicted.items() if p == keep}


def test_one_document_of_each_group_stays(stages):
    before, after = stages[2]
    docs = sorted(rows(before).values())
    prints = [plain_print(d.text, 3) for d in docs]
    assert set(rows(after)) == set(plain_components([d.doc_id for d in docs], prints, 3))
    assert after.columns == before.columns


def test_passages_go(stages):
    before, after = stages[3]
    docs = sorted(rows(before).values())
    got = rows(after)
    for d, (_, _, kept) in zip(docs, by_hand([d.text for d in docs], 35)):
        assert got[d.doc_id].text == kept and got[d.doc_id].n_chars == len(kept)
        assert (got[d.doc_id].lang, got[d.doc_id].source) == (d.lang, d.source)


def test_packed(stages):
    before, after = stages[4]
    docs = sorted(rows(before).values())
    place = {d.doc_id: i for i, d in enumerate(docs)}
    found = [type(r)(**(r.asDict() | {"doc_id": place[r.doc_id]})) for r in after.collect()]
    used, least = check_packing(found, [d.text for d in docs], 1024)
    assert used <= least + 3


def test_run_gives_the_last_stage(spark, folder, stages):
    columns = [c for c in stages[-1][1].columns if c not in ("sequence_id", "offset")]
    got = corpus_pipeline.run(spark, folder).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1][1].select(columns).collect()))


def test_odd_rows_through_all_stages(spark, folder, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, a clashing column; and an empty table."""
    few = table(spark, folder, "documents").limit(60).collect()
    odd = [(None, None, None, None, None), (None, "word", None, None, 4), (-1, "", "en", "s", 0), (-2, None, "en", "s", None),
           (-3, "long words " * 40_000, "en", "s", 440_000)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [tuple(r[n] for n in names) for r in few] + odd + [tuple(few[0][n] for n in names)] * 3
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, folder, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path)).cache()
        assert after.columns == frame.columns and after.count() <= docs.count()
        docs = after
    texts = [r.text for r in docs.collect()]
    assert len(set(texts)) >= len(texts) - 3 and docs.where("doc_id IS NULL").count() <= 2
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert last.agg({"length": "sum"}).first()[0] >= len(texts) and last.count() >= len(texts)
    none = tmp_path / "none"
    for name, source in (("documents", frame.limit(0)), ("labels", table(spark, folder, "labels").limit(0))):
        source.write.parquet(f"{none}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(none)).count() == 0
