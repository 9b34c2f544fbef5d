"""Model documents: goldens of the parser, refusals, and the way back to text."""

import numpy as np
import pytest

from tidescore.operators.batch_scoring import batch_scorer
from tidescore.plans import models
from tidescore.schemas import FEATURES
from tidescore.sources.pmml import ModelError, parse_pmml, render_pmml

RNG = np.random.default_rng(7)
X = RNG.uniform(0.0, 15.0, (200, len(FEATURES)))

TREE = b"""<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3">
<DataDictionary><DataField name="quality" optype="categorical" dataType="string">
<Value value="5"/><Value value="6"/></DataField></DataDictionary>
<TreeModel functionName="classification" splitCharacteristic="binarySplit">
<MiningSchema><MiningField name="quality" usageType="target"/></MiningSchema>
<Node score="5" recordCount="10.0"><True/>
  <Node score="5" recordCount="6.0"><SimplePredicate field="alcohol" operator="lessOrEqual" value="10.5"/>
    <ScoreDistribution value="5" recordCount="4.0"/><ScoreDistribution value="6" recordCount="2.0"/></Node>
  <Node score="6" recordCount="4.0"><SimplePredicate field="alcohol" operator="greaterThan" value="10.5"/>
    <ScoreDistribution value="6" recordCount="4.0"/></Node>
</Node></TreeModel></PMML>"""


def row(**values):
    x = np.zeros((1, len(FEATURES)))
    for name, value in values.items():
        x[0, FEATURES.index(name)] = value
    return x


def test_tree_golden():
    params = parse_pmml(TREE)
    assert params["labels"] == ["5", "6"]
    score = batch_scorer(params)
    assert score(row(alcohol=10.5))[0] == 5.0
    assert score(row(alcohol=10.6))[0] == 6.0
    probs = [n["probs"] for n in params["nodes"] if n["feature"] < 0]
    assert probs[0] == pytest.approx([4 / 6, 2 / 6])
    assert probs[1] == [0.0, 1.0]


def test_unknown_tree_field_reads_as_zero():
    params = parse_pmml(TREE.replace(b'field="alcohol"', b'field="colour"'))
    assert batch_scorer(params)(row(alcohol=99.0))[0] == 5.0
    assert len(params["nodes"]) == 1


def test_regression_golden_ignores_unknown_predictor():
    text = b"""<PMML><DataDictionary/><RegressionModel functionName="regression"><MiningSchema/>
    <RegressionTable intercept="1.5"><NumericPredictor name="pH" coefficient="2.0"/>
    <NumericPredictor name="colour" coefficient="9.0"/>
    <NumericPredictor name="density" exponent="2" coefficient="3.0"/></RegressionTable></RegressionModel></PMML>"""
    params = parse_pmml(text)
    assert batch_scorer(params)(row(pH=2.0, density=3.0))[0] == pytest.approx(1.5 + 4.0 + 27.0)


@pytest.mark.parametrize(
    "content",
    [
        b"",
        b"<PMML>",
        b"<PMML/>",
        b"not a document",
        b'<!DOCTYPE x [<!ENTITY a "b">]><PMML/>',
        TREE.replace(b"greaterThan", b"equal"),
        TREE.replace(b'operator="greaterThan" value="10.5"', b'operator="greaterThan" value="10.6"'),
        b'<PMML><GeneralRegressionModel modelType="coxRegression"/></PMML>',
        b'<PMML><RegressionModel functionName="regression"/></PMML>',
    ],
)
def test_refused_documents(content):
    with pytest.raises(ModelError):
        parse_pmml(content)


@pytest.mark.parametrize(
    "params",
    [
        models.linear(),
        models.linear("glm", "log", 0.1),
        models.tree_classifier(),
        models.tree_regressor(),
        models.forest(4, 3),
        models.perceptron(),
    ],
    ids=lambda p: p["kind"],
)
def test_round_trip(params):
    again = parse_pmml(render_pmml(params))
    with np.errstate(all="ignore"):
        np.testing.assert_allclose(batch_scorer(again)(X), batch_scorer(params)(X), rtol=1e-12)


def test_product_terms_round_trip():
    params = models.linear("glm")
    exponents = [0.0] * len(FEATURES)
    exponents[0], exponents[3] = 1.0, 2.0
    params["terms"] = [{"beta": 0.5, "exponents": exponents}]
    again = parse_pmml(render_pmml(params))
    assert again["terms"] == params["terms"]
    np.testing.assert_allclose(batch_scorer(again)(X), batch_scorer(params)(X), rtol=1e-12)
