import pytest

from sparkprep.operators import evaluate as e

CASES = [
    [(0, 0), (0, 1), (1, 1), (1, 1)],
    [(0, 0), (1, 0), (2, 0), (2, 2), (1, 1), (1, 3)],
    [(0, 1), (1, 0)],
    [(1, 1), (1, 1)],
]


def frame(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "y double, p double")


@pytest.mark.parametrize("pairs", CASES)
def test_scores_match_the_evaluator(spark, pairs):
    df = frame(spark, pairs)
    found = {r["metric"]: r["score"] for r in e.scores(e.confusion(df, "y", "p")).collect()}
    for metric, score in found.items():
        if metric == "weightedFalsePositiveRate" and len({a for a, _ in pairs}) == 1:
            continue
        assert score == pytest.approx(e.get_score(df, metric, "y", "p")), metric


def test_fixture_scores(spark):
    matrix = e.confusion(frame(spark, CASES[0]), "y", "p")
    found = {r["metric"]: r["score"] for r in e.scores(matrix).collect()}
    assert found["f1"] == pytest.approx(0.733333, abs=1e-6)
    assert found["accuracy"] == 0.75
    assert found["weightedPrecision"] == pytest.approx(0.833333, abs=1e-6)
    assert found["weightedRecall"] == 0.75


def test_by_label_lists_predicted_only_classes(spark):
    found = {r["class"]: r for r in e.scores_by_label(e.confusion(frame(spark, CASES[1]), "y", "p")).collect()}
    assert set(found) == {0.0, 1.0, 2.0, 3.0}
    assert found[3.0]["actual"] == 0 and found[3.0]["recall"] == 0.0
