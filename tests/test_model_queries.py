"""The model queries fit the operator's own defaults, once."""

from types import SimpleNamespace

from workload import streams_models


def test_default_candidates_are_fitted_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(streams_models, "_LAST", {}, raising=False)
    monkeypatch.setattr(streams_models, "stage", lambda df, purpose: df)
    monkeypatch.setattr(streams_models, "_labelled", lambda spark, sf: None)
    monkeypatch.setattr(streams_models.training, "train_and_compare", lambda data, label, key, candidates: calls.append(candidates) or SimpleNamespace())
    assert streams_models._compare(spark, "a") is streams_models._compare(spark, "a") and len(calls) == 1
    forest, boosting, other, linear = (c.estimator for c in calls[0])
    assert forest.getNumTrees() == other.getNumTrees() == boosting.getMaxIter() == 300
    streams_models._compare(spark, "b")
    assert len(calls) == 2
