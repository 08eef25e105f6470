"""The registered ensembles are the library's."""

from types import SimpleNamespace

import pytest

from tidepanel.operators import modelling
from tidepanel.workload import forecast_queries


@pytest.mark.parametrize("name", ["model_grid", "ensemble_importance"])
def test_queries_fit_the_default_ensembles(spark, sf_dir, monkeypatch, name):
    class Seen(Exception):
        pass

    def grid(split, target, category, sets, models=None, make=modelling.estimators):
        raise Seen(make(target, SimpleNamespace(n=10, std=1.0)))

    monkeypatch.setattr(modelling, "model_grid", grid)
    monkeypatch.setattr(forecast_queries, "_prepared", lambda spark, sf_dir: None)
    with pytest.raises(Seen) as caught:
        getattr(forecast_queries, name)(spark, sf_dir)
    forest, boosting = (caught.value.args[0][m] for m in ("Random Forest", "Gradient Boosting"))
    assert (forest.getNumTrees(), forest.getMaxDepth(), boosting.getMaxIter()) == (100, 15, 100)
