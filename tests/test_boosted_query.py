from __future__ import annotations

import os

import pytest

import __spark_entry__
from flowtide.operators.learning import TREES
from flowtide.sources import files

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_the_registered_query_may_boost_for_all_rounds(spark, monkeypatch):
    saved = []
    keep = files.save_model
    monkeypatch.setattr(files, "save_model", lambda model, path: (saved.append(model), keep(model, path)))
    rows = __spark_entry__.queries()["score_flows_boosted"](spark, DATA)
    boosters = saved[0].stages[1:]
    print([b.getNumTrees for b in boosters])
    assert len(boosters) == 3 and rows.count() > 0
    # Early stopping on the validation rows, not a smaller limit, may end a fit.
    assert all(b.getMaxIter() == TREES == 100 and b.getValidationIndicatorCol() == "isVal" for b in boosters)
