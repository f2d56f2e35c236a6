"""The registered searches fit every point of the reference's grids."""

from __future__ import annotations

import math

import pytest

from reviewlab.catalog import QUERIES, modelling
from reviewlab.operators import models as md


@pytest.mark.parametrize("name", ["rf", "gbt"])
def test_search_takes_whole_grid(monkeypatch, name):
    asked = []

    class Data:
        train = None

        def release(self):
            pass

    monkeypatch.setattr(modelling, "labelled", lambda spark, sf_dir: None)
    monkeypatch.setattr(modelling.tr, "prepare", lambda base: Data())
    monkeypatch.setattr(md, "tune", lambda train, model, values=None: asked.append(values or md.GRIDS[model]))
    monkeypatch.setattr(md, "grid_scores", lambda spark, found: None)
    QUERIES[f"tune_{name}"](None, "")
    assert asked == [md.GRIDS[name]]
    assert math.prod(len(v) for v in asked[0].values()) == 12
