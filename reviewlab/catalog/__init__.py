"""All registered queries."""

from reviewlab.catalog import (  # noqa: F401
    encodings,
    evaluations,
    features,
    modelling,
    profiles,
    statistics,
    tables,
)
from reviewlab.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
