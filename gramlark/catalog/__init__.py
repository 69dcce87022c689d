"""Registered queries with their reference SQL."""

from gramlark.catalog import (  # noqa: F401
    charts,
    diagnostics,
    evaluation,
    features,
    kept,
    models,
    outliers_more,
    profiles,
    storage,
    trees,
)
from gramlark.catalog.base import QUERIES, Query

__all__ = ["QUERIES", "Query"]
