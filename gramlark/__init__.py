"""Tabular-regression workbench expressed as Spark jobs.

Layers, from the bottom up:

* ``functions``  column expressions and distributed statistics (quantiles,
  ranks, moments) shared by everything else;
* ``sources``    tables in and out: scans, folds, metric and model tables;
* ``operators``  fit/transform steps: profile, impute, outliers, encode, ...;
* ``plans``      multi-step work: the feature flow, model search, rankings,
  chart data and report rows;
* ``catalog``    the registered queries with their reference SQL.
"""

__version__ = "0.1.0"


def _ship_functions() -> None:
    """Send task functions of this package by value, so that executors need no
    copy of it on their path."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_functions()
