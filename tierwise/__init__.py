"""Layered feature tables on Spark: raw -> bronze -> silver -> gold -> model."""

import sys

from pyspark import cloudpickle

from tierwise.spec import FeatureSpec

# Functions run in Python workers travel with their code, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["FeatureSpec"]
