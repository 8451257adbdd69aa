"""Operators for preparing language-model training data. Nothing else in the package imports this one."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Executors get the code of these modules with the task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
