"""Operators for preparing training text: one module per operator, `queries` registers them."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules["perigee.llm"])
