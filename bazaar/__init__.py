"""Marketplace data toolkit: messy reports, payloads and pages to trustworthy tables."""

import sys

from pyspark import cloudpickle

# The row functions for pages and workbooks travel inside the task, so executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
