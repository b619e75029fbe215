"""kinseek: deterministic record linkage and ranked retrieval as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from kinseek.plans.cascade import cascade
from kinseek.plans.identity import resolve

# Functions that run inside tasks travel with the job, so executors need no copy of the
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["cascade", "resolve"]
