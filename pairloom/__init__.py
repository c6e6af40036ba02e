"""Second-order factorization machines as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

from pairloom.config import FMConfig, ModelMeta

# Functions that run in tasks travel with the task, so that executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["FMConfig", "ModelMeta"]
