"""isodose: analytics over geo-tagged radiation readings, batch and streaming, on Spark."""

import sys

from pyspark import cloudpickle

from isodose.schemas import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]

# Functions sent to Python workers carry their code along, so the package needs no
# installation on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
