"""Spark jobs that turn tables of paper pages into checked training records."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
