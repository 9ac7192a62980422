"""Monthly price books on Spark: sheets to tables, relational load, record linkage."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
