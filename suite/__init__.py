"""Registered queries: each module holds QUERIES (name → callable) and ORACLES (name → SQL)."""

import sys

from pyspark import cloudpickle

# As in the library: functions that run in tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def modules():
    from . import books, lifecycle, linking, sheets, star, texts
    return [sheets, star, lifecycle, texts, linking, books]
