"""eventloom: load operating-system event-log records into searchable tables with Spark."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship this package's functions with the tasks that use them (Arrow UDFs,
# mapInPandas bodies, the bulk writer), so executors need no installed copy.
# On a cluster, passing the package with --py-files works as well.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .plans.load import DEFAULT_BATCH_SIZE, EventLoad, LoadReport, load_events, prepare_events  # noqa: E402

__all__ = ["DEFAULT_BATCH_SIZE", "EventLoad", "LoadReport", "load_events", "prepare_events"]
