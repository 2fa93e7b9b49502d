"""Transit feed lake on Spark: raw GTFS-Realtime snapshots in, curated day tables out."""

import sys

from pyspark import cloudpickle

# Functions run inside tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
