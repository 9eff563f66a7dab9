"""recordloom: link, merge and track business entities from several feeds on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Arrow functions travel with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
