"""Feature and model pipelines over large tables, written as Spark DataFrame operators.

Every operator is a DataFrame-to-DataFrame (or Column-to-Column) function. Only
sinks, ``fit`` functions and the gate start Spark jobs; everything else is lazy.
"""

import sys

from pyspark import cloudpickle

# Python helpers that run inside tasks travel with the job, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
