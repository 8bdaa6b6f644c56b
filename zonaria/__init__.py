"""zonaria: land-regulation analytics as Spark DataFrame plans."""
import sys

from pyspark import cloudpickle

# Arrow functions travel with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
