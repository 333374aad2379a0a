"""Training-data pipeline operators.

Nothing else in the library imports this package; its queries are added by the
driver entry module when the package is present.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
