"""Training-data operators (language-model scoring, quality rules, near duplicates, packing, ...).

Nothing outside this subpackage imports it. Its functions travel to the executors by value, so
a cluster needs no copy of the repository on the workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
