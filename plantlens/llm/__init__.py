"""Training-data operators: filtering, dedup, decontamination, mixing.

Nothing else in the library imports this package. Python functions that
run inside tasks are shipped by value, so executors need numpy, pyarrow and
xxhash but not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
