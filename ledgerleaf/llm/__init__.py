"""Operations of a training-data pipeline.

Nothing else in the library imports this subpackage.  Its functions that run in
Python workers travel by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
