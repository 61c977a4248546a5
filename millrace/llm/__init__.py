"""Operations for building training data from large text collections.

Nothing else in the library imports this subpackage. Functions that run inside Python workers are
pickled with their code, so executors need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
