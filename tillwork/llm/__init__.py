"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing outside this subpackage imports it.  Functions of these modules run
inside Spark tasks; they are shipped by value, so that executors need no copy
of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
