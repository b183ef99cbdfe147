"""larder: a Spark-native feature engine for item catalogs and their interactions.

Every operator is a ``DataFrame -> DataFrame`` function whose column names are
parameters.  The work is declared with built-in Spark expressions, joins,
windows and aggregates so Catalyst can prune, push down and plan it; the only
values that reach the driver are model-sized aggregates (medians, caps,
means, covariance / Gramian matrices bounded by the number of features).
"""

import sys

from pyspark import cloudpickle

from larder.session import get_spark, checkpoint_dir

# the code of tasks travels with them: executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark", "checkpoint_dir"]
