"""Training-data operators: decontamination, extraction, cleaning, deduplication, mixing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their code, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
