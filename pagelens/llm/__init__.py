"""Training-data operators: one module per operator, as Spark jobs.

Nothing else in the library imports this subpackage. ``queries.py`` registers
the ten operators; ``/corpus_pipeline.py`` chains five of them.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
