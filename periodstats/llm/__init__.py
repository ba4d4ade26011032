"""Operators for large text corpora: filtering, joining, scanning, scoring, packing.

Each module holds one operator with a general interface; ``registry`` maps the registered
queries (``opN_<name>`` and ``pipeline``) to them. Nothing else in the library imports this
subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
