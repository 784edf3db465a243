"""Operators of a training-data pipeline over ``documents``.

One module per operator, ``queries`` registers them, ``corpus_pipeline.py`` at
the repository top chains five of them.  Nothing outside this subpackage
imports it.  Functions that run inside tasks are shipped with the plan, so
executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
