"""Operators for preparing training data: filters, duplicates, tokens, language models.

Nothing outside this package imports it. Functions that run in tasks travel with the tasks, so
that workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
