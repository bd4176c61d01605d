"""Operators for preparing training text: encoding, scoring, mixing, dedup,
formatting, quality, URL and toxicity filters.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Ship these modules with the functions that use them, so executors need no
# installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
