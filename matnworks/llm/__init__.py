"""Operators that prepare training text: quality, deduplication, decontamination, packing, chat, HTML, personal data.

Functions of this subpackage travel to the Python workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
