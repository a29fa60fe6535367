"""Operators that prepare training text: filters, deduplication, mixing, archives.

Every operator takes a frame and the names of its id and text columns, reads only these columns
and returns new ones, so further columns of the frame never clash with its own. Nothing outside
this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Executors need not have the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
