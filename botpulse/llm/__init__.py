"""Training-data operators: dedup, quality, scans, decontamination, token counts, mixing.

Functions that run in Python workers are shipped by value, so the executors need
the third-party packages only, not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
