"""evallens: evaluate model answers at scale with Spark DataFrames.

Public functions take DataFrames (or column expressions) and return DataFrames;
none starts a session.  Some write intermediate tables to the shared folder or
read a bounded number of rows (sums, counts, a histogram) while they are
called; their docstrings say so.
"""

import sys as _sys

__version__ = "0.1.0"

# Functions that run in Python workers (mapInPandas bodies and the helpers they
# call) are shipped by value, so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark: install the package on executors
    pass
