"""tessera: document windows, TF-IDF search, query routing and SFT data preparation as
Spark DataFrame jobs."""

import sys as _sys

try:
    # Functions of this package used inside Python UDFs are shipped by value, so
    # executors need no installed copy of the package.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass

__version__ = "0.1.0"
