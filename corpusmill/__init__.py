"""corpusmill: a PySpark-native corpus builder.

Every operator is either ``Column -> Column`` (``corpusmill.functions``) or
``DataFrame -> DataFrame`` (``corpusmill.operators``, ``corpusmill.sources``),
so jobs are plain ``DataFrame.transform`` chains that Catalyst plans as a whole.
"""

import sys as _sys

__version__ = "0.1.0"

# UDF bodies (MinHash kernel, NFC, gzip reader, sequential finish) are shipped to Python workers
# by value, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the vendored API
    pass
