"""caseloom: retail support analytics as Spark jobs.

Subpackages: ``sources`` (readers, analog tables, catalog), ``functions``
(Column expressions), ``operators`` (DataFrame → DataFrame stages), ``sinks``
(writers), ``plans`` (pipeline runs and the named query registry),
``streaming`` (incremental file ingestion).
"""

__version__ = "0.1.0"

# Functions run by pandas UDFs are shipped to the executors by value, so the
# workers need no copy of this package on their import path.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark: ship the package with --py-files
    pass
