"""autoprice: vehicle-price, transaction and URL analytics as Spark DataFrame plans.

Layout:
  sources/    readers (CSV, Parquet, text, JSON, synthetic) and writers
  functions/  column-expression helpers (scalars, deterministic randomness, statistics)
  operators/  cleaning, profiling, splitting, features, metrics, A/B statistics, registry, monitoring
  plans/      fixture views, composite jobs and the query catalogue used by the driver contract
  streaming/  Structured Streaming scoring, de-duplication and windowed monitoring
"""

import sys as _sys

# Python functions shipped to executors (pandas UDFs, mapInPandas bodies) are serialised by value,
# so executors need neither this package installed nor the driver's working directory.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle without by-value registration
    pass

from autoprice.session import get_spark, ensure_checkpoint_dir  # noqa: E402

__all__ = ["get_spark", "ensure_checkpoint_dir"]
