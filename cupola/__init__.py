"""cupola: coupon-redemption analytics as Spark DataFrame jobs.

Sub-packages:

- ``functions``  Column -> Column expressions (discount text, date text, guarded casts).
- ``sources``    table readers, the raw coupon view, score sinks.
- ``operators``  DataFrame -> DataFrame jobs (cleaning, features, selection, models, metrics).
- ``plans``      end-to-end jobs composed from operators.
- ``streaming``  the stateless parsers applied to a Structured Streaming source.
"""

__version__ = "0.1.0"

# Functions that run inside Python workers (pandas UDFs, cogroup functions) are
# shipped by value, so executors need no installed copy of this package.
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
