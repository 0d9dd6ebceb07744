"""scrubjay: Spark-native data cleaning, validation and reporting.

Every public operator is a plain function ``(DataFrame, params) -> DataFrame``
built from Spark's own expressions, so the whole plan stays inside Catalyst
and executes on the cluster. Chain them with ``DataFrame.transform``.

Sub-packages:

* ``sources``   - table scans, derived fixture views, CSV/Parquet sinks, schema tools
* ``functions`` - column-level building blocks: predicates, text, statistics
* ``operators`` - cleaning, quality, outliers, features, analysis operators
* ``plans``     - report queries and end-to-end cleaning pipelines
* ``streaming`` - notes on using the stateless operators on streaming frames
"""

from scrubjay.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
__version__ = "0.1.0"
