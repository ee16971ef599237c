"""tramline: transit telemetry analytics as Spark DataFrame transforms.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own expressions, window functions and Structured Streaming state:

* ``tramline.sources``    typed CSV / text scans, bad-record split, driver tables
* ``tramline.functions``  column-level predicates, geo math, scalar helpers
* ``tramline.operators``  ordered and grouped operators (change points, path
                          length, histograms, extremes with owners, busiest groups)
* ``tramline.plans``      the user-level analyses and the query registry
* ``tramline.streaming``  streaming forms and a runner for them
"""

from tramline.session import build_session, prepare, shared_dir

__all__ = ["build_session", "prepare", "shared_dir"]
