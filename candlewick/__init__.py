"""Spark-native OHLCV bar analytics.

Layers (each a plain ``DataFrame -> DataFrame`` function, composed lazily so
Catalyst sees the whole plan):

* ``sources``    payload parsing, raw-zone scans, test-data adapter
* ``operators``  staging, dedup, marts, features, serving views, checks
* ``functions``  Column-expression helpers (safe divide, epoch conversion, ...)
* ``plans``      materializations: partition writes, high-water marks, merge,
                 the full model build
* ``streaming``  the incremental load as an ``availableNow`` file stream
"""

from candlewick.schema import NATURAL_KEY, SERIES_KEY  # noqa: F401
