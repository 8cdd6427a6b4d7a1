"""featurelake: a Spark-native feature pipeline library.

Operators are plain ``DataFrame -> DataFrame`` functions grouped by capability:

- ``operators.transform``  row-level feature engineering
- ``operators.store``      long feature log, latest/as-of pivots, catalogue
- ``operators.views``      feature views, point-in-time joins, online tables
- ``operators.quality``    profiles, summaries, drift
- ``operators.graph``      correlation networks and graph metrics
- ``operators.trips``      trip preparation, splits, one-hot encoding
- ``operators.metrics``    model metrics, gates, candidate ranking
- ``operators.models``     Spark ML fit / score / search
- ``streaming``            envelopes, decoding, idempotent upserts, stream scoring
"""

__version__ = "0.1.0"
