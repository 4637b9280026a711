"""tessera — Spark-native spatial-temporal feature and data-quality engine.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
built from Spark SQL built-ins, so Catalyst sees one declarative plan per job.
"""

__version__ = "0.1.0"
