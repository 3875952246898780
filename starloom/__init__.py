"""starloom: star-schema ELT operators on Spark DataFrames.

Subpackages: ``sources`` (zones, loads, warehouse store), ``functions``
(calendar, hashing), ``operators`` (cleaning, staging, keys, dimensions,
SCD, bridge, fact, reports), ``plans`` (full and incremental pipelines),
``streaming`` (micro-batch load).
"""

__version__ = "0.1.0"
