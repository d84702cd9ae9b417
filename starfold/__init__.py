"""starfold: build and check a dimensional warehouse with Spark DataFrames.

Sub-packages:

* ``functions`` -- Column -> Column cleaning functions (title case, category
  mapping, flags, white space, integer date keys).
* ``operators`` -- generic DataFrame operators: dense surrogate keys, calendar,
  key resolution with rejects, column contracts, profiling aggregates.
* ``sources``   -- readers (parquet, CSV/TSV, JDBC options) and writers.
* ``plans``     -- the warehouse model: dimension and fact transforms, quality
  rules and gate, the end-to-end load.
* ``streaming`` -- bounded incremental loads with Structured Streaming.
"""

__version__ = "0.1.0"
