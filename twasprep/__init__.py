"""Spark-native preparation of cell-type TWAS input tables.

Every public operator takes Spark DataFrames and returns Spark DataFrames.
Sub-packages:

* ``sources``   - readers for the text formats the workflow consumes
* ``functions`` - column expressions (no Python per row)
* ``operators`` - table operators (genotype, rsid, features, predict,
  expression, validate, manifest, bundle)
* ``sinks``     - writers that render the text formats
* ``plans``     - end-to-end jobs and the registered query catalog
* ``streaming`` - incremental (availableNow) variants of the batch jobs
"""

__version__ = "0.1.0"
