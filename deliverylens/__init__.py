"""deliverylens: change data from two work trackers, reduced and rolled up on Spark.

Layers (all DataFrame in, DataFrame out):

* ``sources``    change feeds, incremental slices, the partitioned change-file source
* ``functions``  column helpers: JSON payload extraction, state unification, time formats
* ``operators``  silver parsing, latest-per-key (SCD type 1), gold mapping and roll-up, quality rules
* ``streaming``  Structured Streaming: bronze append, stateful and foreachBatch upserts
* ``plans``      ordered batch / streaming refreshes and the query catalogue
"""

__version__ = "0.1.0"
