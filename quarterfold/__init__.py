"""quarterfold: longitudinal clinical reporting and record migration on Spark.

Layers, bottom up:

* ``functions``  column helpers (dates, text comparison, predicates)
* ``sources``    table readers, key maps, row selection, sinks
* ``operators``  reusable relational steps (latest row, lookups, rules, views)
* ``plans``      whole jobs (read model, report, migration)
* ``streaming``  continuous upkeep of the read model
"""
