"""partsmith — a Spark-native engine for building and querying product catalogs.

The package is organised by role:

* ``sources``   — readers for landed product pages, category trees, vendor tables
* ``functions`` — column expressions (coercion, defaults, formatting, trigrams)
* ``operators`` — DataFrame -> DataFrame operators (merge and its policies,
                  search, index, tree, planner, audit, progress, variants, reports)
* ``plans``     — the registered queries over the driver's test tables
* ``streaming`` — Structured Streaming ingest (page-at-a-time upsert)
* ``api``       — one call per workflow: ingest, enrich, publish, release manifest
"""

__version__ = "0.1.0"
