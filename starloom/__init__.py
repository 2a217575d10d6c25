"""Starloom: build a sales star schema from transactional tables with Spark.

The package is organised by what a warehouse build needs:

``model``      the fourteen target tables, their rules and foreign keys
``sources``    where rows come from: Parquet, catalog, JDBC, flat files
``functions``  column expressions (keys, measures, XML fields, code maps)
``operators``  DataFrame-to-DataFrame steps (lookups, history, dedupe, keys, checks)
``plans``      extracts, dimensions, facts, loads and the full run
``registry``   the same plans on the benchmark tables, with reference SQL
"""

__version__ = "0.1.0"
