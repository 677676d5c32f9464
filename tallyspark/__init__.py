"""tallyspark: subscriber analytics (customers, billing, network sessions) as Spark DataFrame jobs.

Layers, each a set of pure ``DataFrame -> DataFrame`` functions:

* ``sources``   – typed readers (CSV / Parquet / JDBC), landing, sinks, versioned upserts,
                  and the fixture derivation from the driver's test tables.
* ``functions`` – column expressions (title case, epoch durations, safe ratios, row JSON).
* ``operators`` – dedup, data-quality checks and quarantine, staging, aggregates, warehouse.
* ``plans``     – business queries and the end-to-end pipeline.
* ``streaming`` – change-feed application with Structured Streaming ``foreachBatch``.
"""

__version__ = "0.1.0"
