"""Named query plans over the driver tables, each with a DuckDB oracle.

``catalog.queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``;
``catalog.oracle_sql()`` gives the equivalent SQL for DuckDB.
"""
