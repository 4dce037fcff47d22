"""DuckDB oracle SQL for every registered query (see ``__spark_entry__.oracle_sql``)."""
