"""DataFrame -> DataFrame operators, partitioned by key columns."""
