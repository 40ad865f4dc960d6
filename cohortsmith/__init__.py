"""Clinical analysis tables, statistics and lineage as Spark DataFrame operators."""
