"""Table-to-table operators, each a Spark DataFrame job."""
