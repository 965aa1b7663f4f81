"""Independent SQL statements the Spark results are compared with."""
